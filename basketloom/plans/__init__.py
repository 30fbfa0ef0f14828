"""End-to-end paths and the registered queries."""
