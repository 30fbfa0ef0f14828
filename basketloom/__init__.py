"""Basket analytics as Spark jobs: features, profiling, rules, segments, scoring, evaluation."""
