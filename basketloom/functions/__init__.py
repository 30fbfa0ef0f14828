"""Column expressions shared by the operators."""

from .columns import (
    clip_low,
    cosine,
    dot,
    finite_or_zero,
    is_literal_missing,
    label_for_bin,
    norm,
    recency_bin,
    safe_ratio,
)

__all__ = [
    "clip_low",
    "cosine",
    "dot",
    "finite_or_zero",
    "is_literal_missing",
    "label_for_bin",
    "norm",
    "recency_bin",
    "safe_ratio",
]
