"""Column expressions: all of them built-in functions, so they stay in generated code."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Edges of the right-closed recency bins, and the bins' labels.
RECENCY_EDGES = [-0.5, 0.5, 1.5, 2.5, 3.5, 4.5, 5.5, 10.5, 20.5, 1e9]
RECENCY_LABELS = ["0", "1", "2", "3", "4", "5", "6-10", "11-20", ">20"]


def is_literal_missing(text: Column) -> Column:
    """True where the text, stripped of any whitespace and lowercased, is the word 'missing'."""
    stripped = F.regexp_replace(text.cast("string"), r"^\s+|\s+$", "")
    return F.coalesce(F.lower(stripped) == "missing", F.lit(False))


def safe_ratio(numerator: Column, denominator: Column) -> Column:
    """numerator / denominator as double; 0 where the denominator is 0 or either side is null."""
    return F.coalesce(
        F.try_divide(numerator.cast("double"), denominator.cast("double")), F.lit(0.0)
    )


def finite_or_zero(value: Column) -> Column:
    """0 for null, NaN and either infinity; the value as double otherwise."""
    number = value.cast("double")
    broken = F.isnan(number) | (F.abs(number) == F.lit(float("inf")))
    return F.when(number.isNull() | broken, F.lit(0.0)).otherwise(number)


def clip_low(value: Column, floor: float = 0.0) -> Column:
    """Raise values below ``floor`` to it; null stays null."""
    return F.when(value < floor, F.lit(floor)).otherwise(value)


def recency_bin(orders_since: Column) -> Column:
    """Ordinal of the right-closed recency bin, null outside every bin."""
    inside = F.when(orders_since <= RECENCY_EDGES[0], F.lit(None).cast("int"))
    for ordinal, edge in enumerate(RECENCY_EDGES[1:]):
        inside = inside.when(orders_since <= edge, F.lit(ordinal))
    return inside


def label_for_bin(ordinal: Column) -> Column:
    """Text label of a recency bin ordinal."""
    return F.element_at(F.array(*[F.lit(x) for x in RECENCY_LABELS]), ordinal + 1)


def dot(left: Column, right: Column) -> Column:
    """Inner product of two equally long numeric arrays, in double precision."""
    products = F.zip_with(left, right, lambda a, b: a.cast("double") * b.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda total, x: total + x)


def norm(vector: Column) -> Column:
    """Euclidean length of a numeric array."""
    return F.sqrt(dot(vector, vector))


def cosine(left: Column, right: Column, floor: float = 1e-8) -> Column:
    """Cosine of two arrays; the denominator is never less than ``floor``."""
    return dot(left, right) / F.greatest(norm(left) * norm(right), F.lit(floor))
