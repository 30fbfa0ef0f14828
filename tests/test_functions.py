from __future__ import annotations

import math

import pytest
from pyspark.sql import functions as F

from basketloom.functions import (
    clip_low,
    cosine,
    dot,
    finite_or_zero,
    is_literal_missing,
    label_for_bin,
    recency_bin,
    safe_ratio,
)


def values(df, column):
    return [r[0] for r in df.select(column).collect()]


def test_literal_missing_strips_any_whitespace_and_case(spark):
    texts = ["missing", " MISSING ", "Missing\t", "\nmissing", "missing item", "", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string").coalesce(1)
    assert values(df, is_literal_missing(F.col("t"))) == [True] * 4 + [False] * 3


def test_ratio_is_zero_for_zero_or_null_denominator(spark):
    df = spark.createDataFrame([(1, 2), (1, 0), (1, None), (None, 2), (0, 0)], "a int, b int")
    got = values(df.coalesce(1), safe_ratio(F.col("a"), F.col("b")))
    assert got == [0.5, 0.0, 0.0, 0.0, 0.0]


def test_nonfinite_values_become_zero(spark):
    data = [float("nan"), float("inf"), float("-inf"), None, -1.5]
    df = spark.createDataFrame([(x,) for x in data], "x double").coalesce(1)
    assert values(df, finite_or_zero(F.col("x"))) == [0.0, 0.0, 0.0, 0.0, -1.5]


def test_clip_keeps_null(spark):
    df = spark.createDataFrame([(-1.0,), (2.0,), (None,)], "x double").coalesce(1)
    assert values(df, clip_low(F.col("x"))) == [0.0, 2.0, None]


def test_recency_bins_are_right_closed(spark):
    cases = {0: "0", 1: "1", 5: "5", 6: "6-10", 10: "6-10", 11: "11-20", 20: "11-20", 21: ">20"}
    df = spark.createDataFrame([(k, v) for k, v in cases.items()], "n int, want string")
    got = df.select("want", label_for_bin(recency_bin(F.col("n"))).alias("got")).collect()
    assert all(r.want == r.got for r in got)
    assert values(spark.range(1), recency_bin(F.lit(-1))) == [None]


def test_vectors(spark):
    df = spark.createDataFrame([([1.0, 2.0], [3.0, 4.0]), ([0.0, 0.0], [1.0, 1.0])],
                               "a array<float>, b array<float>").coalesce(1)
    assert values(df, dot(F.col("a"), F.col("b"))) == [11.0, 0.0]
    cos = values(df, cosine(F.col("a"), F.col("b")))
    assert cos[0] == pytest.approx(11 / (math.sqrt(5) * 5)) and cos[1] == 0.0
