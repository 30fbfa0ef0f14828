from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from basketloom.operators import quantiles
from basketloom.operators.quantiles import (
    Measure,
    exact_quantiles,
    histogram,
    moments,
    narrowed_quantiles,
    tail_summary,
    tails_of_columns,
)

PROBS = {"q10": 0.1, "q50": 0.5, "q90": 0.9, "q999": 0.999}


@pytest.mark.parametrize("sizes", [False, True])
def test_quantiles_equal_linear_interpolation(spark, sizes):
    rng = np.random.default_rng(3)
    groups = {"whole": rng.integers(0, 50, 1001), "real": rng.exponential(3, 800), "one": [4.5]}
    data = [(g, float(v)) for g, vs in groups.items() for v in vs] + [("whole", None)]
    df = spark.createDataFrame(data, "g string, v double")
    got = {r.g: r for r in exact_quantiles(df, "v", PROBS, ["g"], sizes).collect()}
    for g, vs in groups.items():
        for name, p in PROBS.items():
            assert got[g][name] == pytest.approx(np.quantile(vs, p), abs=1e-9), (g, name)


def test_quantiles_without_groups_under_heavy_repetition(spark):
    values = np.array([7.0] * 900 + list(np.linspace(0, 100, 317)))
    df = spark.createDataFrame([(float(v),) for v in values], "v double")
    row = exact_quantiles(df, "v", PROBS).collect()[0]
    assert [row[n] for n in PROBS] == pytest.approx([np.quantile(values, p) for p in PROBS.values()])


GROUPS = {
    "whole": np.random.default_rng(3).integers(0, 50, 1001).astype(float),
    "real": np.random.default_rng(4).exponential(3, 800),
    "far": np.array([-1e300, 1e300, *np.random.default_rng(5).normal(0, 1e-9, 300)]),
    "crowded": np.append(1.0 + np.arange(500) * 2.0**-52, [5e8, -5e8]),
    "same": np.full(40, 2.5),
    "one": np.array([4.5]),
    "infinite": np.append(np.arange(30.0), [np.inf, np.inf]),
}


@pytest.mark.parametrize(("parts", "narrowings"), [(1024, 2), (4, 3), (2, 0)])
def test_narrowed_quantiles(spark, monkeypatch, parts, narrowings):
    monkeypatch.setattr(quantiles, "PARTS", parts)
    monkeypatch.setattr(quantiles, "NARROWINGS", narrowings)
    # Two frames, columns of different lengths (the rest null), and one without values.
    names = list(GROUPS)
    frames, measures = [], []
    for some in (names[:4], names[4:]):
        rows = [
            [float(GROUPS[g][i]) if i < len(GROUPS[g]) else None for g in some] + [None]
            for i in range(max(len(GROUPS[g]) for g in some))
        ]
        schema = ", ".join(f"{g} double" for g in [*some, "nothing"])
        frames.append(spark.createDataFrame(rows, schema).repartition(5))
        measures += [Measure(frames[-1], F.col(g)) for g in some]
    measures.append(Measure(frames[0], F.col("nothing")))
    got = narrowed_quantiles(measures, list(PROBS.values()))
    assert got[-1] == [None] * len(PROBS)
    for g, own in zip(names, got, strict=False):
        values = np.sort(GROUPS[g])
        for p, x in zip(PROBS.values(), own, strict=True):
            position = p * (len(values) - 1)
            low, high = values[int(np.floor(position))], values[int(np.ceil(position))]
            expected = low if low == high else low + (high - low) * (position % 1)
            assert x == pytest.approx(expected, rel=1e-12), (g, p)
    found = moments(measures)
    assert [m.n for m in found] == [*(len(GROUPS[g]) for g in names), 0]
    assert found[1].std == pytest.approx(np.std(GROUPS["real"], ddof=1))


def test_tails_of_columns(spark):
    df = spark.createDataFrame([(float(v), None) for v in range(1, 101)], "v double, w double")
    got = tails_of_columns({"m": Measure(df, F.col("v")), "none": Measure(df, F.col("w"))}).collect()
    assert len(got) == 1
    assert (got[0].measure, got[0].n, got[0].min, got[0].max) == ("m", 100, 1.0, 100.0)
    assert got[0].q95 == pytest.approx(95.05)


def test_tail_summary(spark):
    df = spark.createDataFrame([("m", float(v)) for v in range(1, 101)], "measure string, value double")
    row = tail_summary(df).collect()[0]
    assert (row.n, row.min, row.max) == (100, 1.0, 100.0)
    assert row.q95 == pytest.approx(95.05)


@pytest.mark.parametrize("log1p", [False, True])
def test_histogram_equals_equal_width_bins(spark, log1p):
    values = np.concatenate([np.arange(0, 40), np.array([100, 100, 250])]).astype(float)
    df = spark.createDataFrame([(float(v),) for v in values] + [(None,)], "v double")
    got = histogram(df, "v", bins=13, log1p=log1p).orderBy("bin").collect()
    n, edges = np.histogram(np.log1p(values) if log1p else values, bins=13)
    assert [r.n for r in got] == list(n)
    assert [r.bin_lo for r in got] == pytest.approx(list(edges[:-1]))


def test_histogram_of_a_constant_is_widened(spark):
    df = spark.range(5).select(F.lit(3.0).alias("v"))
    got = histogram(df, "v", bins=4).orderBy("bin").collect()
    n, edges = np.histogram([3.0] * 5, bins=4)
    assert [r.n for r in got] == list(n) and [r.bin_lo for r in got] == list(edges[:-1])
