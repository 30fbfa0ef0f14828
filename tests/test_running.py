from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from basketloom.operators.running import (
    carried,
    dense_ids,
    first_per_key,
    running_totals,
    top_per_key,
    with_balanced_blocks,
)


def test_running_totals_cross_block_borders(spark):
    rng = random.Random(1)
    # Key 1 owns a third of the rows and spans many blocks; others have few rows.
    data = [(1, i, rng.randint(0, 9)) for i in range(400)]
    data += [(k, i, rng.randint(0, 9)) for k in range(2, 82) for i in range(10)]
    want = {}
    total = {}
    for k, i, x in data:
        total[k] = total.get(k, 0) + x
        want[k, i] = total[k]
    rng.shuffle(data)
    df = spark.createDataFrame(data, "k int, i int, x int")
    block = F.floor(F.col("i") / 16)
    got = running_totals(df, ["k"], block, ["i"], {"s": F.col("x")})
    assert got.columns == ["k", "i", "x", "s"]
    assert {(r.k, r.i): r.s for r in got.collect()} == want
    before = running_totals(df, ["k"], block, ["i"], {"s": F.col("x")}, inclusive=False)
    assert all(r.s == want[r.k, r.i] - r.x for r in before.collect())


@pytest.mark.parametrize("width", [1, 7, 1000])
def test_carried_values_cross_empty_blocks(spark, width):
    data = [(k, i * i) for k in (1, 2) for i in range(3 * k, 20)] + [(None, 5), (None, 9)]
    df = spark.createDataFrame(data, "k int, i int").repartition(4)
    got = carried(df, ["k"], F.floor(F.col("i") / width), "i", "before").collect()
    want = {(k, i * i): (i - 1) ** 2 if i > 3 * k else None for k in (1, 2) for i in range(3 * k, 20)}
    assert {(r.k, r.i): r.before for r in got if r.k} == want
    assert len(got) == len(data)


@pytest.mark.parametrize("fan", [2, 4, 32])
def test_balanced_blocks_follow_the_value(spark, fan):
    counts = spark.createDataFrame([(float(v * v), v + 1) for v in range(500)], "v double, n int")
    got = with_balanced_blocks(counts, "v", ["n"], fan=fan).orderBy("v").collect()
    order = [r._block for r in got]
    assert order == sorted(order) and len(set(order)) >= min(fan * fan, 400)
    assert max(order.count(b) for b in set(order)) <= 500 / fan**2 * 1.5 + 1
    assert {r._total_n for r in got} == {500 * 501 // 2}


def test_top_per_key_breaks_ties_by_the_stated_order(spark):
    df = spark.createDataFrame([(1, p, 5) for p in range(20)] + [(2, 9, 1)], "u int, p int, n int")
    top = top_per_key(df, ["u"], [F.desc("n"), F.asc("p")], 11, rank="r")
    assert sorted((r.u, r.p, r.r) for r in top.collect()) == [(1, p, p + 1) for p in range(11)] + [
        (2, 9, 1)
    ]
    assert [tuple(r) for r in first_per_key(df, ["u"], [F.desc("p")]).orderBy("u").collect()] == [
        (1, 19, 5),
        (2, 9, 1),
    ]


def test_dense_ids_are_gap_free(spark):
    keys = [2**40 + 7 * i for i in range(300)] * 2
    ids = dense_ids(spark.createDataFrame([(k,) for k in keys], "k long"), "k", "code", blocks=16)
    got = ids.collect()
    assert sorted(r.code for r in got) == list(range(300))
    assert len({r.k for r in got}) == 300
