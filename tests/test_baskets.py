from __future__ import annotations

import itertools
import random
from collections import Counter

import pytest

from basketloom.operators import baskets


@pytest.fixture(scope="module")
def purchases(spark):
    rng = random.Random(9)
    items = [f"a{i}" for i in range(9)]
    data = []
    for order in range(120):
        for item in rng.choices(items, k=rng.randint(1, 6)):
            data.append((order, item))
    # The same basket many times over, a one-item basket, and lines without an aisle.
    data += [(o, i) for o in range(200, 300) for i in ("a1", "a2", "a2")]
    data += [(900, "a3"), (901, None), (902, None), (902, "a4")]
    return spark.createDataFrame(data, "order_id long, aisle string"), data


def brute(data):
    sets = {}
    for order, item in data:
        if item is not None:
            sets.setdefault(order, set()).add(item)
    kept = [sorted(s) for s in sets.values() if len(s) >= 2]
    single = Counter(i for s in kept for i in s)
    pair = Counter(p for s in kept for p in itertools.combinations(s, 2))
    return len(kept), single, pair


def test_counts_equal_brute_force(purchases, rows):
    df, data = purchases
    n, single, pair = brute(data)
    weighted = baskets.weighted_baskets(baskets.baskets(df))
    assert sum(r.weight for r in weighted.collect()) == n
    assert dict(rows(baskets.item_counts(weighted))) == dict(single)
    got = {(a, b): c for a, b, c in rows(baskets.item_pair_counts(weighted))}
    assert got == dict(pair)


def test_rules_equal_brute_force_and_lift_is_symmetric(purchases):
    df, data = purchases
    n, single, pair = brute(data)
    weighted = baskets.weighted_baskets(baskets.baskets(df))
    rules = {(r.antecedent, r.consequent): r for r in baskets.association_rules(weighted).collect()}
    assert len(rules) == 2 * len(pair)
    for (a, b), count in pair.items():
        for x, y in ((a, b), (b, a)):
            r = rules[x, y]
            assert r.support == pytest.approx(count / n)
            assert r.confidence == pytest.approx(count / single[x])
            assert r.lift == pytest.approx(count / single[x] / (single[y] / n))
        assert rules[a, b].lift == pytest.approx(rules[b, a].lift)


def test_default_thresholds_find_a_planted_pair(spark, rows):
    data = [(o, i) for o in range(30) for i in ("x", "y")]
    data += [(o, i) for o in range(30, 100) for i in ("p", "q", "r")[o % 2 :]] + [(99, "x")]
    weighted = baskets.weighted_baskets(
        baskets.baskets(spark.createDataFrame(data, "order_id long, aisle string"))
    )
    kept = baskets.filter_rules(baskets.association_rules(weighted))
    pairs = baskets.bundle_pairs(kept)
    # x is in 31 baskets, y in 30: y -> x has confidence 1 and is the direction kept.
    top = baskets.top_bundles(pairs).collect()[0]
    assert (top.antecedent, top.consequent, top.pair_count) == ("y", "x", 30)
    assert top.confidence == 1.0 and top.lift == pytest.approx(100 / 31)
    n = baskets.count_bundle_pairs(kept).collect()[0].n_pairs
    assert n == pairs.count() == len(set(rows(pairs, "item_a", "item_b")))
    edges = baskets.bundle_edges(pairs)
    degree = dict(rows(baskets.bundle_nodes(edges)))
    assert sum(degree.values()) == 2 * n and degree["y"] == 1
