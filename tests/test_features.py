from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from basketloom.operators import features
from basketloom.operators.purchases import last_cumulative_day, with_cumulative_days


@pytest.fixture(scope="module")
def candidates(tables):
    return {(r.user_id, r.product_id): r for r in features.candidate_table(tables).collect()}


def test_user_and_product_features(tables):
    pairs = features.pair_totals(features.prior_details(tables))
    days = last_cumulative_day(with_cumulative_days(tables.orders))
    users = {r.user_id: r for r in features.user_features(pairs, days).collect()}
    assert set(users) == {1, 2}
    # Line-weighted mean gap: two lines with 0 days (first order) and two with 5.
    assert tuple(users[1])[1:] == (4, 3, 2, 0.25, 2.5, 12.0)
    products = {r.product_id: r for r in features.product_features(pairs).collect()}
    assert tuple(products[1])[1:] == (2, 1, 0.5, 1.0)
    assert tuple(products[2])[1:] == (2, 2, 0.0, 1.5)


def test_candidates_cover_every_prior_pair(candidates):
    assert set(candidates) == {(1, 1), (1, 2), (1, 4), (2, 2), (2, 3)}
    assert {k for k, r in candidates.items() if r.label == 1} == {(1, 1)}


def test_pair_features_and_recency(candidates):
    r = candidates[1, 1]
    assert (r.up_buy_cnt, r.up_reorder_cnt, r.up_first_order, r.up_last_order) == (2, 1, 1, 2)
    assert (r.up_reorder_ratio, r.up_freq, r.up_orders_since_last) == (0.5, 1.0, 0)
    # The anchor day is over all orders, the target order included: 12 - 5.
    assert r.up_days_since_last == 7.0
    assert candidates[1, 2].up_days_since_last == 12.0
    assert (r.als_dot, r.als_cos, r.aisle_id, r.department_id) == (0.0, 0.0, 1, 1)


def test_all_feature_columns_are_present(tables):
    table = features.candidate_table(tables)
    assert table.columns == ["user_id", "product_id", *[f for f in features.FEATURES if f[:2] in ("u_", "p_")],
                             *[f for f in features.FEATURES if f.startswith("up_") and f != "up_days_since_last"
                               and f != "up_freq"],
                             "up_freq", "up_days_since_last", "als_dot", "als_cos", "aisle_id",
                             "department_id", "label"]


def test_labelled_users_only(tables, rows):
    kept = features.candidate_table(tables, labelled_users_only=True)
    assert rows(kept.select("user_id").distinct()) == [(1,)]


def test_affinity_is_joined_and_defaults_to_zero(tables, spark):
    scores = spark.createDataFrame(
        [(1, 1, 0.7, 0.9)], "user_id long, product_id long, als_dot double, als_cos double"
    )
    got = {(r.user_id, r.product_id): r.als_dot for r in features.candidate_table(tables, scores).collect()}
    assert got[1, 1] == 0.7 and got[2, 3] == 0.0


def test_split_is_by_user_and_close_to_a_fifth(spark):
    users = spark.range(20_000).select(F.col("id").alias("user_id"))
    train, held = features.split_by_user(users.union(users))
    assert train.join(held, "user_id", "left_semi").count() == 0
    share = held.count() / 40_000
    assert 0.18 < share < 0.22


def test_positive_rate(tables):
    row = features.positive_rate(features.candidate_table(tables)).collect()[0]
    assert (row.n_candidates, row.n_positive) == (5, 1)
    assert row.positive_rate == pytest.approx(0.2) and row.positive_weight == pytest.approx(4.0)
