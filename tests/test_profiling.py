from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from basketloom.operators import profiling as pr
from basketloom.operators import purchases as buy
from basketloom.operators import segments as seg


@pytest.fixture(scope="module")
def split(tables):
    purchases = buy.purchase_table(tables)
    targets = buy.target_orders(tables.orders, purchases)
    return buy.history_rows(purchases, targets), buy.target_rows(purchases, targets), targets


def test_category_shares_count_nulls_and_round_half_even(spark, rows):
    df = spark.createDataFrame([("a",)] * 5 + [(None,)] * 3, "c string")
    assert rows(pr.category_shares(df, "c")) == [("a", 5, 0.625), (None, 3, 0.375)]


def test_shares_by_user_group(tables, rows):
    got = rows(pr.line_share_by_group(tables.prior, tables.orders))
    assert got == [("test", 2, 1, 0.3333), ("train", 4, 1, 0.6667)]


def test_coverage_and_sets(tables, rows):
    coverage = {r.threshold: r for r in pr.order_count_coverage(tables.orders).collect()}
    assert coverage[2].n_users == 2 and coverage[3].share == pytest.approx(1 / 3)
    assert coverage[30].n_users == 0
    assert rows(pr.eval_sets_per_user(tables.orders)) == [
        (1, ["prior", "train"]), (2, ["prior", "test"]), (3, ["train"])]


def test_recency_curve_keeps_empty_bins(split):
    got = {r.bin: r for r in pr.recency_curve(*split).collect()}
    assert len(got) == 9 and got["0"].n_pairs == 0 and got["0"].purchase_prob is None
    # Pairs of user 1: product 1 and 4 one order back, product 2 two orders back.
    assert (got["1"].n_pairs, got["1"].purchase_prob) == (2, 0.5)
    assert (got["2"].n_pairs, got["2"].purchase_prob) == (1, 0.0)


def test_count_of_counts_has_a_tail(spark, rows):
    pairs = spark.createDataFrame([(1,), (1,), (20,), (21,), (50,)], "up_buy_cnt long")
    got = dict(rows(pr.count_of_counts(pairs)))
    assert got[1] == 2 and got[20] == 1 and got[21] == 2 and len(got) == 21 and got[5] == 0


def test_null_categories_are_left_out(spark, rows):
    data = [(1, "d", 1, 1), (1, "d", 2, 0), (1, "d", 1, 0), (None, None, 3, 1)]
    df = spark.createDataFrame(data, "department_id int, department string, user_id long, reordered int")
    assert rows(pr.department_summary(df)) == [(1, "d", 3, 2, pytest.approx(1 / 3))]


def test_minimum_support_and_order(spark):
    df = spark.createDataFrame(
        [(1, "a", u, 1) for u in range(3)] + [(2, "b", 1, 1)], "aisle_id int, aisle string, user_id long, reordered int"
    )
    assert [r.aisle for r in pr.top_aisles_by_reorder(df, min_count=2).collect()] == ["a"]
    assert [r.aisle for r in pr.top_aisles_by_count(df).collect()] == ["a", "b"]


def test_segment_features_weigh_orders_equally(tables, split):
    got = {r.user_id: r for r in seg.segment_features(split[0], tables.orders).collect()}
    assert set(got) == {1}
    r = got[1]
    assert (r.u_hist_orders, r.u_mean_days_between_orders, r.u_mean_basket_size) == (2, 2.5, 2.0)
    assert (r.u_reorder_rate, r.u_unique_products) == (0.25, 3)


def test_cross_sell_takes_the_largest_shares(spark, split):
    segments = spark.createDataFrame([(1, 0)], "user_id long, segment int")
    top = seg.cross_sell(split[0], segments, 2).orderBy(F.desc("share")).collect()
    assert [(r.aisle, r.purchase_count, r.segment_total, r.share) for r in top] == [
        ("fruit", 2, 4, 0.5), (" MISSING\t", 1, 4, 0.25)]
