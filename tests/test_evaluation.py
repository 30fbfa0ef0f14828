from __future__ import annotations

import math
import random

import pytest
from pyspark.sql import functions as F

from basketloom.operators import evaluation as ev


def area(y, p):
    won = pairs = 0.0
    for a, pa in zip(y, p):
        for b, pb in zip(y, p):
            if a == 1 and b == 0:
                pairs += 1
                won += 1.0 if pa > pb else 0.5 if pa == pb else 0.0
    return won / pairs


def precision_steps(y, p):
    total, value, last = sum(y), 0.0, 0.0
    for cut in sorted(set(p), reverse=True):
        above = [a for a, b in zip(y, p) if b >= cut]
        value += (sum(above) / total - last) * (sum(above) / len(above))
        last = sum(above) / total
    return value


@pytest.fixture(scope="module")
def scored(spark):
    rng = random.Random(11)
    data = []
    for model, digits in (("coarse", 1), ("fine", 6)):
        for i in range(300):
            p = round(rng.random(), digits)
            data.append((model, int(rng.random() < 0.2 + p / 2), p))
    return spark.createDataFrame(data, "model string, label int, prob double"), data


def test_ranking_metrics_with_ties(scored):
    df, data = scored
    got = {r.model: r for r in ev.ranking_metrics(df).collect()}
    for model in ("coarse", "fine"):
        y, p = [d[1] for d in data if d[0] == model], [d[2] for d in data if d[0] == model]
        assert got[model].auc == pytest.approx(area(y, p))
        assert got[model].average_precision == pytest.approx(precision_steps(y, p))
        alone = ev.ranking_metrics(df.where(F.col("model") == model).drop("model")).collect()[0]
        assert alone.auc == pytest.approx(got[model].auc)


def test_row_metrics_against_plain_sums(scored):
    df, data = scored
    got = {r.model: r for r in ev.row_metrics(df).collect()}
    eps = 2.220446049250313e-16
    for model in ("coarse", "fine"):
        rows = [(y, p) for m, y, p in data if m == model]
        clipped = [(y, min(max(p, eps), 1 - eps)) for y, p in rows]
        loss = -sum(y * math.log(p) + (1 - y) * math.log(1 - p) for y, p in clipped) / len(rows)
        assert got[model].log_loss == pytest.approx(loss)
        assert got[model].brier == pytest.approx(sum((p - y) ** 2 for y, p in rows) / len(rows))


def test_calibration_bins(spark):
    data = [(0, 0.0), (1, 0.99), (1, 1.0), (0, 0.07), (0, 0.05)]
    df = spark.createDataFrame(data, "label int, prob double")
    bins = {}
    for y, p in data:
        bins.setdefault(min(int(p * 15), 14), []).append((y, p))
    want = sum(
        len(b) / len(data) * abs(sum(y for y, _ in b) / len(b) - sum(p for _, p in b) / len(b))
        for b in bins.values()
    )
    assert ev.calibration_error(df).collect()[0].ece == pytest.approx(want)
    constant = spark.range(8).select((F.col("id") % 4 == 0).cast("int").alias("label"), F.lit(0.25).alias("prob"))
    assert ev.calibration_error(constant).collect()[0].ece == pytest.approx(0.0)


@pytest.fixture(scope="module")
def orders(spark):
    """1 exact, 2 partial, 3 no prediction, 4 no truth, 5 neither."""
    ids = spark.createDataFrame([(i, 10 + i) for i in range(1, 6)], "order_id long, user_id long")
    truth = spark.createDataFrame(
        [(1, 1), (1, 2), (2, 1), (2, 2), (2, 3), (3, 1)], "order_id long, product_id long"
    )
    scores = spark.createDataFrame(
        [(1, 1, 0.9), (1, 2, 0.8), (2, 1, 0.9), (2, 9, 0.4), (4, 1, 0.9), (4, 2, 0.2)],
        "order_id long, product_id long, prob double",
    )
    return ids, truth, scores


def test_set_scores_per_order(orders):
    ids, truth, scores = orders
    sizes = ev._sizes(scores, truth)
    got = {r.order_id: (r.precision, r.recall, r.f1) for r in ev.order_scores(ids, truth, sizes).collect()}
    assert got[1] == (1.0, 1.0, 1.0) and got[5] == (1.0, 1.0, 1.0)
    assert got[3] == (0.0, 0.0, 0.0) and got[4] == (0.0, 0.0, 0.0)
    assert got[2] == pytest.approx((0.5, 1 / 3, 0.4))
    assert all(f1 <= (p + r) / 2 + 1e-12 for p, r, f1 in got.values())


def test_one_pass_over_thresholds_equals_single_runs(orders):
    ids, truth, scores = orders
    together = {r.threshold: r for r in ev.evaluate_thresholds(scores, truth, ids, [0.3, 0.85, 0.95]).collect()}
    for t in (0.3, 0.85, 0.95):
        kept = scores.where(F.col("prob") >= t)
        alone = ev.mean_scores(ev.order_scores(ids, truth, ev._sizes(kept, truth))).collect()[0]
        assert [together[t][c] for c in alone.asDict()] == pytest.approx(list(alone.asDict().values()))
    # Nothing is predicted at 0.95: the two orders without truth are empty on both sides.
    assert together[0.95].f1 == pytest.approx(0.4) and together[0.95].true_size_p50 == 1.0


def test_top_k_takes_short_lists_and_breaks_ties_by_product(spark, orders):
    ids, truth, _ = orders
    tied = spark.createDataFrame([(1, p, 0.5) for p in (5, 2, 1)], "order_id long, product_id long, prob double")
    assert [r.product_id for r in ev.ranked_candidates(tied, 2).orderBy("rank").collect()] == [1, 2]
    row = ev.evaluate_top_k(tied, truth, ids, k=11).collect()[0]
    assert (row.pred_size_mean, row.pred_size_p90, row.k) == (0.6, pytest.approx(1.8), 11)


def test_recall_skips_orders_without_truth_and_rises_with_k(orders):
    ids, truth, scores = orders
    got = {r.k: r for r in ev.recall_hit_at_k(scores, truth, ids, (1, 2, 3)).collect()}
    assert got[1].recall_at_k == pytest.approx((1 / 2 + 1 / 3 + 0) / 3)
    assert got[2].recall_at_k == pytest.approx((1 + 1 / 3 + 0) / 3)
    assert got[1].recall_at_k <= got[2].recall_at_k <= got[3].recall_at_k
    assert got[3].hit_at_k == pytest.approx(2 / 3)


def test_baseline_predicts_the_most_bought_products(spark, orders):
    ids, truth, _ = orders
    pairs = [(11, p, 3) for p in range(1, 15)] + [(12, 9, 1), (12, 1, 2), (99, 1, 1)]
    df = spark.createDataFrame(pairs, "user_id long, product_id long, up_buy_cnt long")
    per_order = {r.order_id: r for r in ev.baseline_order_scores(df, truth, ids).collect()}
    assert (per_order[1].n_pred, per_order[1].n_hit) == (11, 2)
    assert (per_order[2].n_pred, per_order[2].n_hit) == (2, 1)
    row = ev.evaluate_baseline(df, truth, ids).collect()[0]
    assert row.recall_at_k == pytest.approx((1 + 1 / 3 + 0) / 3)
    # Orders 4 and 5 have neither predictions nor truth here and count as 1.
    assert row.f1 == pytest.approx((4 / 13 + 2 / 5 + 0 + 1 + 1) / 5)
    summary = ev.method_summary(
        ev.evaluate_top_k(df.selectExpr("user_id - 10 AS order_id", "product_id", "0.5D AS prob", "'m' AS model"),
                          truth, ids, models=["m"]),
        ev.evaluate_baseline(df, truth, ids),
    ).collect()
    assert [r.method for r in summary] == ["baseline top-11", "m top-11"]


def test_preference_and_blend(spark):
    names = spark.createDataFrame([("logistic",), ("boosted_a",), ("other",)], "model string")
    assert ev.preferred_model(names).collect()[0].model == "boosted_a"
    left = spark.createDataFrame([(1, 1, 1, 0.5), (1, 2, 0, 0.1)], "user_id int, product_id int, label int, prob double")
    right = spark.createDataFrame([(1, 2, 0.6), (1, 1, 0.25)], "user_id int, product_id int, prob double")
    got = {r.product_id: r.prob for r in ev.blend_scores(left, right).collect()}
    assert got == pytest.approx({1: 0.3, 2: 0.5})
