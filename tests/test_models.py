from __future__ import annotations

import math
import random

import pytest
from pyspark.sql import functions as F

from basketloom.operators import affinity, evaluation, features, models
from basketloom.operators import segments as seg

PLANTED = ["signal", "noise", "constant"]


@pytest.fixture(scope="module")
def planted(spark):
    """Labels decided by one feature; users 0-79 for fitting, 80-99 held out."""
    rng = random.Random(4)
    data = []
    for user in range(100):
        for product in range(8):
            signal = rng.random()
            data.append((user, product, int(signal > 0.8), signal, rng.random(), 1.0))
    df = spark.createDataFrame(
        data,
        "user_id long, product_id long, label int, signal double, noise double, constant double",
    )
    return df.where("user_id < 80"), df.where("user_id >= 80")


def area(scores):
    return evaluation.auc(scores.drop("model")).collect()[0].auc


def test_standardize_uses_population_deviation_of_the_fit_part(spark):
    fit = spark.createDataFrame([(1.0, 5.0), (3.0, 5.0)], "a double, b double")
    new = spark.createDataFrame([(4.0, 6.0)], "a double, b double")
    assert tuple(seg.standardize(new, ["a", "b"], fit_on=fit).collect()[0]) == (2.0, 1.0)
    assert sorted(tuple(r) for r in seg.standardize(fit, ["a", "b"]).collect()) == [(-1.0, 0.0), (1.0, 0.0)]


def test_class_weights(spark):
    df = spark.createDataFrame([(1,), (0,), (0,), (0,)], "label int")
    balanced = {r.label: r.weight for r in models.balanced_weights(df).collect()}
    assert balanced == pytest.approx({1: 2.0, 0: 4 / 6})
    assert {r.label: r.weight for r in models.positive_weights(df).collect()} == pytest.approx({1: 3.0, 0: 1.0})


@pytest.mark.parametrize("fit", [models.logistic_scores, models.perceptron_scores])
def test_classifiers_find_the_planted_feature(planted, fit):
    small = models.Network(hidden=(8, 4), epochs=60, batch_rows=64, step=0.01)
    more = {"preset": small} if fit is models.perceptron_scores else {}
    scores = fit(*planted, features=PLANTED, **more)
    got = scores.collect()
    assert len(got) == 160 and all(0.0 <= r.prob <= 1.0 for r in got)
    assert area(scores) > 0.9


def test_boosted_trees_importance_and_curve(planted):
    fitted = models.fit_trees(
        *planted, models.BOOSTED_C, features=PLANTED, categorical=[], rounds=6
    )
    scores = fitted.scores("boosted_c")
    assert area(scores) > 0.9
    importance = fitted.importance(2).collect()
    assert importance[0].feature == "signal" and len(importance) == 2
    curve = fitted.training_curve().orderBy("iteration").collect()
    assert [r.iteration for r in curve] == list(range(6)) and sum(r.is_best for r in curve) == 1
    losses = [r.train_logloss for r in curve]
    assert losses == sorted(losses, reverse=True)
    # The best round of the curve is the model that scores.
    best = next(r for r in curve if r.is_best)
    assert best.validation_auc == max(r.validation_auc for r in curve)
    assert best.iteration + 1 == len(fitted.ensemble.trees)
    assert best.validation_auc == pytest.approx(area(scores))
    weighted = models.positive_weights(planted[1], rate_from=planted[0])
    rows = scores.join(weighted.select("user_id", "product_id", "weight"), ["user_id", "product_id"])
    rows = rows.collect()
    loss = sum(-r.weight * math.log(r.prob if r.label else 1 - r.prob) for r in rows)
    assert best.validation_logloss == pytest.approx(loss / sum(r.weight for r in rows))


def test_later_worse_rounds_are_not_used(planted):
    train, held = planted
    wrong = held.withColumn("label", 1 - F.col("label"))
    fitted = models.fit_trees(
        train, wrong, models.BoostedTrees(rounds=200, patience=3), PLANTED, categorical=[]
    )
    curve = [area for _, area in fitted.ensemble.held_curve]
    assert len(fitted.ensemble.trees) - 1 == curve.index(max(curve)) == len(curve) - 4


def test_categorical_ids_unseen_in_training_are_kept(planted):
    train, held = planted
    train = train.withColumn("aisle_id", (F.col("product_id") % 3).cast("int"))
    held = held.withColumn("aisle_id", F.lit(99))
    fitted = models.fit_trees(
        train, held, features=[*PLANTED, "aisle_id"], categorical=["aisle_id"], rounds=2
    )
    assert fitted.scores("x").count() == 160


def test_missing_features_fail_before_any_job(planted):
    with pytest.raises(KeyError, match="als_dot"):
        models.logistic_scores(*planted, features=[*PLANTED, "als_dot"])


def test_presets_are_the_three_named_ones():
    assert set(models.PRESETS) == {"boosted_a", "boosted_b", "boosted_c"}
    assert set(features.CATEGORICAL_FEATURES) <= set(features.FEATURES)
    assert len(features.FEATURES) == 23


@pytest.fixture(scope="module")
def blobs(spark):
    rng = random.Random(8)
    centres = [(1, 5.0, 3.0, 0.1, 5), (10, 2.0, 3.0, 0.9, 8), (40, 9.0, 20.0, 0.5, 90), (90, 1.0, 6.0, 0.7, 40)]
    data = []
    for c, centre in enumerate(centres):
        for i in range(15):
            data.append((c * 100 + i, *[float(x) * (1 + 0.02 * rng.random()) for x in centre]))
    names = ", ".join(f"{c} double" for c in seg.SEGMENT_FEATURES)
    return spark.createDataFrame(data, f"user_id long, {names}")


def test_segments_are_stable_and_ordered_by_activity(blobs):
    got = {r.user_id: r.segment for r in seg.user_segments(blobs, restarts=4).collect()}
    assert got == {u: u // 100 for u in got} and len(got) == 60
    profile = seg.segment_profile(seg.user_segments(blobs, restarts=4)).orderBy("segment").collect()
    assert [r.n_users for r in profile] == [15] * 4


def test_inertia_does_not_rise_with_k(blobs):
    curve = seg.elbow_table(seg.scaled_segment_features(blobs), ks=[2, 4, 6], restarts=4)
    inertia = [r.inertia for r in curve.orderBy("k").collect()]
    assert inertia == sorted(inertia, reverse=True)


@pytest.mark.parametrize("reindex", [False, True])
def test_affinity_is_higher_inside_a_block(spark, reindex):
    shift = 2**35 if reindex else 0
    data = [
        (shift + u, shift + p, 3)
        for u in range(12)
        for p in range(8)
        if (u < 6) == (p < 4) and (u + p) % 5
    ]
    cross = [(shift + u, shift + p, 1) for u, p in ((0, 5), (7, 1), (8, 2))]
    df = spark.createDataFrame(data + cross, "user_id long, product_id long, up_buy_cnt long")
    got = affinity.affinity_features(df, reindex=reindex, rank=4, iterations=5).collect()
    assert len(got) == len(data) + len(cross)
    assert all(math.isfinite(r.als_dot) and abs(r.als_cos) <= 1 + 1e-6 for r in got)
    inside = [r.als_dot for r in got if ((r.user_id - shift) < 6) == ((r.product_id - shift) < 4)]
    outside = [r.als_dot for r in got if ((r.user_id - shift) < 6) != ((r.product_id - shift) < 4)]
    assert sum(inside) / len(inside) > sum(outside) / len(outside)


def test_affinity_without_factors_is_zero(spark):
    base = spark.createDataFrame([(1, 1, 2), (2, 1, 1)], "user_id long, product_id long, up_buy_cnt long")
    model = affinity.fit_factors(base, rank=2, iterations=2)
    unseen = spark.createDataFrame([(1, 9)], "user_id long, product_id long")
    row = affinity.score_affinity(unseen, model).collect()[0]
    assert (row.als_dot, row.als_cos) == (0.0, 0.0)


def test_blocks_and_cells_follow_the_pairs():
    assert [affinity.factor_blocks(n) for n in (0, 1000, 64 << 20)] == [6, 6, 8]
    assert [affinity.cells_a_side(n) for n in (0, 1000, 32 << 20)] == [3, 3, 4]


def test_every_pair_has_the_scores_of_its_own_factors(spark):
    rng = random.Random(4)
    pairs = {(rng.randrange(40), rng.randrange(30)) for _ in range(400)}
    df = spark.createDataFrame([(u, i, 1) for u, i in pairs], "user_id long, product_id long, up_buy_cnt long")
    model = affinity.fit_factors(df, rank=3, iterations=2)
    users = {r.id: r.features for r in model.userFactors.collect()}
    items = {r.id: r.features for r in model.itemFactors.collect()}
    asked = df.unionByName(spark.createDataFrame([(99, 1, 1), (None, 2, 1)], df.schema))
    scored = affinity.score_affinity(asked, model)
    assert "features" not in scored.columns and scored.count() == len(pairs) + 2
    for r in scored.collect():
        u, i = users.get(r.user_id), items.get(r.product_id)
        dot = sum(a * b for a, b in zip(u, i, strict=True)) if u and i else 0.0
        size = math.sqrt(sum(a * a for a in u) * sum(b * b for b in i)) if u and i else 1.0
        assert math.isclose(r.als_dot, dot, rel_tol=1e-9, abs_tol=1e-12)
        assert math.isclose(r.als_cos, dot / max(size, 1e-8), rel_tol=1e-9, abs_tol=1e-12)


def test_scales_equal_the_lazy_ones_and_constants_become_0(spark):
    rows = [(i, 1e9 + i % 7, 0.1, float(i) if i % 5 else None) for i in range(400)]
    df = spark.createDataFrame(rows, "id long, a double, b double, c double").repartition(6)
    scales = seg.fitted_scales(df, ["a", "b", "c"])
    values = [float(i) for i in range(400) if i % 5]
    mean = sum(values) / len(values)
    assert scales["b"] == (0.1, 1.0)
    assert scales["c"] == pytest.approx((mean, math.sqrt(sum((v - mean) ** 2 for v in values) / len(values))))
    assert scales["a"][1] == pytest.approx(df.agg(F.stddev_pop(F.col("a") - 1e9)).first()[0])
    got = {r.id: r for r in seg.rescaled(df, scales).collect()}
    for r in seg.standardize(df, ["a", "b", "c"]).collect():
        assert tuple(got[r.id]) == pytest.approx(tuple(r)) and r.b == 0.0
        assert (r.c is None) == (r.id % 5 == 0)
    assert seg.fitted_scales(df.where("id < 0"), ["a"]) == {"a": (None, None)}


def test_logistic_caches_its_rows_once(planted, monkeypatch):
    # The fit caches blocks of vectors; the rows they are made from were cached beside them.
    train, held = planted

    def persist(self, *args):
        raise AssertionError("rows cached twice")

    monkeypatch.setattr(type(train), "persist", persist)
    monkeypatch.setattr(type(train), "cache", persist)
    assert models.logistic_scores(train, held, features=PLANTED).count() == 160
