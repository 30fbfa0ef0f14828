"""Row-level and order-level evaluation of scored candidates, and the frequency baseline."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import written_once
from .cleaning import rows_of, union_all
from .features import is_validation_user, train_orders
from .quantiles import exact_quantiles
from .running import running_totals, top_per_key, with_single_row

# List length of the fair comparison, ranks of recall@K, calibration bins, and the
# preference among models for diagnostics (best first).
TOP_K = 11
RANK_KS = (10, 20, 30)
CALIBRATION_BINS = 15
MODEL_PREFERENCE = ["boosted_b", "boosted_c", "boosted_a", "logistic"]


# --- row level ---------------------------------------------------------------------------------


def _by_score(scores: DataFrame, by: Sequence[str]) -> DataFrame:
    """Positives, negatives and rows per distinct score: all that ranking metrics need."""
    return (
        scores.groupBy(*by, F.col("prob").cast("double").alias("prob"))
        .agg(F.sum("label").cast("long").alias("pos"), F.count(F.lit(1)).alias("n"))
        .withColumn("neg", F.col("n") - F.col("pos"))
    )


def _metric_groups(scores: DataFrame) -> list[str]:
    return ["model"] if "model" in scores.columns else []


def score_counts(scores: DataFrame) -> DataFrame:
    """Positives, negatives and rows by distinct score, in blocks of neighbouring scores.

    Written once: scores are dealt by range, so blocks follow the data however many there are, and
    the block of a row is a stored number.
    """
    by = _metric_groups(scores)
    ranged = _by_score(scores, by).repartitionByRange(*by, "prob")
    return written_once(
        ranged.withColumn("_block", F.spark_partition_id().cast("long")), "score-counts"
    )


def _metrics_of(counts: DataFrame, metrics: Sequence[str]) -> DataFrame:
    """Metrics that are sums over distinct scores, from one pass along falling scores."""
    by = _metric_groups(counts)
    ranked = running_totals(
        counts,
        keys=by,
        block=-F.col("_block"),
        order=[F.desc("prob")],
        totals={"pos_upto": F.col("pos"), "neg_upto": F.col("neg"), "n_upto": F.col("n")},
    )
    pos, neg, n = (F.sum(c).cast("double") for c in ("pos", "neg", "n"))
    lost = F.sum(F.col("pos") * (F.col("neg_upto") - F.col("neg") / 2.0))
    p = F.col("prob")
    bounded = _bounded(p)
    found = {
        "auc": 1.0 - F.try_divide(lost, pos * neg),
        "average_precision": F.try_divide(
            F.sum(F.col("pos") * (F.col("pos_upto") / F.col("n_upto"))), pos
        ),
        "log_loss": -F.sum(F.col("pos") * F.ln(bounded) + F.col("neg") * F.ln(1.0 - bounded)) / n,
        "brier": F.sum(F.col("pos") * (1.0 - p) * (1.0 - p) + F.col("neg") * p * p) / n,
    }
    return ranked.groupBy(*by).agg(*[found[m].alias(m) for m in metrics])


def ranking_metrics(scores: DataFrame) -> DataFrame:
    """ROC AUC (ties averaged) and average precision (step sum) of (label, prob) rows.

    With a ``model`` column there is one row per model. Both metrics come from the same running
    counts over distinct scores, which are built block by block and never in one partition.
    """
    return _metrics_of(score_counts(scores), ["auc", "average_precision"])


def auc(scores: DataFrame) -> DataFrame:
    """Area under the ROC curve."""
    return ranking_metrics(scores).drop("average_precision")


def average_precision(scores: DataFrame) -> DataFrame:
    """Average precision."""
    return ranking_metrics(scores).drop("auc")


def _bounded(p: Column, epsilon: float = 2.220446049250313e-16) -> Column:
    return F.least(F.greatest(p, F.lit(epsilon)), F.lit(1.0 - epsilon))


def log_loss(scores: DataFrame, epsilon: float = 2.220446049250313e-16) -> DataFrame:
    """Mean negative log likelihood, probabilities kept ``epsilon`` away from 0 and 1."""
    p = _bounded(F.col("prob").cast("double"), epsilon)
    loss = -(F.col("label") * F.ln(p) + (1 - F.col("label")) * F.ln(1.0 - p))
    return scores.groupBy(*_metric_groups(scores)).agg(F.avg(loss).alias("log_loss"))


def brier(scores: DataFrame) -> DataFrame:
    """Mean squared difference of probability and label."""
    squared = F.pow(F.col("prob").cast("double") - F.col("label"), 2.0)
    return scores.groupBy(*_metric_groups(scores)).agg(F.avg(squared).alias("brier"))


def calibration_error(scores: DataFrame, bins: int = CALIBRATION_BINS) -> DataFrame:
    """Expected calibration error over equal-width bins, the last one closed."""
    by = _metric_groups(scores)
    place = F.least(F.floor(F.col("prob").cast("double") * bins), F.lit(bins - 1))
    binned = scores.groupBy(*by, place.alias("bin")).agg(
        F.count(F.lit(1)).alias("n"),
        F.abs(F.avg("label") - F.avg(F.col("prob").cast("double"))).alias("off"),
    )
    return binned.groupBy(*by).agg((F.sum(F.col("n") * F.col("off")) / F.sum("n")).alias("ece"))


def row_metrics(scores: DataFrame) -> DataFrame:
    """AUC, average precision, log loss, Brier score and calibration error, per model.

    All five come from one table of counts by score.
    """
    if "model" not in scores.columns:
        scores = scores.withColumn("model", F.lit("model"))
    counts = score_counts(scores)
    place = F.least(F.floor(F.col("prob") * CALIBRATION_BINS), F.lit(CALIBRATION_BINS - 1))
    binned = counts.groupBy("model", place.alias("bin")).agg(
        F.sum("n").alias("n"),
        F.abs(F.sum("pos") - F.sum(F.col("prob") * F.col("n"))).alias("off"),
    )
    ece = binned.groupBy("model").agg((F.sum("off") / F.sum("n")).alias("ece"))
    metrics = ["auc", "average_precision", "log_loss", "brier"]
    return _metrics_of(counts, metrics).join(ece, "model")


# --- order level -------------------------------------------------------------------------------


def validation_orders(orders: DataFrame, percent: int = 20) -> DataFrame:
    """Train orders of validation users: the orders every order-level metric averages over."""
    return train_orders(orders).where(is_validation_user(F.col("user_id"), percent))


def align_scores(scores: DataFrame, orders: DataFrame) -> DataFrame:
    """Candidate scores attached to the user's train order; users without one are dropped."""
    return scores.join(train_orders(orders), "user_id").select(
        "order_id", "product_id", *[c for c in ("model", "label", "prob") if c in scores.columns]
    )


def true_products(train_lines: DataFrame) -> DataFrame:
    """Distinct (order_id, product_id) of the orders to be predicted."""
    return train_lines.select("order_id", "product_id").distinct()


def with_hits(predicted: DataFrame, truth: DataFrame) -> DataFrame:
    """Predicted (order, product) rows with ``hit`` = 1 where the product was really bought."""
    found = truth.select("order_id", "product_id", F.lit(1).alias("hit"))
    return predicted.join(found, ["order_id", "product_id"], "left").na.fill({"hit": 0})


def set_scores(n_pred: Column, n_true: Column, n_hit: Column) -> dict[str, Column]:
    """Precision, recall and F1 of two sets from their sizes and the size of the overlap.

    Two empty sets agree fully (1, 1, 1); one empty set gives 0, 0, 0.
    """
    agree = (n_pred == 0) & (n_true == 0)

    def ratio(part: Column, whole: Column) -> Column:
        value = F.coalesce(F.try_divide(part.cast("double"), whole.cast("double")), F.lit(0.0))
        return F.when(agree, F.lit(1.0)).otherwise(value)

    return {
        "precision": ratio(n_hit, n_pred),
        "recall": ratio(n_hit, n_true),
        "f1": ratio(2 * n_hit, n_pred + n_true),
    }


def order_scores(
    orders: DataFrame, truth: DataFrame, sizes: DataFrame, dims: dict[str, Sequence] | None = None
) -> DataFrame:
    """Per validation order (and per value of each dimension): set sizes, precision, recall, F1.

    ``sizes`` holds n_pred and n_hit per order and dimension value. Orders that have no
    prediction or no truth are kept, because the list of orders drives the evaluation. ``dims``
    lists the values of each dimension; they are attached by exploding a literal array.
    """
    dims = dims or {}
    true_sizes = truth.groupBy("order_id").agg(F.count(F.lit(1)).alias("n_true"))
    frame = orders.select("order_id").join(true_sizes, "order_id", "left")
    for name, values in dims.items():
        frame = frame.withColumn(name, F.explode(F.array(*[F.lit(v) for v in values])))
    zero = F.lit(0)
    joined = frame.join(sizes, ["order_id", *dims], "left").select(
        "order_id",
        *dims,
        F.coalesce("n_pred", zero).alias("n_pred"),
        F.coalesce("n_true", zero).alias("n_true"),
        F.coalesce("n_hit", zero).alias("n_hit"),
    )
    return joined.withColumns(set_scores(F.col("n_pred"), F.col("n_true"), F.col("n_hit")))


def mean_scores(per_order: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Mean precision, recall and F1, and mean, median and 90th percentile of both set sizes."""
    sizes = per_order.select(
        *by,
        F.inline(
            F.array(
                F.struct(F.lit("pred").alias("side"), F.col("n_pred").alias("size")),
                F.struct(F.lit("true").alias("side"), F.col("n_true").alias("size")),
            )
        ),
    )
    ranks = exact_quantiles(sizes, "size", {"p50": 0.5, "p90": 0.9}, [*by, "side"], sizes=True)

    def pick(side: str, name: str) -> Column:
        return F.max(F.when(F.col("side") == side, F.col(name))).alias(f"{side}_size_{name}")

    spread = ranks.groupBy(*by).agg(
        pick("pred", "p50"), pick("pred", "p90"), pick("true", "p50"), pick("true", "p90")
    )
    means = per_order.groupBy(*by).agg(
        F.avg("precision").alias("precision"),
        F.avg("recall").alias("recall"),
        F.avg("f1").alias("f1"),
        F.avg("n_pred").alias("pred_size_mean"),
        F.avg("n_true").alias("true_size_mean"),
    )
    columns = [
        *by,
        "precision",
        "recall",
        "f1",
        "pred_size_mean",
        "pred_size_p50",
        "pred_size_p90",
        "true_size_mean",
        "true_size_p50",
        "true_size_p90",
    ]
    if by:
        return means.join(spread, list(by)).select(*columns)
    return with_single_row(means, spread).select(*columns)


def evaluate_thresholds(
    aligned: DataFrame, truth: DataFrame, orders: DataFrame, thresholds: Sequence[float]
) -> DataFrame:
    """Order-level scores of ``prob >= threshold``, one row per threshold, in one pass."""
    thresholds = [float(t) for t in thresholds]
    counted = (
        with_hits(aligned, truth)
        .groupBy("order_id")
        .agg(
            *[F.count_if(F.col("prob") >= t).alias(f"_p{i}") for i, t in enumerate(thresholds)],
            *[
                F.count_if((F.col("prob") >= t) & (F.col("hit") == 1)).alias(f"_h{i}")
                for i, t in enumerate(thresholds)
            ],
        )
    )
    sizes = counted.select(
        "order_id",
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(t).alias("threshold"),
                        F.col(f"_p{i}").alias("n_pred"),
                        F.col(f"_h{i}").alias("n_hit"),
                    )
                    for i, t in enumerate(thresholds)
                ]
            )
        ),
    )
    return mean_scores(
        order_scores(orders, truth, sizes, {"threshold": thresholds}), ["threshold"]
    )


def ranked_candidates(aligned: DataFrame, k: int, by: Sequence[str] = ()) -> DataFrame:
    """The ``k`` best products of every order with their rank; ties to the smaller product."""
    order = [F.desc("prob"), F.asc("product_id")]
    return top_per_key(aligned, [*by, "order_id"], order, k, rank="rank")


def _sizes(predicted: DataFrame, truth: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    return (
        with_hits(predicted, truth)
        .groupBy("order_id", *by)
        .agg(F.count(F.lit(1)).alias("n_pred"), F.sum("hit").alias("n_hit"))
    )


def evaluate_top_k(
    aligned: DataFrame,
    truth: DataFrame,
    orders: DataFrame,
    k: int = TOP_K,
    models: Sequence[str] | None = None,
) -> DataFrame:
    """Order-level scores of the ``k`` best products per order.

    With ``models``, the scores carry a ``model`` column and there is one row per listed model.
    """
    by = ["model"] if models else []
    sizes = _sizes(ranked_candidates(aligned, k, by), truth, by)
    per_order = order_scores(orders, truth, sizes, {"model": list(models)} if models else None)
    return mean_scores(per_order, by).withColumn("k", F.lit(k))


def recall_hit_at_k(
    aligned: DataFrame, truth: DataFrame, orders: DataFrame, ks: Sequence[int] = RANK_KS
) -> DataFrame:
    """Mean recall and hit rate within the first K products, over orders with some truth.

    Candidates are ranked once, to the largest K; all Ks are then conditional sums.
    """
    counted = (
        with_hits(ranked_candidates(aligned, max(ks)), truth)
        .groupBy("order_id")
        .agg(
            *[
                F.sum(F.when(F.col("rank") <= k, F.col("hit")).otherwise(0)).alias(f"_h{k}")
                for k in ks
            ]
        )
    )
    true_sizes = truth.groupBy("order_id").agg(F.count(F.lit(1)).alias("n_true"))
    per_order = (
        orders.select("order_id")
        .join(true_sizes, "order_id")
        .join(counted, "order_id", "left")
        .na.fill(0, [f"_h{k}" for k in ks])
    )
    means = per_order.agg(
        *[F.avg(F.col(f"_h{k}") / F.col("n_true")).alias(f"_r{k}") for k in ks],
        *[F.avg((F.col(f"_h{k}") > 0).cast("double")).alias(f"_a{k}") for k in ks],
    )
    return rows_of(
        means,
        [
            {
                "k": F.lit(k),
                "recall_at_k": F.coalesce(f"_r{k}", F.lit(0.0)),
                "hit_at_k": F.coalesce(f"_a{k}", F.lit(0.0)),
            }
            for k in ks
        ],
    )


def frequent_products(pairs: DataFrame, k: int = TOP_K) -> DataFrame:
    """Each user's ``k`` most bought prior products; ties to the smaller product.

    ``pairs`` holds user_id, product_id and up_buy_cnt.
    """
    order = [F.desc("up_buy_cnt"), F.asc("product_id")]
    return top_per_key(pairs.select("user_id", "product_id", "up_buy_cnt"), ["user_id"], order, k)


def baseline_order_scores(
    pairs: DataFrame, truth: DataFrame, orders: DataFrame, k: int = TOP_K
) -> DataFrame:
    """Per validation order: the frequency baseline against the truth.

    Only validation users' pairs are ranked.
    """
    wanted = pairs.join(orders.select("user_id"), "user_id", "left_semi")
    predicted = frequent_products(wanted, k).join(orders.select("user_id", "order_id"), "user_id")
    return order_scores(orders, truth, _sizes(predicted, truth))


def evaluate_baseline(
    pairs: DataFrame, truth: DataFrame, orders: DataFrame, k: int = TOP_K
) -> DataFrame:
    """Order-level scores, recall@k and hit@k of the frequency baseline: one row."""
    per_order = baseline_order_scores(pairs, truth, orders, k)
    some_truth = per_order.where(F.col("n_true") > 0)
    ranks = some_truth.agg(
        F.coalesce(F.avg(F.col("n_hit") / F.col("n_true")), F.lit(0.0)).alias("recall_at_k"),
        F.coalesce(F.avg((F.col("n_hit") > 0).cast("double")), F.lit(0.0)).alias("hit_at_k"),
    )
    return with_single_row(mean_scores(per_order), ranks).withColumn("k", F.lit(k))


def preferred_model(scores: DataFrame, preference: Sequence[str] = MODEL_PREFERENCE) -> DataFrame:
    """The most preferred model present in a long score table; unlisted ones come last."""
    rank = F.coalesce(
        F.nullif(
            F.array_position(F.array(*[F.lit(m) for m in preference]), F.col("model")), F.lit(0)
        ),
        F.lit(len(preference) + 1),
    )
    present = scores.select("model").distinct().withColumn("preference", rank.cast("int"))
    return present.orderBy("preference", "model").limit(1)


def method_summary(by_model: DataFrame, baseline: DataFrame) -> DataFrame:
    """Models and baseline side by side, best F1 first.

    ``by_model`` is ``evaluate_top_k`` with models, ``baseline`` is ``evaluate_baseline``.
    """
    columns = ["method", "precision", "recall", "f1", "pred_size_mean"]
    name = F.concat(F.col("model"), F.lit(" top-"), F.col("k").cast("string"))
    rows = union_all(
        [
            by_model.withColumn("method", name).select(*columns),
            baseline.withColumn(
                "method", F.concat(F.lit("baseline top-"), F.col("k").cast("string"))
            ).select(*columns),
        ]
    )
    return rows.orderBy(F.desc("f1"), F.asc("method"))


def blend_scores(
    left: DataFrame, right: DataFrame, left_weight: float = 0.2, right_weight: float = 0.8
) -> DataFrame:
    """Weighted sum of two models' scores per (user, product)."""
    keys = ["user_id", "product_id"]
    second = right.select(*keys, F.col("prob").alias("_other"))
    return left.join(second, keys).select(
        *keys,
        *[c for c in ("label",) if c in left.columns],
        (left_weight * F.col("prob") + right_weight * F.col("_other")).alias("prob"),
    )
