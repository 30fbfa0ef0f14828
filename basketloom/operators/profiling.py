"""Profiling tables over orders, purchases and the target/history split."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import label_for_bin, recency_bin
from ..functions.columns import RECENCY_LABELS
from .cleaning import rows_of, union_all
from .purchases import last_orders
from .quantiles import (
    Measure,
    exact_quantiles,
    histogram,
    narrowed_quantiles,
    quantiles_of_counts,
    tail_summary,
    tails_of_columns,
    value_counts,
)
from .running import top_overall

# Thresholds of the coverage report, and the three quantiles of distribution plots.
COVERAGE_THRESHOLDS = [2, 3, 5, 10, 20, 30]
PLOT_PROBS = {"q50": 0.5, "q90": 0.9, "q99": 0.99}


def category_shares(df: DataFrame, category: str) -> DataFrame:
    """Rows per value (null included) and their share of all rows, rounded half-even to 4."""
    counted = df.groupBy(category).agg(F.count(F.lit(1)).alias("n"))
    total = counted.agg(F.sum("n")).scalar()
    return counted.withColumn("share", F.bround(F.col("n") / total, 4))


def eval_sets_per_user(orders: DataFrame) -> DataFrame:
    """Sorted distinct eval_set values per user (at most three)."""
    return orders.groupBy("user_id").agg(F.array_sort(F.collect_set("eval_set")).alias("eval_sets"))


def user_groups(orders: DataFrame) -> DataFrame:
    """(user_id, user_group): the eval_set of each user's last order."""
    return last_orders(orders).select("user_id", F.col("eval_set").alias("user_group"))


def line_share_by_group(lines: DataFrame, orders: DataFrame) -> DataFrame:
    """Lines and users per user group, with the share of all lines.

    Lines are first counted per order and then per user, so the join with the groups sees one row
    per user instead of the raw lines.
    """
    per_order = lines.groupBy("order_id").agg(F.count(F.lit(1)).alias("lines"))
    per_user = (
        per_order.join(orders.select("order_id", "user_id"), "order_id")
        .groupBy("user_id")
        .agg(F.sum("lines").alias("lines"))
    )
    grouped = (
        per_user.join(user_groups(orders), "user_id", "left")
        .groupBy("user_group")
        .agg(F.sum("lines").alias("n_lines"), F.count(F.lit(1)).alias("n_users"))
    )
    total = grouped.agg(F.sum("n_lines")).scalar()
    return grouped.withColumn("share", F.bround(F.col("n_lines") / total, 4))


def user_order_counts(orders: DataFrame) -> DataFrame:
    """Largest order_number per user over all orders."""
    return orders.groupBy("user_id").agg(F.max("order_number").alias("u_all_orders"))


def order_count_coverage(
    orders: DataFrame, thresholds: Sequence[int] = COVERAGE_THRESHOLDS
) -> DataFrame:
    """Users with at least so many orders, per threshold; all thresholds in one pass."""
    counted = user_order_counts(orders).agg(
        F.count(F.lit(1)).alias("_all"),
        *[F.count_if(F.col("u_all_orders") >= t).alias(f"_t{t}") for t in thresholds],
    )
    return rows_of(
        counted,
        [
            {
                "threshold": F.lit(t),
                "n_users": F.col(f"_t{t}"),
                "share": F.try_divide(F.col(f"_t{t}"), F.col("_all")),
            }
            for t in thresholds
        ],
    )


def basket_sizes(purchases: DataFrame) -> DataFrame:
    """Lines per order."""
    return purchases.groupBy("order_id").agg(F.count(F.lit(1)).alias("basket_size"))


def basket_size_stats(purchases: DataFrame) -> DataFrame:
    """Mean, median and 90th percentile of the basket size, from one table of sizes."""
    counts = value_counts(basket_sizes(purchases), "basket_size")
    mean = counts.agg((F.sum(F.col("value") * F.col("n")) / F.sum("n"))).scalar()
    ranks = quantiles_of_counts(counts, {"median": 0.5, "p90": 0.9}, sizes=True)
    return ranks.select(mean.alias("mean"), "median", "p90")


def pair_counts(history: DataFrame) -> DataFrame:
    """Purchases per (user, product) in history, with the last order_number."""
    return history.groupBy("user_id", "product_id").agg(
        F.count(F.lit(1)).alias("up_buy_cnt"), F.max("order_number").alias("up_last_order")
    )


def candidate_sizes(history: DataFrame) -> DataFrame:
    """Distinct products per user in history."""
    return history.groupBy("user_id").agg(F.count_distinct("product_id").alias("n_products"))


def _measure(df: DataFrame, name: str, column: str | Column) -> DataFrame:
    value = F.col(column) if isinstance(column, str) else column
    return df.select(F.lit(name).alias("measure"), value.cast("double").alias("value"))


def long_tail_summary(orders: DataFrame, history: DataFrame, target: DataFrame) -> DataFrame:
    """Tail summary of the five behavioural measures, one row each.

    First-order gaps count as 0 days, as everywhere in profiling.
    """
    sizes = union_all(
        [
            _measure(user_order_counts(orders), "user_orders", "u_all_orders"),
            _measure(basket_sizes(target), "target_basket_size", "basket_size"),
            _measure(candidate_sizes(history), "history_products_per_user", "n_products"),
            _measure(pair_counts(history), "pair_purchases", "up_buy_cnt"),
        ]
    )
    gaps = Measure(orders, F.coalesce("days_since_prior_order", F.lit(0.0)))
    # Gaps may be fractions of days: as many values as there are orders.
    return tail_summary(sizes).unionByName(tails_of_columns({"days_since_prior_order": gaps}))


def distribution(df: DataFrame, value: str, bins: int = 80, log1p: bool = False) -> DataFrame:
    """Histogram data of a column; see ``quantiles.histogram``. Drawing is left to the caller."""
    return histogram(df, value, bins, log1p)


def plot_quantiles(df: DataFrame, value: str, sizes: bool = False) -> DataFrame:
    """The median, 90th and 99th percentile marked on distribution plots."""
    return exact_quantiles(df, value, PLOT_PROBS, sizes=sizes)


def count_of_counts(pairs: DataFrame, top: int = 20) -> DataFrame:
    """Number of pairs bought 1, 2, ... ``top`` times, and more often (k = top + 1)."""
    counted = pairs.groupBy(
        F.least(F.col("up_buy_cnt"), F.lit(top + 1)).cast("int").alias("k")
    ).agg(F.count(F.lit(1)).alias("n_pairs"))
    frame = _literal_ints(pairs, "k", 1, top + 1)
    return frame.join(counted, "k", "left").select(
        "k", F.coalesce("n_pairs", F.lit(0)).alias("n_pairs")
    )


def _literal_ints(df: DataFrame, name: str, first: int, last: int) -> DataFrame:
    return df.sparkSession.range(first, last + 1, numPartitions=1).select(
        F.col("id").cast("int").alias(name)
    )


def recency_curve(history: DataFrame, target: DataFrame, targets: DataFrame) -> DataFrame:
    """Share of history pairs bought again in the target order, by orders since last purchase.

    Empty bins are kept with a null probability.
    """
    bought = target.select("user_id", "product_id").distinct().withColumn("label", F.lit(1))
    binned = (
        pair_counts(history)
        .join(bought, ["user_id", "product_id"], "left")
        .join(targets.select("user_id", "target_order_number"), "user_id", "left")
        .withColumn("bin_ord", recency_bin(F.col("target_order_number") - F.col("up_last_order")))
        .where(F.col("bin_ord").isNotNull())
        .groupBy("bin_ord")
        .agg(
            F.avg(F.coalesce("label", F.lit(0))).alias("purchase_prob"),
            F.count(F.lit(1)).alias("n_pairs"),
        )
    )
    frame = _literal_ints(history, "bin_ord", 0, len(RECENCY_LABELS) - 1)
    return frame.join(binned, "bin_ord", "left").select(
        "bin_ord",
        label_for_bin(F.col("bin_ord")).alias("bin"),
        "purchase_prob",
        F.coalesce("n_pairs", F.lit(0)).alias("n_pairs"),
    )


def orders_by_hour(orders: DataFrame) -> DataFrame:
    """Orders per hour of day."""
    return orders.groupBy("order_hour_of_day").agg(F.count(F.lit(1)).alias("n_orders"))


def busiest_hours(orders: DataFrame, n: int = 5) -> DataFrame:
    """The hours with most orders (ties to the earlier hour)."""
    return top_overall(
        orders_by_hour(orders), [F.desc("n_orders"), F.asc("order_hour_of_day")], n
    )


def gap_quantiles(orders: DataFrame) -> DataFrame:
    """Median, 90th and 99th percentile of gap days, first orders counting as 0."""
    gaps = Measure(orders, F.coalesce("days_since_prior_order", F.lit(0.0)))
    found = narrowed_quantiles([gaps], list(PLOT_PROBS.values()))
    schema = ", ".join(f"{name} double" for name in PLOT_PROBS)
    return orders.sparkSession.createDataFrame([tuple(found[0])], schema)


def product_popularity(history: DataFrame) -> DataFrame:
    """Purchases and reorder ratio per product."""
    return history.groupBy("product_id").agg(
        F.count(F.lit(1)).alias("p_total_purchases"), F.avg("reordered").alias("p_reorder_ratio")
    )


def product_popularity_quantiles(history: DataFrame) -> DataFrame:
    """Quantiles of both product measures, one row each."""
    products = product_popularity(history)
    long = union_all(
        _measure(products, name, name) for name in ("p_total_purchases", "p_reorder_ratio")
    )
    return exact_quantiles(long, "value", PLOT_PROBS, ["measure"])


def category_summary(history: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Purchases, distinct users and reorder ratio per category; null keys are left out.

    Rows are combined per (category, user) first, so one very common category is reduced in
    many tasks before its few partial rows meet.
    """
    named = history
    for key in keys:
        named = named.where(F.col(key).isNotNull())
    per_user = named.groupBy(*keys, "user_id").agg(
        F.count(F.lit(1)).alias("lines"),
        F.sum("reordered").alias("reordered"),
        F.count("reordered").alias("known"),
    )
    return per_user.groupBy(*keys).agg(
        F.sum("lines").alias("purchase_count"),
        F.count("user_id").alias("unique_users"),
        F.try_divide(F.sum("reordered").cast("double"), F.sum("known").cast("double")).alias(
            "reorder_ratio"
        ),
    )


def department_summary(history: DataFrame) -> DataFrame:
    return category_summary(history, ["department_id", "department"])


def aisle_summary(history: DataFrame) -> DataFrame:
    return category_summary(history, ["aisle_id", "aisle"])


def top_aisles_by_count(history: DataFrame, n: int = 15) -> DataFrame:
    """The aisles with most purchases (ties to the smaller id)."""
    return top_overall(aisle_summary(history), [F.desc("purchase_count"), F.asc("aisle_id")], n)


def top_aisles_by_reorder(history: DataFrame, n: int = 15, min_count: int = 1000) -> DataFrame:
    """The most reordered aisles among those with at least ``min_count`` purchases."""
    kept = aisle_summary(history).where(F.col("purchase_count") >= min_count)
    return top_overall(kept, [F.desc("reorder_ratio"), F.asc("aisle_id")], n)
