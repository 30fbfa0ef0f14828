"""Association rules between aisles that share baskets."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .running import first_per_key, top_overall


def basket_items(purchases: DataFrame, item: str = "aisle") -> DataFrame:
    """Distinct (order_id, item) pairs, null items dropped."""
    return (
        purchases.where(F.col(item).isNotNull())
        .select("order_id", F.col(item).cast("string").alias("item"))
        .distinct()
    )


def baskets(purchases: DataFrame, item: str = "aisle", min_items: int = 2) -> DataFrame:
    """Sorted distinct items per order, for orders with at least ``min_items`` of them.

    A basket is never longer than the list of items in the catalogue (aisles), however many lines
    its order has, because the items are distinct before they are gathered.
    """
    gathered = basket_items(purchases, item).groupBy("order_id").agg(
        F.array_sort(F.collect_list("item")).alias("basket")
    )
    return gathered.where(F.size("basket") >= min_items)


def weighted_baskets(orders: DataFrame) -> DataFrame:
    """Each distinct basket once, with the number of orders that have it."""
    return orders.groupBy("basket").agg(F.count(F.lit(1)).alias("weight"))


def item_counts(weighted: DataFrame) -> DataFrame:
    """Baskets that hold each item."""
    return (
        weighted.select(F.explode("basket").alias("item"), "weight")
        .groupBy("item")
        .agg(F.sum("weight").alias("item_count"))
    )


def item_pair_counts(weighted: DataFrame) -> DataFrame:
    """Baskets that hold both items, for every pair item_a < item_b that occurs.

    Equal baskets were merged before, so a popular combination is expanded once, not once per
    order. The pairs of a basket are summed in the task that makes them: only partial sums, at
    most one per pair of catalogue items and task, are exchanged.
    """
    heads = weighted.select("basket", "weight", F.posexplode("basket").alias("at", "item_a"))
    rest = F.slice("basket", F.col("at") + 2, F.size("basket"))
    return (
        heads.select("item_a", "weight", F.explode(rest).alias("item_b"))
        .groupBy("item_a", "item_b")
        .agg(F.sum("weight").alias("pair_count"))
    )


def association_rules(weighted: DataFrame) -> DataFrame:
    """Both directed rules of every pair, with support, confidence and lift."""
    counts = item_counts(weighted)
    n_baskets = weighted.agg(F.sum("weight")).scalar()
    paired = (
        item_pair_counts(weighted)
        .join(counts.select(F.col("item").alias("item_a"), F.col("item_count").alias("n_a")), "item_a")
        .join(counts.select(F.col("item").alias("item_b"), F.col("item_count").alias("n_b")), "item_b")
        .withColumn("n", n_baskets)
    )

    def rule(a: str, b: str, n_a: str, n_b: str):
        confidence = F.col("pair_count") / F.col(n_a)
        return F.struct(
            F.col(a).alias("antecedent"),
            F.col(b).alias("consequent"),
            F.col("pair_count"),
            (F.col("pair_count") / F.col("n")).alias("support"),
            confidence.alias("confidence"),
            (confidence / (F.col(n_b) / F.col("n"))).alias("lift"),
        )

    both = F.array(rule("item_a", "item_b", "n_a", "n_b"), rule("item_b", "item_a", "n_b", "n_a"))
    return paired.select(F.inline(both))


def filter_rules(
    rules: DataFrame,
    min_support: float = 0.01,
    min_confidence: float = 0.30,
    min_lift: float = 1.30,
) -> DataFrame:
    """Rules that reach all three thresholds."""
    return rules.where(
        (F.col("support") >= min_support)
        & (F.col("confidence") >= min_confidence)
        & (F.col("lift") >= min_lift)
    )


def _strength():
    # Both directions of a pair have the same lift but for rounding noise, hence the rounded key.
    return [
        F.desc(F.round("lift", 9)),
        F.desc("confidence"),
        F.desc("pair_count"),
        F.asc("antecedent"),
        F.asc("consequent"),
    ]


def bundle_pairs(filtered: DataFrame) -> DataFrame:
    """One row per unordered pair: its strongest direction."""
    keyed = filtered.withColumns(
        {
            "item_a": F.least("antecedent", "consequent"),
            "item_b": F.greatest("antecedent", "consequent"),
        }
    )
    return first_per_key(keyed, ["item_a", "item_b"], _strength())


def count_bundle_pairs(filtered: DataFrame) -> DataFrame:
    """Number of unordered pairs among the filtered rules."""
    pair = F.struct(F.least("antecedent", "consequent"), F.greatest("antecedent", "consequent"))
    return filtered.agg(F.count_distinct(pair).alias("n_pairs"))


def top_bundles(pairs: DataFrame, n: int = 15) -> DataFrame:
    """The strongest pairs."""
    return top_overall(pairs, _strength(), n).drop("item_a", "item_b")


def bundle_edges(pairs: DataFrame) -> DataFrame:
    """Edges of the bundle network: the pair, its lift as weight, support and pair count."""
    return pairs.select(
        "item_a", "item_b", F.col("lift").alias("weight"), "support", "pair_count"
    )


def bundle_nodes(edges: DataFrame) -> DataFrame:
    """Nodes of the bundle network with their degree."""
    ends = edges.select(F.explode(F.array("item_a", "item_b")).alias("item"))
    return ends.groupBy("item").agg(F.count(F.lit(1)).alias("degree"))
