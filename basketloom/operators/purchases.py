"""The unified purchase table, order timelines, and the target/history split."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schemas import Tables
from .running import first_per_key, running_totals

ORDER_ATTRIBUTES = ["user_id", "order_number", "eval_set"]
ORDERS_PER_BLOCK = 1 << 16


def union_lines(prior: DataFrame, train: DataFrame) -> DataFrame:
    """All order lines with a ``source`` tag."""
    return prior.withColumn("source", F.lit("prior")).unionByName(
        train.withColumn("source", F.lit("train"))
    )


def with_order_attributes(
    lines: DataFrame, orders: DataFrame, attributes: Sequence[str] = ORDER_ATTRIBUTES
) -> DataFrame:
    """Lines with the attributes of their order; lines of unknown orders are dropped.

    The join key is order_id, which is unique in ``orders`` and spreads evenly even where one user
    owns much of the data.
    """
    known = orders.where(F.col("user_id").isNotNull()).select("order_id", *attributes)
    return lines.join(known, "order_id")


def with_catalog(lines: DataFrame, tables: Tables) -> DataFrame:
    """Lines with aisle and department ids and names; unknown products keep nulls.

    One plain join per dimension: each is a stored table whose size is known while planning, so it
    is broadcast when small enough and shuffled otherwise. Joining the dimensions to each other
    first would hide their sizes.
    """
    catalog = tables.products.select("product_id", "aisle_id", "department_id")
    return (
        lines.join(catalog, "product_id", "left")
        .join(tables.aisles, "aisle_id", "left")
        .join(tables.departments, "department_id", "left")
    )


PURCHASE_COLUMNS = [
    "order_id",
    "product_id",
    "add_to_cart_order",
    "reordered",
    "source",
    "user_id",
    "order_number",
    "eval_set",
    "aisle_id",
    "department_id",
    "aisle",
    "department",
]


def purchase_table(tables: Tables) -> DataFrame:
    """One row per purchased product: prior and train lines with order and catalogue columns."""
    lines = with_order_attributes(union_lines(tables.prior, tables.train), tables.orders)
    return with_catalog(lines, tables).select(*PURCHASE_COLUMNS)


def with_cumulative_days(orders: DataFrame) -> DataFrame:
    """Running sum of gap days per user along order_number; a null gap counts as 0.

    ``order_number`` is dense, so a range of it bounds a block: a user with very many orders is
    summed in pieces.
    """
    filled = orders.na.fill({"days_since_prior_order": 0.0})
    return running_totals(
        filled,
        keys=["user_id"],
        block=F.floor((F.col("order_number") - 1) / ORDERS_PER_BLOCK),
        order=["order_number", "order_id"],
        totals={"user_cum_days": F.col("days_since_prior_order")},
    )


def last_cumulative_day(timeline: DataFrame) -> DataFrame:
    """Largest cumulative day per user, over all of the user's orders."""
    return timeline.groupBy("user_id").agg(F.max("user_cum_days").alias("u_last_cum_days"))


def last_orders(orders: DataFrame) -> DataFrame:
    """The last order of every user (ties to the larger order_id)."""
    return first_per_key(orders, ["user_id"], [F.desc("order_number"), F.desc("order_id")])


def last_available(purchases: DataFrame) -> DataFrame:
    """Largest order_number per user among orders that have lines."""
    return purchases.groupBy("user_id").agg(F.max("order_number").alias("target_order_number"))


def target_orders(orders: DataFrame, purchases: DataFrame) -> DataFrame:
    """Per user, the order with the last available order_number (ties to the larger order_id)."""
    last = last_available(purchases).withColumnRenamed("target_order_number", "order_number")
    matching = orders.join(last, ["user_id", "order_number"])
    picked = first_per_key(matching, ["user_id"], [F.desc("order_id")])
    return picked.select(
        "user_id",
        F.col("order_id").alias("target_order_id"),
        F.col("order_number").alias("target_order_number"),
        "eval_set",
    )


def with_target_flag(purchases: DataFrame, targets: DataFrame) -> DataFrame:
    """Purchases with the user's target order and whether the row belongs to it."""
    wanted = targets.select("user_id", "target_order_id")
    flagged = purchases.join(wanted, "user_id", "left")
    return flagged.withColumn(
        "is_target_order", F.coalesce(F.col("order_id") == F.col("target_order_id"), F.lit(False))
    )


def target_rows(purchases: DataFrame, targets: DataFrame) -> DataFrame:
    """Purchases of target orders. Joined by order, so no user's rows gather in one task."""
    return purchases.join(_target_ids(targets), "order_id", "left_semi")


def history_rows(purchases: DataFrame, targets: DataFrame) -> DataFrame:
    """Purchases outside target orders."""
    return purchases.join(_target_ids(targets), "order_id", "left_anti")


def _target_ids(targets: DataFrame) -> DataFrame:
    return targets.select(F.col("target_order_id").alias("order_id"))


def eligible_users(history: DataFrame, min_orders: int = 1) -> DataFrame:
    """Users with at least ``min_orders`` distinct history orders."""
    return (
        history.groupBy("user_id")
        .agg(F.count_distinct("order_id").alias("n_history_orders"))
        .where(F.col("n_history_orders") >= min_orders)
    )
