"""Derives the six input tables from a star-schema warehouse (orders, lineitem, part)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..schemas import Tables

# Fixed values of the derivation.
NAMELESS_BRAND = 7
NAMELESS_AISLE = " Missing "
KEYS_PER_BLOCK = 1 << 20
DAYS_PER_BLOCK = 64


def warehouse_orders(raw: DataFrame) -> DataFrame:
    """Number each customer's orders by (date, key) and derive the split and the gap in days.

    Orders are grouped by (customer, day, key range). A group holds at most ``KEYS_PER_BLOCK``
    orders because keys are unique, so numbering stays spread out even for a customer that owns a
    third of all orders. Groups are added up by day, and days run in blocks of ``DAYS_PER_BLOCK``:
    counts and the last day are carried from block to block, so a window on a customer alone sees
    one row for a block of days.
    """
    orders = raw.select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("user_id"),
        F.to_date("o_orderdate").alias("day"),
        F.floor(F.col("o_orderkey") / KEYS_PER_BLOCK).alias("key_range"),
    )
    group = ["user_id", "day", "key_range"]
    sizes = orders.groupBy(*group).agg(F.count(F.lit(1)).alias("group_size"))
    days = sizes.groupBy("user_id", "day").agg(F.sum("group_size").alias("day_size"))
    in_day = Window.partitionBy("user_id", "day").orderBy("key_range")
    earlier = F.sum("group_size").over(in_day.rowsBetween(Window.unboundedPreceding, -1))
    groups = (
        sizes.select(*group, F.coalesce(earlier, F.lit(0)).alias("earlier"))
        .join(_numbered_days(days), ["user_id", "day"])
        .select(
            *group,
            (F.col("days_before") + F.col("earlier")).alias("before"),
            "user_orders",
            F.when(F.col("earlier") > 0, F.col("day")).otherwise(F.col("previous_day")).alias("previous_day"),
        )
    )
    in_group = F.row_number().over(Window.partitionBy(*group).orderBy("order_id"))
    numbered = (
        orders.withColumn("position", in_group)
        .join(groups, group)
        .select(
            "order_id",
            "user_id",
            (F.col("before") + F.col("position")).cast("int").alias("order_number"),
            "user_orders",
            F.when(F.col("position") > 1, F.lit(0))
            .otherwise(F.datediff("day", "previous_day"))
            .alias("gap"),
        )
    )
    return numbered.select(
        "order_id",
        "user_id",
        F.when(F.col("order_number") < F.col("user_orders"), "prior")
        .when(F.col("user_id") % 3 == 0, "test")
        .otherwise("train")
        .alias("eval_set"),
        "order_number",
        (F.col("order_id") % 7).cast("int").alias("order_dow"),
        (F.col("order_id") % 24).cast("int").alias("order_hour_of_day"),
        F.when(F.col("gap") >= 300, F.lit(30.0))
        .otherwise(F.floor(F.col("gap") / 10).cast("double"))
        .alias("days_since_prior_order"),
    )


def _numbered_days(days: DataFrame) -> DataFrame:
    """Per user and day: the orders before it, the day before it, and the orders of the user.

    Days are exchanged once by (user, block of days). Windows and totals of a block read that exchange;
    a window on a user alone sees one row for a block.
    """
    block = F.floor(F.unix_date("day") / DAYS_PER_BLOCK)
    dealt = days.withColumn("_block", block).repartition("user_id", "_block")
    key = ["user_id", "_block"]
    in_block = Window.partitionBy(*key).orderBy("day")
    across = Window.partitionBy("user_id").orderBy("_block")
    upto = Window.unboundedPreceding, -1
    carried = dealt.groupBy(*key).agg(F.sum("day_size").alias("size"), F.max("day").alias("last")).select(
        *key,
        F.coalesce(F.sum("size").over(across.rowsBetween(*upto)), F.lit(0)).alias("blocks_before"),
        F.lag("last").over(across).alias("carry"),
        F.sum("size").over(Window.partitionBy("user_id")).alias("user_orders"),
    )
    inside = dealt.select(
        *key,
        "day",
        F.coalesce(F.sum("day_size").over(in_block.rowsBetween(*upto)), F.lit(0)).alias("inside"),
        F.lag("day").over(in_block).alias("day_inside"),
    )
    return inside.join(carried, key).select(
        "user_id",
        "day",
        (F.col("blocks_before") + F.col("inside")).alias("days_before"),
        F.coalesce("day_inside", "carry").alias("previous_day"),
        "user_orders",
    )


def warehouse_lines(raw: DataFrame, orders: DataFrame) -> DataFrame:
    """One line per order and part, with cart position, repeat flag and eval_set.

    Raw lines are exchanged once by order, which serves the merging, the cart and the join, and once by
    (user, part). The first purchase of a pair is an aggregate joined back, not a window over the pair;
    it takes all columns, so that both sides of that join read the same exchange.
    """
    dealt = raw.select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_linenumber").alias("line_number"),
    ).repartition("order_id")
    merged = dealt.groupBy("order_id", "product_id").agg(F.min("line_number").alias("line_number"))
    cart = Window.partitionBy("order_id").orderBy("line_number", "product_id")
    known = orders.where(F.col("eval_set") != "test").select(
        "order_id", "user_id", "order_number", "eval_set"
    )
    placed = merged.withColumn("add_to_cart_order", F.row_number().over(cart)).drop("line_number")
    lines = placed.join(known, "order_id").repartition("user_id", "product_id")
    others = [c for c in lines.columns if c not in ("user_id", "product_id", "order_number")]
    first = lines.groupBy("user_id", "product_id").agg(
        F.min(F.struct("order_number", *others))["order_number"].alias("first_number")
    )
    return lines.join(first, ["user_id", "product_id"]).select(
        "order_id",
        "product_id",
        F.col("add_to_cart_order").cast("int").alias("add_to_cart_order"),
        (F.col("order_number") > F.col("first_number")).cast("int").alias("reordered"),
        "eval_set",
    )


def _aisle_id():
    return F.substring_index("p_brand", "#", -1).cast("int")


def _department_id(raw: DataFrame):
    """Rank of a part's type among all types of the table, from 1; null for a null type.

    The distinct types are one scalar subquery: partial aggregates meet in a sorted array.
    """
    types = raw.agg(F.array_sort(F.collect_set("p_type"))).scalar()
    return F.array_position(types, F.col("p_type")).cast("int")


def warehouse_products(raw: DataFrame) -> DataFrame:
    """Every part as a product."""
    return raw.select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_name").alias("product_name"),
        _aisle_id().alias("aisle_id"),
        _department_id(raw).alias("department_id"),
    )


def warehouse_aisles(raw: DataFrame) -> DataFrame:
    """Brands as aisles, one row per number, one of them without a usable name."""
    named = F.when(_aisle_id() == NAMELESS_BRAND, NAMELESS_AISLE).otherwise(F.lower("p_brand"))
    return raw.groupBy(_aisle_id().alias("aisle_id")).agg(F.min(named).alias("aisle"))


def warehouse_departments(raw: DataFrame) -> DataFrame:
    """Part types as departments, one row per type."""
    types = raw.select("p_type").distinct()
    return types.select(
        _department_id(raw).alias("department_id"), F.lower("p_type").alias("department")
    )


def read_warehouse(spark: SparkSession, folder: str) -> Tables:
    """The six tables, derived lazily from the parquet files in ``folder``."""
    raw = {t: spark.read.parquet(f"{folder}/{t}.parquet") for t in ("orders", "lineitem", "part")}
    orders = warehouse_orders(raw["orders"])
    lines = warehouse_lines(raw["lineitem"], orders)
    return Tables(
        orders=orders,
        prior=lines.where("eval_set = 'prior'").drop("eval_set"),
        train=lines.where("eval_set = 'train'").drop("eval_set"),
        products=warehouse_products(raw["part"]),
        aisles=warehouse_aisles(raw["part"]),
        departments=warehouse_departments(raw["part"]),
    )
