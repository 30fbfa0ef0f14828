"""User, product and user-product features, labels, the candidate table and the user split."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import clip_low, safe_ratio
from ..schemas import Tables
from .cleaning import lenient_keys
from .purchases import last_cumulative_day, with_cumulative_days, with_order_attributes

# The feature columns, in model order.
FEATURES = [
    "u_total_items",
    "u_unique_products",
    "u_total_orders",
    "u_reorder_ratio",
    "u_avg_days",
    "u_last_cum_days",
    "p_total_purchases",
    "p_unique_users",
    "p_reorder_ratio",
    "p_avg_cart",
    "up_buy_cnt",
    "up_reorder_cnt",
    "up_cart_mean",
    "up_first_order",
    "up_last_order",
    "up_reorder_ratio",
    "up_orders_since_last",
    "up_days_since_last",
    "up_freq",
    "als_dot",
    "als_cos",
    "aisle_id",
    "department_id",
]
AFFINITY_FEATURES = ["als_dot", "als_cos"]
TABLE_FEATURES = [f for f in FEATURES if f not in AFFINITY_FEATURES]
CATEGORICAL_FEATURES = ["aisle_id", "department_id"]


def prior_details(tables: Tables, timeline: DataFrame | None = None) -> DataFrame:
    """Prior lines with user, order number, gap days and cumulative days; null keys dropped."""
    orders = with_cumulative_days(tables.orders) if timeline is None else timeline
    detailed = with_order_attributes(
        tables.prior, orders, ["user_id", "order_number", "days_since_prior_order", "user_cum_days"]
    )
    return lenient_keys(detailed, ["order_id", "user_id", "product_id"])


def pair_totals(details: DataFrame) -> DataFrame:
    """Additive totals per (user, product).

    This is the one exchange of the line-grain table: user and product features are sums of these
    totals, so neither a popular product nor a heavy user ever gathers raw lines, and the distinct
    counts become plain row counts.
    """
    return details.groupBy("user_id", "product_id").agg(
        F.count(F.lit(1)).alias("lines"),
        F.sum("reordered").alias("reordered_sum"),
        F.count("reordered").alias("reordered_n"),
        F.sum("add_to_cart_order").alias("cart_sum"),
        F.count("add_to_cart_order").alias("cart_n"),
        F.sum("days_since_prior_order").alias("days_sum"),
        F.count("days_since_prior_order").alias("days_n"),
        F.min("order_number").alias("first_order"),
        F.max("order_number").alias("last_order"),
        F.max("user_cum_days").alias("last_cum_days"),
    )


def _mean(total: str, n: str) -> Column:
    return F.try_divide(F.sum(total).cast("double"), F.sum(n).cast("double"))


def user_features(pairs: DataFrame, last_days: DataFrame) -> DataFrame:
    """Per-user features over prior lines, plus the last cumulative day over all orders."""
    grouped = pairs.groupBy("user_id").agg(
        F.sum("lines").alias("u_total_items"),
        F.count(F.lit(1)).alias("u_unique_products"),
        F.max("last_order").alias("u_total_orders"),
        _mean("reordered_sum", "reordered_n").alias("u_reorder_ratio"),
        _mean("days_sum", "days_n").alias("u_avg_days"),
    )
    return grouped.join(last_days, "user_id", "left").na.fill({"u_last_cum_days": 0.0})


def product_features(pairs: DataFrame) -> DataFrame:
    """Per-product features over prior lines."""
    return pairs.groupBy("product_id").agg(
        F.sum("lines").alias("p_total_purchases"),
        F.count(F.lit(1)).alias("p_unique_users"),
        _mean("reordered_sum", "reordered_n").alias("p_reorder_ratio"),
        _mean("cart_sum", "cart_n").alias("p_avg_cart"),
    )


def product_table(pairs: DataFrame, products: DataFrame) -> DataFrame:
    """Features and category ids of every product with prior lines."""
    named = products.select("product_id", *CATEGORICAL_FEATURES)
    return product_features(pairs).join(named, "product_id", "left")


def pair_columns() -> list[Column]:
    """Per-pair features; ``pair_totals`` joined with ``user_features`` has all their inputs."""
    last_days = F.coalesce("last_cum_days", F.lit(0.0))
    return [
        F.col("lines").alias("up_buy_cnt"),
        F.col("reordered_sum").alias("up_reorder_cnt"),
        F.try_divide(F.col("cart_sum").cast("double"), F.col("cart_n").cast("double")).alias(
            "up_cart_mean"
        ),
        F.col("first_order").alias("up_first_order"),
        F.col("last_order").alias("up_last_order"),
        safe_ratio(F.col("reordered_sum"), F.col("lines")).alias("up_reorder_ratio"),
        (F.col("u_total_orders") - F.col("last_order")).alias("up_orders_since_last"),
        safe_ratio(F.col("lines"), F.col("u_total_orders")).alias("up_freq"),
        clip_low(F.col("u_last_cum_days") - last_days).alias("up_days_since_last"),
    ]


def pair_features(pairs: DataFrame, users: DataFrame) -> DataFrame:
    """Per-(user, product) counts, cart position, first and last order, ratios and recency."""
    anchored = pairs.join(users.select("user_id", "u_total_orders", "u_last_cum_days"), "user_id")
    return anchored.select("user_id", "product_id", *pair_columns())


def train_orders(orders: DataFrame) -> DataFrame:
    """(order_id, user_id) of the orders whose products are to be predicted."""
    return orders.where(F.col("eval_set") == "train").select("order_id", "user_id")


def label_pairs(train_lines: DataFrame, orders: DataFrame) -> DataFrame:
    """Distinct (user, product) pairs bought in the user's train order, label 1."""
    bought = train_lines.join(train_orders(orders), "order_id")
    pairs = lenient_keys(bought, ["user_id", "product_id"])
    return pairs.select("user_id", "product_id").distinct().withColumn("label", F.lit(1))


def candidate_table(
    tables: Tables,
    affinity: DataFrame | None = None,
    labelled_users_only: bool = False,
    pairs: DataFrame | None = None,
    products: DataFrame | None = None,
) -> DataFrame:
    """One row per (user, product) seen in prior lines: all features and the 0/1 label.

    By default every user with prior lines is kept, those without a train order being all
    negatives; ``labelled_users_only`` restricts to users that have one. ``affinity`` adds the
    two factor scores, which are 0.0 where it has no row or is not given.

    ``pairs`` may be a stored ``pair_totals``. It feeds three branches (the rows themselves, user
    and product features), so storing it makes one pass over the lines out of three. ``products``
    may be a stored ``product_table``: its size is then known, and where it is small the candidates
    are not exchanged by product at all.
    """
    timeline = with_cumulative_days(tables.orders)
    if pairs is None:
        pairs = pair_totals(prior_details(tables, timeline))
    users = user_features(pairs, last_cumulative_day(timeline))
    if labelled_users_only:
        users = users.join(train_orders(tables.orders), "user_id", "left_semi")
    # Joins on (user, product) come first: the totals are already partitioned by that key.
    full = pairs.join(label_pairs(tables.train, tables.orders), ["user_id", "product_id"], "left")
    if affinity is not None:
        full = full.join(affinity, ["user_id", "product_id"], "left")
    else:
        full = full.withColumns({c: F.lit(0.0) for c in AFFINITY_FEATURES})
    if products is None:
        products = product_table(pairs, tables.products)
    full = full.join(users, "user_id").join(products, "product_id", "left")
    return full.select(
        "user_id",
        "product_id",
        *[c for c in FEATURES if c[:2] in ("u_", "p_")],
        *pair_columns(),
        *[F.coalesce(c, F.lit(0.0)).alias(c) for c in AFFINITY_FEATURES],
        *[F.coalesce(c, F.lit(0)).alias(c) for c in CATEGORICAL_FEATURES],
        F.coalesce("label", F.lit(0)).alias("label"),
    )


def is_validation_user(user: Column, percent: int = 20) -> Column:
    """Deterministic by-user split: a hash of the id decides, so every table agrees on it."""
    bucket = F.conv(F.substring(F.md5(user.cast("string")), 1, 8), 16, 10).cast("long") % 100
    return bucket < percent


def split_by_user(df: DataFrame, percent: int = 20) -> tuple[DataFrame, DataFrame]:
    """(training part, validation part): no user is in both."""
    flag = is_validation_user(F.col("user_id"), percent)
    return df.where(~flag), df.where(flag)


def positive_rate(candidates: DataFrame) -> DataFrame:
    """Candidate rows, positives, label mean, and the weight that balances the positive class."""
    rate = F.avg("label")
    return candidates.agg(
        F.count(F.lit(1)).alias("n_candidates"),
        F.sum("label").alias("n_positive"),
        rate.alias("positive_rate"),
        ((1.0 - rate) / F.greatest(rate, F.lit(1e-6))).alias("positive_weight"),
    )
