"""User segments: behaviour features, scaling, k-means, profiles and cross-sell lists."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType
from pyspark.sql.window import Window

from ..functions import finite_or_zero
from .clusters import fit_clusters
from .running import top_per_key

# The segment features, and those taken as log(1 + x) before scaling.
SEGMENT_FEATURES = [
    "u_hist_orders",
    "u_mean_days_between_orders",
    "u_mean_basket_size",
    "u_reorder_rate",
    "u_unique_products",
]
LOG_FEATURES = ["u_hist_orders", "u_mean_basket_size", "u_unique_products"]


def segment_features(history: DataFrame, orders: DataFrame) -> DataFrame:
    """Five behaviour features per user with history.

    Lines are reduced to one row per order before the gap days are attached, so every order counts
    once; first-order gaps count as 0.
    """
    per_order = history.groupBy("user_id", "order_id").agg(
        F.count(F.lit(1)).alias("basket_size"),
        F.sum("reordered").alias("reordered"),
        F.count("reordered").alias("known"),
    )
    gaps = orders.select("order_id", F.coalesce("days_since_prior_order", F.lit(0.0)).alias("gap"))
    by_orders = (
        per_order.join(gaps, "order_id", "left")
        .groupBy("user_id")
        .agg(
            F.count(F.lit(1)).alias("u_hist_orders"),
            F.avg("gap").alias("u_mean_days_between_orders"),
            F.avg("basket_size").alias("u_mean_basket_size"),
            F.try_divide(F.sum("reordered").cast("double"), F.sum("known").cast("double")).alias(
                "u_reorder_rate"
            ),
        )
    )
    by_products = history.groupBy("user_id").agg(
        F.count_distinct("product_id").alias("u_unique_products")
    )
    return by_orders.join(by_products, "user_id", "full_outer")


def log_features(features: DataFrame, columns: Sequence[str] = LOG_FEATURES) -> DataFrame:
    """log(1 + x) on long-tailed columns, then nulls to 0 in all segment features."""
    logged = features.withColumns({c: F.log1p(F.col(c).cast("double")) for c in columns})
    return logged.withColumns({c: finite_or_zero(F.col(c)) for c in SEGMENT_FEATURES})


class _Moments:
    """Rows, mean and squared deviations of some numbers, batch by batch. Of equal numbers the last are 0."""

    def __init__(self) -> None:
        self.n, self.mean, self.squares = 0, 0.0, 0.0

    def add(self, x: np.ndarray) -> None:
        if not len(x):
            return
        mean = x[0] + (x - x[0]).mean()
        off, total = mean - self.mean if self.n else 0.0, self.n + len(x)
        self.squares += ((x - mean) ** 2).sum() + off * off * self.n * len(x) / total
        self.mean = self.mean + off * len(x) / total if self.n else mean
        self.n = total


PART = "part int, column int, n long, mean double, squares double"


def _part_moments(width: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = [_Moments() for _ in range(width)]
        for batch in batches:
            for moments, column in zip(own, batch.columns, strict=True):
                with np.errstate(invalid="ignore"):
                    moments.add(column.drop_null().to_numpy())
        rows = [(i, m.n, float(m.mean), float(m.squares)) for i, m in enumerate(own) if m.n]
        if rows:
            columns = [[TaskContext.get().partitionId()] * len(rows), *zip(*rows, strict=True)]
            kinds = pa.int32(), pa.int32(), pa.int64(), pa.float64(), pa.float64()
            names = ["part", "column", "n", "mean", "squares"]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names
            )

    return run


def _scales(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row: (mean, unit) of every column, in its place; the unit of a constant is 1.

    Tasks sum up all columns in arrays: so many aggregates in one query would run uncompiled.
    """
    inputs = df.select(*[F.col(c).cast("double").alias(f"f{i}") for i, c in enumerate(columns)])
    parts = inputs.mapInArrow(_part_moments(len(columns)), PART)
    found = parts.agg(F.sort_array(F.collect_list(F.struct("column", "part", "n", "mean", "squares"))).alias("all"))

    def of(i: int) -> Column:
        own = f"filter(all, p -> p.column = {i})"
        total = f"aggregate({own}, 0L, (a, p) -> a + p.n)"
        first = f"get({own}, 0).mean"
        mean = f"{first} + aggregate({own}, 0D, (a, p) -> a + p.n * (p.mean - {first})) / nullif({total}, 0)"
        squares = f"aggregate({own}, 0D, (a, p) -> a + p.squares + p.n * (p.mean - m) * (p.mean - m))"
        with_mean = f"transform(array({mean}), m -> struct(m AS mean, sqrt({squares} / nullif({total}, 0)) AS d))"
        unit = "struct(x.mean AS mean, if(x.d = 0, 1D, x.d) AS unit)"
        return F.expr(f"get(transform({with_mean}, x -> {unit}), 0)").alias(f"f{i}")

    return found.select(F.struct(*[of(i) for i in range(len(columns))]).alias("scales"))


def standardize(df: DataFrame, columns: Sequence[str], fit_on: DataFrame | None = None) -> DataFrame:
    """(x - mean) / population deviation, both taken from ``fit_on`` (default: the input itself).

    The statistics are one scalar subquery; a constant column becomes 0.
    """
    scales = _scales(df if fit_on is None else fit_on, columns).scalar()
    place = {c: i for i, c in enumerate(columns)}

    def scaled(c: str) -> Column:
        own = F.col("_scales").getField(f"f{place[c]}")
        return ((F.col(c).cast("double") - own.getField("mean")) / own.getField("unit")).alias(c)

    kept = [F.col(c) if c not in columns else scaled(c) for c in df.columns]
    return df.withColumn("_scales", scales).select(*kept)


def fitted_scales(df: DataFrame, columns: Sequence[str]) -> dict[str, tuple[float, float]]:
    """Mean and unit of every column, from one job: for fits, which run jobs anyway."""
    scales = _scales(df, columns).first().scales
    return {c: (own.mean, own.unit) for c, own in zip(columns, scales, strict=True)}


def rescaled(df: DataFrame, scales: dict[str, tuple[float, float]]) -> DataFrame:
    """``standardize`` by known scales, on whole columns in tasks.

    The same as one query's expressions is too long for the JVM to compile.
    """
    kinds = [StructField(f.name, DoubleType()) if f.name in scales else f for f in df.schema]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = []
            for name, x in zip(batch.schema.names, batch.columns, strict=True):
                if name in scales:
                    mean, unit = scales[name]
                    x = pc.divide(pc.subtract(x.cast(pa.float64(), safe=False), mean), unit)
                columns.append(x)
            yield pa.RecordBatch.from_arrays(columns, batch.schema.names)

    return df.mapInArrow(run, StructType(kinds))


def scaled_segment_features(features: DataFrame) -> DataFrame:
    """Log transform and z-scores of the segment features."""
    return standardize(log_features(features), SEGMENT_FEATURES)


def elbow_table(
    scaled: DataFrame, ks: Sequence[int] = range(2, 10), seed: int = 42, restarts: int = 20
) -> DataFrame:
    """Inertia per number of clusters; all fits share the scans of the rows."""
    fits = fit_clusters(scaled, SEGMENT_FEATURES, ks, restarts, seed)
    rows = [(k, fit.inertia) for k, fit in fits.items()]
    return scaled.sparkSession.createDataFrame(rows, "k int, inertia double")


def user_segments(
    features: DataFrame, k: int = 4, seed: int = 420, restarts: int = 20
) -> DataFrame:
    """Segment of every user, with the raw features.

    Segments are renumbered by rising mean order count, so their ids do not depend on the order in
    which the centres were found.
    """
    raw = [c for c in features.columns if c != "user_id"]
    scaled = scaled_segment_features(features.withColumn("_raw", F.struct(*raw)))
    fit = fit_clusters(scaled, SEGMENT_FEATURES, [k], restarts, seed)[k]
    found = scaled.select("user_id", "_raw.*", fit.nearest(SEGMENT_FEATURES).alias("prediction"))
    # One row per segment comes back to the driver.
    activity = found.groupBy("prediction").agg(F.avg("u_hist_orders").alias("orders")).collect()
    order = sorted(activity, key=lambda r: (r["orders"] or 0.0, r["prediction"]))
    renumber = F.create_map(
        *[F.lit(x) for i, r in enumerate(order) for x in (r["prediction"], i)]
    )
    return found.withColumn("segment", F.element_at(renumber, F.col("prediction"))).drop(
        "prediction"
    )


def segment_profile(segmented: DataFrame) -> DataFrame:
    """Users and mean raw features per segment."""
    return segmented.groupBy("segment").agg(
        F.count(F.lit(1)).alias("n_users"), *[F.avg(c).alias(c) for c in SEGMENT_FEATURES]
    )


def segment_aisles(history: DataFrame, segments: DataFrame) -> DataFrame:
    """Purchases per (segment, aisle), segment total and share; null keys are left out.

    Purchases are counted per (user, aisle) before the join, which then sees at most one row per
    user and aisle.
    """
    per_user = (
        history.where(F.col("aisle").isNotNull())
        .groupBy("user_id", "aisle")
        .agg(F.count(F.lit(1)).alias("lines"))
    )
    counted = (
        per_user.join(segments.select("user_id", "segment"), "user_id")
        .where(F.col("segment").isNotNull())
        .groupBy("segment", "aisle")
        .agg(F.sum("lines").alias("purchase_count"))
    )
    total = F.sum("purchase_count").over(Window.partitionBy("segment"))
    return counted.withColumn("segment_total", total).withColumn(
        "share", F.col("purchase_count") / F.col("segment_total")
    )


def cross_sell(history: DataFrame, segments: DataFrame, n: int = 5) -> DataFrame:
    """The ``n`` aisles with the largest share of each segment's purchases."""
    order = [F.desc("share"), F.desc("purchase_count"), F.asc("aisle")]
    return top_per_key(segment_aisles(history, segments), ["segment"], order, n)
