"""Previews, descriptions, audits, null handling and removal of 'missing' metadata."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import replace
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import finite_or_zero, is_literal_missing
from ..schemas import Tables
from .quantiles import Measure, moments, narrowed_quantiles
from .running import top_overall


def union_all(frames: Iterable[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def rows_of(df: DataFrame, rows: Sequence[Mapping[str, Column]]) -> DataFrame:
    """Turn each input row into ``len(rows)`` output rows of the given columns."""
    structs = [F.struct(*[column.alias(name) for name, column in row.items()]) for row in rows]
    return df.select(F.inline(F.array(*structs)))


def preview(df: DataFrame, order: Sequence[str], n: int = 10) -> DataFrame:
    """The first ``n`` rows under a stated order."""
    return top_overall(df, [F.col(c) for c in order], n)


def describe_numeric(frames: Mapping[str, tuple[DataFrame, Sequence[str]]]) -> DataFrame:
    """count, mean, sample std, min, quartiles and max: one row per (table, column).

    ``frames`` maps a table name to its frame and numeric columns. One pass over each table gives the
    moments; quartiles are found by narrowing, which moves counts only.
    """
    names = [(name, c) for name, (_, columns) in frames.items() for c in columns]
    measures = [Measure(frames[name][0], F.col(c)) for name, c in names]
    known = moments(measures)
    quartiles = narrowed_quantiles(measures, [0.25, 0.5, 0.75], known)
    rows = [
        (*name, m.n, m.mean, m.std, m.min, m.max, *own)
        for name, m, own in zip(names, known, quartiles, strict=True)
    ]
    spark = next(iter(frames.values()))[0].sparkSession
    doubles = ", ".join(f"{c} double" for c in ("mean", "std", "min", "max", "q25", "q50", "q75"))
    return spark.createDataFrame(rows, f"table string, column string, n long, {doubles}")


def null_profile(frames: Mapping[str, DataFrame]) -> DataFrame:
    """Null count of every column of every table: table, column, n_null."""
    parts = []
    for name, df in frames.items():
        counted = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
        parts.append(
            rows_of(
                counted,
                [
                    {"table": F.lit(name), "column": F.lit(c), "n_null": F.col(c)}
                    for c in df.columns
                ],
            )
        )
    return union_all(parts)


def table_audit(frames: Mapping[str, DataFrame], user: str = "user_id") -> DataFrame:
    """Rows, columns and distinct users (where the table has users) of every table."""
    return union_all(
        df.agg(
            F.lit(name).alias("table"),
            F.count(F.lit(1)).alias("n_rows"),
            F.lit(len(df.columns)).alias("n_columns"),
            (F.count_distinct(user) if user in df.columns else F.lit(None).cast("long")).alias(
                "n_users"
            ),
        )
        for name, df in frames.items()
    )


def lenient_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Cast keys to whole numbers, unreadable ones to null, and drop rows with a null key."""
    kinds = dict(df.dtypes)
    whole = {
        # The direct cast keeps every digit of a long id; only decimals take the second path.
        key: F.coalesce(F.col(key).try_cast("long"), F.col(key).try_cast("double").try_cast("long"))
        for key in keys
        if kinds[key] not in ("bigint", "int", "smallint", "tinyint")
    }
    return df.withColumns(whole).na.drop(subset=list(keys))


def fill_nulls(df: DataFrame, values: Mapping[str, float | int | str]) -> DataFrame:
    """Replace nulls by a constant per column."""
    return df.na.fill(dict(values))


def scrub_nonfinite(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Null, NaN and infinities become 0 in the given columns."""
    return df.withColumns({c: finite_or_zero(F.col(c)) for c in columns})


def require_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Fail while planning if a needed column is absent; no job is run."""
    absent = [c for c in columns if c not in df.columns]
    if absent:
        raise KeyError(f"missing columns: {absent}; available: {df.columns}")
    return df


def nameless_products(tables: Tables) -> DataFrame:
    """Ids of products whose own name, aisle or department is literally 'missing'."""
    aisles = _flagged(tables.aisles, "aisle_id", "aisle", "bad_aisle")
    departments = _flagged(tables.departments, "department_id", "department", "bad_department")
    bad = (
        is_literal_missing(F.col("product_name"))
        | F.col("bad_aisle").isNotNull()
        | F.col("bad_department").isNotNull()
    )
    return (
        tables.products.join(aisles, "aisle_id", "left")
        .join(departments, "department_id", "left")
        .where(bad)
        .select("product_id")
        .distinct()
    )


def _flagged(dimension: DataFrame, key: str, text: str, flag: str) -> DataFrame:
    found = dimension.where(is_literal_missing(F.col(text)))
    return found.select(key).distinct().withColumn(flag, F.lit(True))


def missing_report(tables: Tables) -> DataFrame:
    """The six counters of 'missing' metadata: what, n."""
    bad = nameless_products(tables)

    def counted(what: str, df: DataFrame) -> DataFrame:
        return df.agg(F.lit(what).alias("what"), F.count(F.lit(1)).alias("n"))

    return union_all(
        [
            counted(
                "product_names", tables.products.where(is_literal_missing(F.col("product_name")))
            ),
            counted("aisle_names", tables.aisles.where(is_literal_missing(F.col("aisle")))),
            counted(
                "department_names",
                tables.departments.where(is_literal_missing(F.col("department"))),
            ),
            counted("products_removed", tables.products.join(bad, "product_id", "left_semi")),
            counted("prior_lines_removed", tables.prior.join(bad, "product_id", "left_semi")),
            counted("train_lines_removed", tables.train.join(bad, "product_id", "left_semi")),
        ]
    )


def clean_metadata(tables: Tables) -> Tables:
    """Remove 'missing' metadata: products by any of the three names, then their lines."""
    bad = nameless_products(tables)

    def without(df: DataFrame) -> DataFrame:
        return df.join(bad, "product_id", "left_anti")

    return replace(
        tables,
        prior=without(tables.prior),
        train=without(tables.train),
        products=without(tables.products),
        aisles=tables.aisles.where(~is_literal_missing(F.col("aisle"))),
        departments=tables.departments.where(~is_literal_missing(F.col("department"))),
    )


def null_pattern(orders: DataFrame) -> DataFrame:
    """Null gaps in total, null gaps on first orders, and first orders."""
    gap, first = F.col("days_since_prior_order").isNull(), F.col("order_number") == 1
    return orders.agg(
        F.count_if(gap).alias("n_null_gap"),
        F.count_if(gap & first).alias("n_null_gap_first"),
        F.count_if(first).alias("n_first_orders"),
    )
