"""Running totals and ranked picks that never put a whole key into one task."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def running_totals(
    df: DataFrame,
    keys: Sequence[str],
    block: Column,
    order: Sequence[Column | str],
    totals: Mapping[str, Column],
    inclusive: bool = True,
) -> DataFrame:
    """Per-key running sums of ``totals`` along ``order``, computed block by block.

    ``block`` must rise with ``order`` inside a key and must bound the rows it holds. Each block
    is summed and ranked by itself, so a key that owns a third of the table is spread over its
    blocks; only the small block table is windowed per key. Keys with a single block have no
    offset row, so in the usual case the offset side of the join is (nearly) empty.
    """
    span = Window.unboundedPreceding, Window.currentRow if inclusive else -1
    in_block = Window.partitionBy(*keys, "_block").orderBy(*order).rowsBetween(*span)
    across = (
        Window.partitionBy(*keys).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    )
    names = list(totals)
    blocked = df.withColumn("_block", block)
    sums = blocked.groupBy(*keys, "_block").agg(
        F.count(F.lit(1)).alias("_rows"), *[F.sum(totals[n]).alias(f"_sum_{n}") for n in names]
    )
    offsets = (
        sums.select(
            *keys,
            "_block",
            F.sum("_rows").over(across).alias("_before"),
            *[F.sum(f"_sum_{n}").over(across).alias(f"_off_{n}") for n in names],
        )
        .where(F.col("_before").isNotNull())
        .drop("_before")
    )
    ranked = blocked.select(
        "*", *[F.sum(totals[n]).over(in_block).alias(f"_in_{n}") for n in names]
    )
    zero = F.lit(0)
    return ranked.join(offsets, [*keys, "_block"], "left").select(
        *[F.col(c) for c in df.columns],
        *[
            (F.coalesce(f"_in_{n}", zero) + F.coalesce(f"_off_{n}", zero)).alias(n)
            for n in names
        ],
    )


def carried(
    df: DataFrame, keys: Sequence[str], block: Column, order: str, out: str
) -> DataFrame:
    """Add ``out``: the ``order`` value of the row before, per key; null for a key's first row.

    Blocks as in ``running_totals``. Inside a block it is the row before; the first row of a block
    takes the last value of the nearest block before it that has any, so a key's windows only ever
    see one row per block. ``order`` is one column without nulls and must not repeat inside a key.
    """
    blocked = df.withColumn("_block", block)
    in_block = Window.partitionBy(*keys, "_block").orderBy(order)
    across = Window.partitionBy(*keys).orderBy("_block")
    last = blocked.groupBy(*keys, "_block").agg(F.max(order).alias("_last"))
    before = last.select(*keys, "_block", F.lag("_last").over(across).alias("_carry")).where(
        F.col("_carry").isNotNull()
    )
    inside = blocked.withColumn("_inside", F.lag(order).over(in_block))
    return inside.join(before, [*keys, "_block"], "left").select(
        *[F.col(c) for c in df.columns], F.coalesce("_inside", "_carry").alias(out)
    )


def with_balanced_blocks(
    counts: DataFrame, value: str, totals: Sequence[str], by: Sequence[str] = (), fan: int = 32
) -> DataFrame:
    """Add ``_block`` (rising with ``value``, about equally many rows each) and group totals.

    There are ``fan`` squared blocks. ``counts`` holds one row per (by, value), so no value repeats
    and a sketch of the values yields even blocks whatever the skew of the raw rows; results do not
    depend on where the borders fall. ``_total_<c>`` is the sum of each column in ``totals`` (counts
    without nulls, or none) over the ``by`` group. ``by`` must be a report dimension (measure, model, ...) named by the caller:
    the borders are then a handful of rows, each with an array of ``fan * fan - 1`` numbers, which
    is what makes it safe to broadcast them.
    """
    blocks = fan * fan
    # One text literal instead of a thousand expressions keeps the plan small.
    probes = ",".join(repr(i / blocks) for i in range(1, blocks))
    # Naming a total here keeps this branch's input identical to the main one, so that the
    # exchange below it is computed once and reused. Totals are counts: never null.
    bordered = f"CASE WHEN {totals[0]} IS NOT NULL THEN {value} END" if totals else value
    borders = F.expr(
        f"percentile_approx({bordered}, "
        f"cast(split('{probes}', ',') AS array<double>), {4 * blocks})"
    )
    extra = [borders.alias("_fine"), *[F.sum(c).alias(f"_total_{c}") for c in totals]]
    coarse = F.transform(
        F.sequence(F.lit(1), F.lit(fan - 1)), lambda i: F.element_at("_fine", i * fan)
    ).alias("_coarse")
    if by:
        borders_by_group = counts.groupBy(*by).agg(*extra).select("*", coarse)
        joined = counts.join(F.broadcast(borders_by_group), list(by))
    else:
        joined = with_single_row(counts, counts.agg(*extra).select("*", coarse))
    # Two short searches find the block: first among every fan-th border, then between two of them.
    joined = joined.withColumn("_at", F.size(F.filter("_coarse", lambda m: m <= F.col(value))))
    inside = F.slice("_fine", F.col("_at") * fan + 1, F.lit(fan - 1))
    here = F.col("_at") * fan + F.size(F.filter(inside, lambda m: m <= F.col(value)))
    return joined.withColumn("_block", here).drop("_fine", "_coarse", "_at")


def with_single_row(df: DataFrame, row: DataFrame) -> DataFrame:
    """Add the columns of a one-row frame (a global aggregate) to every row, without a join."""
    packed = row.select(F.struct(*row.columns).alias("_row")).scalar()
    return df.withColumn("_row", packed).select(*df.columns, "_row.*")


def top_per_key(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], k: int, rank: str | None = None
) -> DataFrame:
    """First ``k`` rows of every key under a total order.

    The limit is applied to each input partition before the exchange as well as after it, so a hot
    key ships at most ``k`` rows per task.
    """
    position = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    name = rank or "_rank"
    kept = df.withColumn(name, position).where(F.col(name) <= k)
    return kept if rank else kept.drop(name)


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of every key under a total order (an ordered de-duplication)."""
    return top_per_key(df, keys, order, 1)


def top_overall(df: DataFrame, order: Sequence[Column], n: int) -> DataFrame:
    """Global sort and head; runs as a per-partition top-n followed by a merge of n rows each."""
    return df.orderBy(*order).limit(n)


def dense_ids(df: DataFrame, key: str, out: str, blocks: int = 4096) -> DataFrame:
    """One row per distinct ``key`` with a gap-free 0-based integer id.

    Keys are spread over hash blocks, numbered inside each and shifted by the block offsets.
    """
    distinct = df.select(key).distinct()
    numbered = running_totals(
        distinct,
        keys=[],
        block=F.pmod(F.xxhash64(key), F.lit(blocks)),
        order=[key],
        totals={"_position": F.lit(1)},
    )
    return numbered.select(key, (F.col("_position") - 1).cast("int").alias(out))
