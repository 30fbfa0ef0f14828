"""Exact linear-interpolated quantiles and complete histograms, without one-task buffers."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .running import running_totals, with_balanced_blocks

# Parts of an interval, and how often intervals are narrowed to the parts that hold a wanted rank.
PARTS = 1024
NARROWINGS = 2


def value_counts(df: DataFrame, value: Column | str, by: Sequence[str] = ()) -> DataFrame:
    """One row per (by, value) with its number of rows ``n``; null values are dropped."""
    column = F.col(value) if isinstance(value, str) else value
    return (
        df.select(*by, column.cast("double").alias("value"))
        .where(F.col("value").isNotNull())
        .groupBy(*by, "value")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def _value_at(rank: Column) -> Column:
    return F.min(F.when(F.col("_upto") > rank, F.col("value")))


def quantiles_of_counts(
    counts: DataFrame, probs: Mapping[str, float], by: Sequence[str] = (), sizes: bool = False
) -> DataFrame:
    """Exact quantiles from ``value_counts`` output: one row per ``by`` group, one column each.

    The cumulative count of each distinct value is built block by block, then the value at a rank
    is the smallest one whose cumulative count passes it: an ordinary partial aggregate.

    ``sizes`` says that the values are sizes of disjoint groups of rows. D different
    sizes need at least 1 + 2 + ... + D rows, so there are fewer than sqrt(2 * rows) of them: the
    value counts are then few enough for the built-in weighted percentile, in one step.
    """
    if sizes:
        wanted = F.array(*[F.lit(float(p)) for p in probs.values()])
        found = counts.groupBy(*by).agg(F.percentile("value", wanted, F.col("n")).alias("_q"))
        return found.select(*by, *[F.col("_q")[i].alias(name) for i, name in enumerate(probs)])
    ranked = running_totals(
        with_balanced_blocks(counts, "value", ["n"], by),
        keys=list(by),
        block=F.col("_block"),
        order=["value"],
        totals={"_upto": F.col("n")},
    )
    picks = []
    for name, p in probs.items():
        position = F.lit(float(p)) * (F.col("_total_n") - 1)
        low, high = F.floor(position), F.ceil(position)
        picks += [
            _value_at(low).alias(f"_lo_{name}"),
            _value_at(high).alias(f"_hi_{name}"),
            F.max(position - low).alias(f"_part_{name}"),
        ]
    found = ranked.groupBy(*by).agg(*picks)
    return found.select(
        *by,
        *[
            (
                F.col(f"_lo_{name}")
                + (F.col(f"_hi_{name}") - F.col(f"_lo_{name}")) * F.col(f"_part_{name}")
            ).alias(name)
            for name in probs
        ],
    )


def exact_quantiles(
    df: DataFrame,
    value: Column | str,
    probs: Mapping[str, float],
    by: Sequence[str] = (),
    sizes: bool = False,
) -> DataFrame:
    """Exact quantiles of ``value`` per ``by`` group; nulls are ignored."""
    return quantiles_of_counts(value_counts(df, value, by), probs, by, sizes)


@dataclass(frozen=True)
class Measure:
    """A numeric column of a frame."""

    df: DataFrame
    value: Column


@dataclass
class Moments:
    """What one pass tells about a measure; nulls do not count."""

    n: int
    mean: float | None
    std: float | None
    min: float | None
    max: float | None


def moments(measures: Sequence[Measure]) -> list[Moments]:
    """Count, mean, sample deviation and ends of every measure, one job for each frame."""
    found: list[Moments | None] = [None] * len(measures)
    for places in _by_frame(measures):
        columns = []
        for i in places:
            v = measures[i].value.cast("double")
            columns.append(
                F.struct(F.count(v), F.avg(v), F.stddev_samp(v), F.min(v), F.max(v)).alias(f"m{i}")
            )
        row = measures[places[0]].df.agg(*columns).first()
        for i in places:
            found[i] = Moments(*row[f"m{i}"])
    return found


def _by_frame(measures: Sequence[Measure]) -> list[list[int]]:
    """Places of the measures, those of one frame together."""
    frames: dict[int, list[int]] = {}
    for i, measure in enumerate(measures):
        frames.setdefault(id(measure.df), []).append(i)
    return list(frames.values())


def narrowed_quantiles(
    measures: Sequence[Measure], probs: Sequence[float], known: Sequence[Moments] | None = None
) -> list[list[float | None]]:
    """Exact quantiles of raw columns, without a shuffle of the values.

    A measure's range is cut into ``PARTS`` of equal width, and rows are counted by part. The few parts
    that hold a wanted rank are the next ranges, from their least to their greatest value. What is
    left after ``NARROWINGS`` of these, about one value in a million, is counted by value; a range of
    one value is done before. Only counts move. A step is one job, which reads the frames again; the
    driver sees the parts that hold a wanted rank, no more than two for each quantile. Values that crowd
    together cost more of the last step, never a wrong result. A measure without values has null ones.
    """
    known = moments(measures) if known is None else known
    positions = [[float(p) * (m.n - 1) for p in probs] if m.n else [] for m in known]
    ranks = [sorted({r for p in own for r in (math.floor(p), math.ceil(p))}) for own in positions]
    at: list[dict[int, float]] = [{} for _ in measures]
    # (measure, least value, greatest value, rank at which it starts, rank at which it ends)
    spans = [(i, m.min, m.max, 0, m.n) for i, m in enumerate(known) if m.n]
    for step in range(NARROWINGS + 1):
        wide = [span for span in spans if span[1] != span[2]]
        for i, lo, hi, start, end in spans:
            if lo == hi:
                at[i].update((r, lo) for r in ranks[i] if start <= r < end)
        if not wide:
            break
        last = step == NARROWINGS
        held = _held(measures, wide, last)
        counts = held.groupBy("span", "place").agg(
            F.count(F.lit(1)).alias("n"), F.min("value").alias("lo"), F.max("value").alias("hi")
        )
        found = _holding(counts, wide, ranks).collect()
        spans = [
            (wide[r["span"]][0], r["lo"], r["hi"], r["start"], r["start"] + r["n"]) for r in found
        ]
        if last:
            for i, value, _, start, end in spans:
                at[i].update((r, value) for r in ranks[i] if start <= r < end)

    def quantile(i: int, position: float) -> float:
        low, high = at[i][math.floor(position)], at[i][math.ceil(position)]
        part = position - math.floor(position)
        return low if low == high else low + (high - low) * part

    return [
        [quantile(i, p) for p in own] if own else [None] * len(probs)
        for i, own in enumerate(positions)
    ]


def _held(measures: Sequence[Measure], spans: Sequence[tuple], by_value: bool) -> DataFrame:
    """(span, place, value) of every value inside a span; its place is a part, or the value itself."""
    frames = []
    for places in _by_frame(measures):
        rows = []
        for number, (i, lo, hi, *_) in enumerate(spans):
            if i not in places:
                continue
            v = measures[i].value.cast("double")
            place = v
            if not by_value:
                width = hi - lo
                # An infinite range is not cut.
                place = F.floor((v - lo) / width * PARTS) if math.isfinite(width) else F.lit(0)
                place = F.least(place, F.lit(PARTS - 1)).cast("double")
            row = F.struct(F.lit(number).alias("span"), place.alias("place"), v.alias("value"))
            rows.append(F.when((v >= F.lit(lo)) & (v <= F.lit(hi)), row))
        if rows:
            frames.append(measures[places[0]].df.select(F.inline(F.array_compact(F.array(*rows)))))
    return reduce(DataFrame.union, frames)


def _holding(counts: DataFrame, spans: Sequence[tuple], ranks: Sequence[Sequence[int]]) -> DataFrame:
    """Counts that hold a wanted rank, with the rank at which each starts."""
    before = Window.partitionBy("span").orderBy("place")
    earlier = F.sum("n").over(before.rowsBetween(Window.unboundedPreceding, -1))
    wanted = F.array(
        *[F.array(*[F.lit(r).cast("long") for r in ranks[i]]) for i, *_ in spans]
    )
    base = F.array(*[F.lit(span[3]).cast("long") for span in spans])
    place = F.col("span") + 1
    found = counts.withColumn("start", F.element_at(base, place) + F.coalesce(earlier, F.lit(0)))
    end = F.col("start") + F.col("n")
    hit = F.exists(F.element_at(wanted, place), lambda r: (r >= F.col("start")) & (r < end))
    return found.where(hit).select("span", "n", "lo", "hi", "start")


# The quantiles reported for long-tailed measures.
TAIL_PROBS = {"q50": 0.5, "q90": 0.9, "q95": 0.95, "q99": 0.99, "q999": 0.999}


TAIL_COLUMNS = ", ".join(f"{name} double" for name in ["min", "max", *TAIL_PROBS])


def tail_summary(long: DataFrame, by: Sequence[str] = ("measure",)) -> DataFrame:
    """count, min, max and upper quantiles of a long (measure, value) frame of sizes, a row per measure.

    The values are sizes of disjoint groups; see ``quantiles_of_counts``.
    """
    counts = value_counts(long, "value", by)
    ends = counts.groupBy(*by).agg(
        F.sum("n").alias("n"), F.min("value").alias("min"), F.max("value").alias("max")
    )
    return ends.join(quantiles_of_counts(counts, TAIL_PROBS, by, True), list(by))


def tails_of_columns(measures: Mapping[str, Measure]) -> DataFrame:
    """The same summary of raw columns, whose values may all differ."""
    columns = list(measures.values())
    known = moments(columns)
    found = narrowed_quantiles(columns, list(TAIL_PROBS.values()), known)
    rows = [
        (name, m.n, m.min, m.max, *own)
        for name, m, own in zip(measures, known, found, strict=True)
        if m.n
    ]
    spark = columns[0].df.sparkSession
    return spark.createDataFrame(rows, f"measure string, n long, {TAIL_COLUMNS}")


def histogram(
    df: DataFrame, value: Column | str, bins: int = 80, log1p: bool = False
) -> DataFrame:
    """Equal-width bins over [min, max], empty ones included: bin, bin_lo, bin_hi, n.

    The last bin is closed. Where all values are equal the range is widened by half a unit on
    each side.
    """
    column = F.col(value) if isinstance(value, str) else value
    column = column.cast("double")
    counts = value_counts(df.select(F.log1p(column).alias("x") if log1p else column.alias("x")), "x")
    ends = counts.agg(F.min("value").alias("lo"), F.max("value").alias("hi"))
    ends = ends.where(F.col("lo").isNotNull()).select(
        F.when(F.col("lo") == F.col("hi"), F.col("lo") - 0.5).otherwise(F.col("lo")).alias("lo"),
        F.when(F.col("lo") == F.col("hi"), F.col("hi") + 0.5).otherwise(F.col("hi")).alias("hi"),
    )
    edges = ends.agg(F.first(F.struct("lo", "hi")).alias("s")).scalar()
    width = (F.col("_e.hi") - F.col("_e.lo")) / bins
    binned = (
        counts.select("*", edges.alias("_e"))
        .select(
            F.least(F.floor((F.col("value") - F.col("_e.lo")) / width), F.lit(bins - 1))
            .cast("int")
            .alias("bin"),
            "n",
        )
        .groupBy("bin")
        .agg(F.sum("n").alias("n"))
    )
    frame = ends.select(
        F.struct("lo", "hi").alias("_e"), F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin")
    ).select(
        "bin",
        (F.col("_e.lo") + F.col("bin") * width).alias("bin_lo"),
        (F.col("_e.lo") + (F.col("bin") + 1) * width).alias("bin_hi"),
    )
    return frame.join(binned, "bin", "left").select(
        "bin", "bin_lo", "bin_hi", F.coalesce("n", F.lit(0)).alias("n")
    )
