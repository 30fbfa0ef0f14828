"""Helpers of the operators: the shared folder, tables written once, and word arrays for tasks."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import shared_dir, use_sql_defaults

# Texts are worked on in slices of about this many bytes, so that a task's memory does not follow
# the size of an Arrow batch; a longer text is a slice by itself.
SLICE_BYTES = 1 << 20


# Rows of an Arrow batch: texts may be long, and a task holds a batch at a time.
BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch", "2000"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared folder and read back: its lineage ends here."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/llm-{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def documents(spark: SparkSession, sf_dir: str, table: str = "documents") -> DataFrame:
    """A table of the given folder, with the session settings that the operators count on."""
    use_sql_defaults(spark)
    if not spark.sparkContext.getConf().contains(BATCH_ROWS[0]):
        spark.conf.set(*BATCH_ROWS)
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def fold(column: Column | str, parts: int) -> Column:
    """crc32 of the value as text, modulo ``parts``: a split that any engine can repeat."""
    return F.crc32(F.col(column).cast("string") if isinstance(column, str) else column) % parts


def row_key() -> Column:
    """Tells rows of one doc_id apart that hold different texts."""
    return F.hash(F.coalesce("text", F.lit("")))


# ---- numpy helpers used inside tasks -------------------------------------------------------

SPACE = np.zeros(256, bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
_ODD = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit numbers (the finaliser of splitmix64)."""
    x = x.astype(np.uint64, copy=True)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x ^= x >> np.uint64(shift)
        x *= np.uint64(factor)
    return x ^ (x >> np.uint64(31))


_BYTES = mix(np.arange(1, 257, dtype=np.uint64))
_powers = {}


def _power(base: np.uint64, n: int) -> np.ndarray:
    """base ** 0 .. n modulo 2 ** 64; kept for the next call."""
    have = _powers.get(int(base))
    if have is None or len(have) <= n:
        have = np.full(max(n + 1, SLICE_BYTES + 4096), base, np.uint64)
        have[0] = 1
        np.multiply.accumulate(have, out=have)
        _powers[int(base)] = have
    return have[: n + 1]


def span_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of ``values[start:end]`` for every span, from one running sum."""
    n = len(values)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(values * _power(_ODD, n)[:n], out=sums[1:])
    spans = (sums[ends] - sums[starts]) * _power(_INVERSE, n)[starts]
    return mix(spans + (ends - starts).astype(np.uint64))


class Words:
    """The words of a slice of texts: byte spans, 64-bit hashes and first word of each text."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, lower: bool):
        self.data = LOWER[data] if lower else data
        word = ~SPACE[data]
        border = np.zeros(len(data) + 1, bool)
        border[offsets] = True
        start, end = word.copy(), word.copy()
        if len(data):
            start[1:] &= ~word[:-1] | border[1:-1]
            end[:-1] &= ~word[1:] | border[1:-1]
        self.starts = np.flatnonzero(start)
        self.ends = np.flatnonzero(end) + 1
        self.first = np.searchsorted(self.starts, offsets)  # one more than there are texts
        self.counts = np.diff(self.first)
        self.hashes = span_hashes(_BYTES[self.data], self.starts, self.ends)

    def runs(self, width: int) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of all runs of ``width`` words, over text borders too, and the text of each word."""
        n = max(0, len(self.starts) - width + 1)
        at = np.arange(n)
        return span_hashes(self.hashes, at, at + width), self.text_of()

    def text_of(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.counts)), self.counts)


def bodies(
    texts: pa.Array, size: int = SLICE_BYTES
) -> Iterator[tuple[slice, np.ndarray, np.ndarray]]:
    """Row ranges of about ``size`` bytes with their UTF-8 and where each text starts in it."""
    texts = texts.cast(pa.large_binary()).fill_null(b"")
    if len(texts) == 0:
        return
    _, where, body = texts.buffers()
    offsets = np.frombuffer(where, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(body, np.uint8) if body else np.zeros(0, np.uint8)
    low = 0
    while low < len(texts):
        high = int(np.searchsorted(offsets, offsets[low] + size, "right")) - 1
        high = min(max(high, low + 1), len(texts))
        own = offsets[low : high + 1]
        yield slice(low, high), data[own[0] : own[-1]], own - own[0]
        low = high


def slices(
    batch: pa.RecordBatch, column: str = "text", lower: bool = False
) -> Iterator[tuple[slice, Words]]:
    """Row ranges of a batch with their words; a null text has none."""
    for rows, data, offsets in bodies(batch.column(column)):
        yield rows, Words(data, offsets, lower)


def distinct_spans(
    data: np.ndarray, offsets: np.ndarray, border: np.ndarray
) -> tuple[np.ndarray, list[bytes], np.ndarray]:
    """Texts cut at every true ``border`` (before that byte) and at their own.

    Returns the number of every span's bytes among the distinct ones, these, and the first span of
    each text (one more than there are texts).
    """
    border[offsets[:-1][offsets[:-1] < len(data)]] = True
    starts = np.flatnonzero(border)
    ends = np.append(starts, len(data)).astype(np.int64)
    spans = pa.Array.from_buffers(
        pa.large_binary(),
        len(starts),
        [None, pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(data))],
    ).dictionary_encode()
    return spans.indices.to_numpy(), spans.dictionary.to_pylist(), np.searchsorted(starts, offsets)


def changes(kind: np.ndarray) -> np.ndarray:
    """Where a value differs from the one before it."""
    border = np.zeros(len(kind), bool)
    border[1:] = kind[1:] != kind[:-1]
    return border


def gathered(table: list[bytes], at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The 32-bit numbers of ``table`` (bytes of each row) for every row in ``at``, and how many."""
    size = np.fromiter(map(len, table), np.int64, len(table)) // 4
    first = np.cumsum(size) - size
    length = size[at]
    take = np.repeat(first[at], length) + spread(length)
    return np.frombuffer(b"".join(table), "<u4")[take], length


def runs_of_equal(*columns: np.ndarray) -> np.ndarray:
    """Indices at which a row differs from the row before it in any column (0 included)."""
    n = len(columns[0])
    new = np.zeros(n, bool)
    new[:1] = True
    for c in columns:
        new[1:] |= c[1:] != c[:-1]
    return np.flatnonzero(new)


def spread(lengths: np.ndarray) -> np.ndarray:
    """0 .. length - 1 for every length, one after the other."""
    total = int(lengths.sum())
    return np.arange(total) - np.repeat(np.cumsum(lengths) - lengths, lengths)
