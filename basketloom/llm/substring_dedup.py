"""Removal of repeated passages by super-k-mer partitioning.

A window is ``window`` consecutive words of one document. Consecutive windows that share a
minimiser (the smallest hash of a ``mmer``-word run inside them) form a super-k-mer. Equal windows
have equal minimisers, so everything that can repeat meets in the bucket of its minimiser:

1. Every document is cut into super-k-mers; only (minimiser, digest, place) is kept, written once.
   Minimisers seen in one document alone cannot repeat and are dropped before any text moves.
2. One document per distinct super-k-mer packs it as one string and sends it to its bucket. Hot
   minimisers (more than ``hot`` distinct strings) are cut into single windows that travel to a
   bucket of their own each, so that no bucket grows with a common line.
3. A bucket sorts its windows and gives each the smallest doc_id in which it starts. The sort key
   is a hash; neighbours with one key are compared word by word, so counts are exact.
4. Occurrences pick up the firsts of their string, and windows first seen elsewhere mark words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import row_key, runs_of_equal, slices, span_hashes, spread, written

WINDOW = 50
MMER = 10
# Longest run of windows in one packed string.
LONGEST = 64
# Distinct strings of a minimiser beyond which its windows travel one by one.
HOT = 2048
# Bytes of packed strings that a bucket sorts at once.
CHUNK_BYTES = 2 << 20


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` neighbours, from running minima of blocks."""
    n = len(values)
    blocks = -(-n // width)
    padded = np.full(blocks * width, np.iinfo(np.uint64).max, np.uint64)
    padded[:n] = values
    grid = padded.reshape(blocks, width)
    ahead = np.minimum.accumulate(grid, axis=1).ravel()
    back = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[: n - width + 1], ahead[width - 1 : n])


def cut(words, window: int, mmer: int) -> tuple[np.ndarray, ...]:
    """Super-k-mers of a slice: text, start word in it, number of windows, minimiser, digest."""
    none = np.zeros(0, np.int64)
    total = len(words.starts)
    if total < window:
        return none, none, none, none.astype(np.uint64), none.astype(np.uint64)
    grams, text = words.runs(mmer)
    least = sliding_min(grams, window - mmer + 1)
    at = np.arange(len(least))
    at = at[text[at] == text[at + window - 1]]  # windows inside one text
    if not len(at):
        return none, none, none, none.astype(np.uint64), none.astype(np.uint64)
    border = runs_of_equal(text[at], least[at], at - np.arange(len(at)))
    length = np.diff(np.append(border, len(at)))
    pieces = -(-length // LONGEST)
    inner = spread(pieces) * LONGEST
    head = np.repeat(border, pieces) + inner
    length = np.minimum(np.repeat(length, pieces) - inner, LONGEST)
    start = at[head]
    digest = span_hashes(words.hashes, start, start + length + window - 1)
    return text[start], start - words.first[text[start]], length, least[start], digest


def _places(window: int, mmer: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("doc_id").to_numpy(zero_copy_only=False)
            keys = batch.column("row_key").to_numpy(zero_copy_only=False)
            for rows, words in slices(batch):
                text, start, length, least, digest = cut(words, window, mmer)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(least.view(np.int64)),
                        pa.array(digest.view(np.int64)),
                        pa.array(ids[rows][text], pa.int64()),
                        pa.array(keys[rows][text], pa.int32()),
                        pa.array(start.astype(np.int32)),
                        pa.array(length.astype(np.int32)),
                    ],
                    ["minimiser", "digest", "doc_id", "row_key", "start", "windows"],
                )

    return run


def _pack(window: int):
    """Documents with the super-k-mers they send -> packed strings with their bucket."""
    long = pa.int64()
    names = ["bucket", "minimiser", "digest", "at", "low", "high", "packed"]
    schema = pa.schema(list(zip(names, [long, long, long, pa.int32(), long, long, pa.binary()])))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[] for _ in names]
            size = 0
            batch = batch.filter(pa.compute.is_valid(batch.column("sends")))
            for text, sends in zip(batch.column("text"), batch.column("sends"), strict=True):
                words = (text.as_py() or "").encode().split()
                for s in sends.as_py():
                    step = 1 if s["hot"] else s["windows"]
                    for i in range(0, s["windows"], step):
                        low = s["start"] + i
                        packed = b" ".join(words[low : low + step + window - 1])
                        size += len(packed)
                        # A window of a hot minimiser goes where its words say.
                        where = s["minimiser"] if not s["hot"] else hash_of(packed)
                        row = where, s["minimiser"], s["digest"], i, s["low"], s["high"], packed
                        for column, value in zip(out, row, strict=True):
                            column.append(value)
                if size > CHUNK_BYTES:
                    yield pa.RecordBatch.from_pydict(dict(zip(names, out)), schema)
                    out, size = [[] for _ in names], 0
            if out[0]:
                yield pa.RecordBatch.from_pydict(dict(zip(names, out)), schema)

    return run


def hash_of(packed: bytes) -> int:
    data = np.frombuffer(packed, np.uint8).astype(np.uint64) + np.uint64(1)
    return int(span_hashes(data, np.array([0]), np.array([len(data)])).view(np.int64)[0])


def first_seen(packed: list[bytes], low: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """For every window of every string the smallest ``low`` of a string that holds it.

    Returns the windows of each string and the firsts, string after string.
    """
    numbers: dict[bytes, int] = {}
    ids, lengths = [], []
    for string in packed:
        parts = string.split(b" ")
        ids += [numbers.setdefault(w, len(numbers)) for w in parts]
        lengths.append(len(parts))
    ids = np.array(ids, np.int64)
    lengths = np.array(lengths)
    windows = lengths - window + 1
    start = np.repeat(np.cumsum(lengths) - lengths, windows) + spread(windows)
    key = span_hashes(ids.astype(np.uint64) + np.uint64(1), start, start + window)
    docs = np.repeat(low, windows)
    order = np.lexsort((docs, key))
    head = runs_of_equal(key[order])
    inner = np.ones(len(order), bool)
    inner[head] = False
    later = np.flatnonzero(inner)
    view = np.lib.stride_tricks.sliding_window_view(ids, window)
    for part in np.array_split(later, max(1, len(later) >> 16)):
        if (view[start[order[part]]] != view[start[order[part - 1]]]).any():
            # Two sequences with one hash: number the sequences themselves instead.
            exact: dict[bytes, int] = {}
            key = np.array([exact.setdefault(view[s].tobytes(), len(exact)) for s in start])
            order = np.lexsort((docs, key))
            head = runs_of_equal(key[order])
            break
    firsts = np.empty(len(order), np.int64)
    firsts[order] = np.repeat(docs[order][head], np.diff(np.append(head, len(order))))
    return windows, firsts


def _bucket(window: int):
    """Packed strings sorted by bucket -> firsts of each string that has a repeated window."""
    names = ["minimiser", "digest", "at", "firsts"]

    def settle(rows: pa.Table) -> pa.RecordBatch:
        low = rows["low"].to_numpy()
        windows, firsts = first_seen(rows["packed"].to_pylist(), low, window)
        border = np.append(0, np.cumsum(windows))
        # Only strings that also occur in a document later than a window's first one matter.
        least = np.minimum.reduceat(firsts, border[:-1])
        keep = np.flatnonzero(least < rows["high"].to_numpy())
        lists = pa.ListArray.from_arrays(
            pa.array(border.astype(np.int32)), pa.array(firsts)
        ).take(pa.array(keep))
        kept = rows.take(pa.array(keep))
        arrays = [kept[c].combine_chunks() for c in names[:3]]
        return pa.RecordBatch.from_arrays([*arrays, lists], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size = 0
        for batch in batches:
            held.append(batch)
            size += batch.nbytes
            if size < CHUNK_BYTES:
                continue
            table = pa.Table.from_batches(held)
            bucket = table["bucket"].to_numpy()
            border = runs_of_equal(bucket)[-1]
            if border:
                yield settle(table.slice(0, border))
            held = table.slice(border).to_batches()
            size = sum(b.nbytes for b in held) if border else 0
        if held:
            table = pa.Table.from_batches(held)
            if len(table):
                yield settle(table)

    return run


def _marks(window: int):
    """Occurrences with the firsts of their string -> spans of words to remove."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not len(batch):
                continue
            lists = batch.column("firsts")
            lengths = np.diff(lists.offsets.to_numpy())
            docs = batch.column("doc_id").to_numpy()
            repeated = lists.flatten().to_numpy() < np.repeat(docs, lengths)
            row = np.repeat(np.arange(len(docs)), lengths)[repeated]
            place = spread(lengths)[repeated]
            if not len(row):
                continue
            head = runs_of_equal(row, place - np.arange(len(place)))
            last = np.append(head[1:], len(row)) - 1
            base = (batch.column("start").to_numpy() + batch.column("at").to_numpy())[row[head]]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(docs[row[head]]),
                    pa.array(batch.column("row_key").to_numpy()[row[head]]),
                    pa.array((base + place[head]).astype(np.int32)),
                    pa.array((base + place[last] + window).astype(np.int32)),
                ],
                ["doc_id", "row_key", "low", "high"],
            )

    return run


def _strip(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for low in range(0, len(batch), 256):
            part = batch.slice(low, 256)
            n_words, n_removed, kept = [], [], []
            for text, spans in zip(part.column("text"), part.column("spans"), strict=True):
                words = (text.as_py() or "").encode().split()
                n_words.append(len(words))
                if spans.is_valid:
                    keep = np.ones(len(words), bool)
                    for s in spans.as_py():
                        keep[s["low"] : s["high"]] = False
                    words = [words[i] for i in np.flatnonzero(keep)]
                n_removed.append(n_words[-1] - len(words))
                kept.append(b" ".join(words).decode())
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("doc_id"),
                    part.column("row_key"),
                    pa.array(n_words, pa.int64()),
                    pa.array(n_removed, pa.int64()),
                    pa.array(kept, pa.string()),
                ],
                ["doc_id", "row_key", "n_words", "n_removed", "kept_text"],
            )


def remove_repeats(
    docs: DataFrame, window: int = WINDOW, mmer: int = MMER, hot: int = HOT
) -> DataFrame:
    """Per document: doc_id, row_key, n_words, n_removed, kept_text (kept words, single blanks).

    A word is removed if a window over it also starts in a document with a smaller doc_id. Words are
    runs of bytes other than blank, tab, line feed, vertical tab, form feed and carriage return.
    Null and empty texts have no words and stay; a text shorter than the window loses nothing; rows
    that repeat a doc_id never remove each other's words and come out once each; a null doc_id is
    compared with nothing. Other columns of ``docs`` are ignored. An empty table gives an empty one.
    """
    source = docs.select("doc_id", row_key().alias("row_key"), "text")
    place_schema = (
        "minimiser long, digest long, doc_id long, row_key int, start int, windows int"
    )
    places = written(
        source.where("doc_id is not null").mapInArrow(_places(window, mmer), place_schema),
        "places",
    )
    shared = (
        places.groupBy("minimiser")
        .agg(F.min("doc_id").alias("a"), F.max("doc_id").alias("b"))
        .where("a < b")
        .select("minimiser")
    )
    found = written(places.join(shared, "minimiser"), "found")
    strings = found.groupBy("minimiser", "digest").agg(
        F.min(F.struct("doc_id", "row_key", "start", "windows")).alias("rep"),
        F.max("doc_id").alias("high"),
    )
    crowded = (
        strings.groupBy("minimiser")
        .agg(F.count(F.lit(1)).alias("n"))
        .select("minimiser", (F.col("n") > hot).alias("hot"))
    )
    sends = (
        strings.join(crowded, "minimiser")
        .groupBy("rep.doc_id", "rep.row_key")
        .agg(
            F.collect_list(
                F.struct(
                    "minimiser",
                    "digest",
                    "rep.start",
                    "rep.windows",
                    F.col("rep.doc_id").alias("low"),
                    "high",
                    "hot",
                )
            ).alias("sends")
        )
    )
    key = ["doc_id", "row_key"]
    packed = source.join(sends, key, "left").select("text", "sends").mapInArrow(
        _pack(window),
        "bucket long, minimiser long, digest long, at int, low long, high long, packed binary",
    )
    firsts = (
        packed.repartition("bucket")
        .sortWithinPartitions("bucket")
        .mapInArrow(_bucket(window), "minimiser long, digest long, at int, firsts array<long>")
    )
    spans = (
        found.join(firsts, ["minimiser", "digest"])
        .select("doc_id", "row_key", "start", "at", "firsts")
        .mapInArrow(_marks(window), "doc_id long, row_key int, low int, high int")
        .groupBy(*key)
        .agg(F.collect_list(F.struct("low", "high")).alias("spans"))
    )
    return source.join(spans, key, "left").select(*key, "text", "spans").mapInArrow(
        _strip, "doc_id long, row_key int, n_words long, n_removed long, kept_text string"
    )


def replace_repeats(docs: DataFrame, window: int = WINDOW, mmer: int = MMER) -> DataFrame:
    """``docs`` with repeated passages removed from ``text``, and ``n_chars`` set where present.

    Texts that lose nothing keep their white space.
    """
    changed = (
        remove_repeats(docs, window, mmer)
        .where("n_removed > 0")
        .dropDuplicates(["doc_id", "row_key"])
        .select(F.col("doc_id").alias("_d"), F.col("row_key").alias("_k"), F.col("kept_text").alias("_t"))
    )
    joined = docs.join(changed, (docs.doc_id == changed._d) & (row_key() == changed._k), "left")
    text = F.coalesce("_t", "text")
    columns = {"text": text, "n_chars": F.when(F.col("_t").isNull(), docs["n_chars"]).otherwise(
        F.length("_t")
    )} if "n_chars" in docs.columns else {"text": text}
    return joined.select(*[columns.get(c, docs[c]).alias(c) for c in docs.columns])


def op10_substring_dedup(spark, sf_dir: str) -> DataFrame:
    from .shared import documents

    return remove_repeats(documents(spark, sf_dir)).select(
        "doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256")
    )


# Registered without SQL: tests hold it against a direct search over a small fixture.
QUERIES = {"op10_substring_dedup": op10_substring_dedup}
ORACLES: dict[str, str] = {}
