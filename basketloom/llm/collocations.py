"""Phrase collocations of every language, counted by prefix-free parsing.

1. Parse. A document's words are cut where the hash of a run of three words says so: a chunk goes on
   to the end of the next such run, so neighbours share exactly three words. Equal passages give
   equal chunks wherever they stand. Chunks with their frequencies are the dictionary; every task
   adds up its own first, and a chunk belongs to one part of the dictionary by its hash.
2. Cells. Each part counts the distinct phrases of its chunks, weighted by the chunks' frequencies. A
   phrase starts in the chunk's own words, so one that lies in an overlap counts once. Only hashes
   travel, packed by shard, and a shard answers every part with the cells that reach the least count.
   Collisions can but admit a phrase too many.
3. Phrases. Parts write out the phrases of those cells; their exact counts are added up by text.

Chunks are dealt once: both passes read the same exchange.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.running import top_per_key
from .shared import LOWER, SLICE_BYTES, documents, mix, runs_of_equal, span_hashes, spread, written

LONGEST = 4
LEAST = 30
KEPT = 2000
UNIT = 2_000_000
COVERED = 80
NO_LANG = "und"

# Words that a chunk shares with the next one, and the chance of a cut at a run of so many.
OVERLAP = LONGEST - 1
CUT = 32
# Text of a part, and of a shard of cells: what one task holds at a time.
PART_BYTES = 4 << 20
SHARD_BYTES = 12 << 20
# Chunks that a task adds up before it passes them on.
HELD_CHUNKS = 200_000
# Frequent phrases to a share of a language's ranking.
SHARE_ROWS = 200_000

# 0: inside a word, 1: between words, 2: between pieces.
KIND = np.zeros(256, np.uint8)
KIND[[0x20, 0x09]] = 1
KIND[[ord(c) for c in ".,;:!?"] + [0x0A, 0x0B, 0x0C, 0x0D]] = 2
_BYTE = mix(np.arange(1, 257, dtype=np.uint64))


class Stream:
    """Words of a run of bytes as spans; ``opens`` marks the first word of a piece.

    ``limits`` are offsets at which a text ends, and with it a word and a piece.
    """

    def __init__(self, data: np.ndarray, limits: np.ndarray):
        self.data = data
        kind = KIND[data]
        word = kind == 0
        border = np.zeros(len(data) + 1, bool)
        border[limits] = True
        start, end = word.copy(), word.copy()
        if len(data):
            start[1:] &= ~word[:-1] | border[1:-1]
            end[:-1] &= ~word[1:] | border[1:-1]
        self.starts, self.ends = np.flatnonzero(start), np.flatnonzero(end) + 1
        breaks = np.cumsum((kind == 2) | border[:-1])
        piece = breaks[self.starts]
        self.opens = np.ones(len(piece), bool)
        self.opens[1:] = piece[1:] != piece[:-1]
        self.first = np.searchsorted(self.starts, limits)

    def hashes(self) -> np.ndarray:
        return span_hashes(_BYTE[self.data], self.starts, self.ends)

    def normal(self) -> tuple[bytes, np.ndarray, np.ndarray]:
        """The words with one byte after each (line feed before a new piece), and their spans there."""
        length = self.ends - self.starts
        after = np.cumsum(length + 1)
        out = np.full(int(after[-1]) if len(after) else 0, 0x20, np.uint8)
        at = np.repeat(after - length - 1, length) + spread(length)
        out[at] = self.data[np.repeat(self.starts, length) + spread(length)]
        out[after[:-1][self.opens[1:]] - 1] = 0x0A
        return out.tobytes(), after - length - 1, after - 1


def _text_slices(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """First row, bytes and offsets of about ``SLICE_BYTES`` of texts; null counts as empty."""
    texts = batch.column("text").cast(pa.binary()).fill_null(b"")
    _, where, body = texts.buffers()
    offsets = np.frombuffer(where, np.int32)[texts.offset : texts.offset + len(texts) + 1]
    offsets = offsets.astype(np.int64)
    data = np.frombuffer(body, np.uint8) if body else np.zeros(0, np.uint8)
    low = 0
    while low < len(texts):
        high = int(np.searchsorted(offsets, offsets[low] + SLICE_BYTES, "right")) - 1
        high = min(max(high, low + 1), len(texts))
        yield low, LOWER[data[offsets[low] : offsets[high]]], offsets[low : high + 1] - offsets[low]
        low = high


def chunks_of(data: np.ndarray, limits: np.ndarray) -> tuple[np.ndarray, list[bytes]]:
    """The chunks of some texts with the text of each.

    A line feed in place of a space opens a piece; one at the end says that all words are the
    chunk's own, otherwise the last ``OVERLAP`` are the next chunk's.
    """
    stream = Stream(data, limits)
    n = len(stream.starts)
    owner = np.repeat(np.arange(len(limits) - 1), np.diff(stream.first))
    values = stream.hashes() ^ (stream.opens * np.uint64(0xA5A5A5A5))
    cut = np.zeros(n, bool)
    if n >= OVERLAP:
        at = np.arange(n - OVERLAP + 1)
        cut[at] = span_hashes(values, at, at + OVERLAP) % np.uint64(CUT) == 0
        cut[at] &= owner[at] == owner[at + OVERLAP - 1]
    begins = np.zeros(n, bool)
    begins[stream.first[:-1][np.diff(stream.first) > 0]] = True
    low = np.flatnonzero(cut | begins)
    last = np.append(owner[low][1:] != owner[low][:-1], True) if len(low) else np.zeros(0, bool)
    text_end = stream.first[owner[low] + 1]
    following = np.append(low[1:], n)
    high = np.where(last, text_end, np.minimum(following + OVERLAP, text_end))
    body, starts, ends = stream.normal()
    found = [
        body[a:b] + b"\n" if final else body[a:b]
        for a, b, final in zip(starts[low], ends[high - 1], last, strict=True)
    ]
    return owner[low], found


def _parse(parts: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[str, bytes], int] = {}
        size = 0
        for batch in batches:
            langs = batch.column("lang").fill_null(NO_LANG).to_pylist()
            for row, data, limits in _text_slices(batch):
                owner, found = chunks_of(data, limits)
                for i, chunk in zip(owner.tolist(), found, strict=True):
                    key = langs[row + i], chunk
                    if key in held:
                        held[key] += 1
                    else:
                        held[key] = 1
                        size += len(chunk)
                if size > 8 * SLICE_BYTES or len(held) > HELD_CHUNKS:
                    yield from _packed(held, parts)
                    held, size = {}, 0
        yield from _packed(held, parts)

    return run


def _packed(held: dict, parts: int) -> Iterator[pa.RecordBatch]:
    rows = list(held.items())
    for low in range(0, len(rows), 20_000):
        some = rows[low : low + 20_000]
        chunks = [chunk for (_, chunk), _ in some]
        limits = np.append(0, np.cumsum([len(c) for c in chunks]))
        data = np.frombuffer(b"".join(chunks), np.uint8)
        part = span_hashes(_BYTE[data], limits[:-1], limits[1:]) % np.uint64(parts)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(part.astype(np.int64)),
                pa.array([lang for (lang, _), _ in some], pa.string()),
                pa.array(chunks, pa.binary()),
                pa.array([n for _, n in some], pa.int64()),
            ],
            ["part", "lang", "chunk", "n"],
        )


class Part:
    """The words of a part's distinct chunks, and the hashes of the phrases they start."""

    def __init__(self, table: pa.Table):
        merged = table.select(["lang", "chunk", "n"]).group_by(["lang", "chunk"], use_threads=False)
        merged = merged.aggregate([("n", "sum")]).combine_chunks()
        lang = merged["lang"].combine_chunks().dictionary_encode()
        self.langs = lang.dictionary.to_pylist()
        chunks = merged["chunk"].to_pylist()
        limits = np.append(0, np.cumsum([len(c) for c in chunks])).astype(np.int64)
        data = np.frombuffer(b"".join(chunks), np.uint8)
        self.stream = Stream(data, limits)
        words = np.diff(self.stream.first)
        self.owner = np.repeat(np.arange(len(chunks)), words)
        final = np.array([c.endswith(b"\n") for c in chunks], bool)
        rest = self.stream.first[1:][self.owner] - np.arange(len(self.owner))
        #: A word whose phrases count here; the others start phrases of the next chunk.
        self.own = final[self.owner] | (rest > OVERLAP)
        self.weight = merged["n_sum"].to_numpy()[self.owner]
        self.lang = lang.indices.to_numpy()[self.owner]
        named = [np.frombuffer(s.encode(), np.uint8) for s in self.langs]
        salt = [span_hashes(_BYTE[b], np.array([0]), np.array([len(b)]))[0] for b in named]
        self.salt = np.array(salt, np.uint64)[self.lang] if salt else np.zeros(0, np.uint64)

    def phrases(self) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """For every length: first words and hashes of the phrases, language included."""
        values = self.stream.hashes()
        n = len(values)
        broken = np.append(0, np.cumsum(self.stream.opens))
        for length in range(1, LONGEST + 1):
            at = np.flatnonzero(self.own[: max(0, n - length + 1)])
            at = at[broken[at + length] == broken[at + 1]]
            yield length, at, mix(span_hashes(values, at, at + length) ^ self.salt[at])


def _place(hashes: np.ndarray, shards: int) -> np.ndarray:
    """Shard and 32 bits of a hash in one number: its cell."""
    high = (hashes >> np.uint64(32)) % np.uint64(shards)
    return (high << np.uint64(32)) | (hashes & np.uint64(0xFFFFFFFF))


CELLS = "shard long, part long, once binary, more binary, counts binary"


def _cells(shards: int):
    def run(key: tuple, table: pa.Table) -> pa.Table:
        part = Part(table)
        found = [(_place(h, shards), part.weight[at]) for _, at, h in part.phrases()]
        cell = np.concatenate([c for c, _ in found])
        weight = np.concatenate([w for _, w in found])
        order = np.argsort(cell)
        cell = cell[order]
        first = runs_of_equal(cell)
        n = np.add.reduceat(weight[order], first) if len(first) else weight
        cell = cell[first]
        shard = cell >> np.uint64(32)
        low = (cell & np.uint64(0xFFFFFFFF)).astype(np.uint32)
        borders = np.append(runs_of_equal(shard), len(cell))
        rows = []
        for a, b in zip(borders[:-1], borders[1:], strict=True):
            single = n[a:b] == 1
            rows.append(
                (
                    int(shard[a]),
                    low[a:b][single].tobytes(),
                    low[a:b][~single].tobytes(),
                    n[a:b][~single].astype(np.int64).tobytes(),
                )
            )
        number, once, more, counts = zip(*rows, strict=True) if rows else ((),) * 4
        return pa.table(
            [
                pa.array(number, pa.int64()),
                pa.array([key[0].as_py()] * len(rows), pa.int64()),
                pa.array(once, pa.binary()),
                pa.array(more, pa.binary()),
                pa.array(counts, pa.binary()),
            ],
            names=["shard", "part", "once", "more", "counts"],
        )

    return run


ANSWERS = "part long, shard long, cells binary"


def _answers(least: int):
    def run(key: tuple, table: pa.Table) -> pa.Table:
        once = [np.frombuffer(b, np.uint32) for b in table["once"].to_pylist()]
        more = [np.frombuffer(b, np.uint32) for b in table["more"].to_pylist()]
        counts = [np.frombuffer(b, np.int64) for b in table["counts"].to_pylist()]
        cell = np.concatenate([*once, *more])
        n = np.concatenate([np.ones(sum(map(len, once)), np.int64), *counts])
        order = np.argsort(cell)
        first = runs_of_equal(cell[order])
        total = np.add.reduceat(n[order], first) if len(first) else n
        often = cell[order][first][total >= least]
        sent = []
        for a, b in zip(once, more, strict=True):
            mine = np.concatenate([a, b])
            at = np.minimum(np.searchsorted(often, mine), max(0, len(often) - 1))
            sent.append(mine[often[at] == mine].tobytes() if len(often) else b"")
        return pa.table(
            [table["part"], table["shard"], pa.array(sent, pa.binary())],
            names=["part", "shard", "cells"],
        )

    return run


PHRASES = "lang string, phrase string, n long"


def _spell(shards: int):
    def run(key, table: pa.Table, answers: pa.Table) -> pa.Table:
        part = Part(table)
        admitted = [
            np.frombuffer(b, np.uint32).astype(np.uint64) | np.uint64(s << 32)
            for s, b in zip(answers["shard"].to_pylist(), answers["cells"].to_pylist(), strict=True)
        ]
        admitted = np.sort(np.concatenate(admitted)) if admitted else np.zeros(0, np.uint64)
        body, starts, ends = part.stream.normal()
        tables = []
        for length, at, hashes in part.phrases():
            if not len(admitted):
                break
            cell = _place(hashes, shards)
            near = np.minimum(np.searchsorted(admitted, cell), len(admitted) - 1)
            at = at[admitted[near] == cell]
            texts = [body[a:b] for a, b in zip(starts[at], ends[at + length - 1], strict=True)]
            rows = pa.table(
                {
                    "lang": pa.array(part.lang[at]),
                    "phrase": pa.array(texts, pa.binary()),
                    "n": pa.array(part.weight[at]),
                }
            ).group_by(["lang", "phrase"], use_threads=False)
            tables.append(rows.aggregate([("n", "sum")]))
        # Words of every language, under no phrase.
        words = np.bincount(
            part.lang[part.own], part.weight[part.own], minlength=len(part.langs)
        ).astype(np.int64) if len(part.langs) else np.zeros(0, np.int64)
        langs = pa.array(part.langs, pa.string())
        total = pa.table(
            {
                "lang": langs,
                "phrase": pa.nulls(len(langs), pa.string()),
                "n": pa.array(words),
            }
        )
        spelled = [
            pa.table(
                {
                    "lang": langs.take(t["lang"]),
                    "phrase": t["phrase"].cast(pa.string()),
                    "n": t["n_sum"],
                }
            )
            for t in tables
        ]
        return pa.concat_tables([total, *spelled])

    return run


def phrase_counts(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """(lang, phrase, n) of every phrase of up to ``LONGEST`` words that occurs ``least`` times.

    The row with a null phrase has the number of words of the language.
    """
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts, shards = max(1, -(-size // PART_BYTES)), max(1, -(-size // SHARD_BYTES))
    chunks = (
        docs.select("lang", "text")
        .mapInArrow(_parse(parts), "part long, lang string, chunk binary, n long")
        .repartition("part")
    )
    answers = (
        chunks.groupBy("part")
        .applyInArrow(_cells(shards), CELLS)
        .groupBy("shard")
        .applyInArrow(_answers(least), ANSWERS)
    )
    return (
        chunks.groupBy("part")
        .cogroup(answers.groupBy("part"))
        .applyInArrow(_spell(shards), PHRASES)
        .groupBy("lang", "phrase")
        .agg(F.sum("n").alias("n"))
        .where(F.col("phrase").isNull() | (F.col("n") >= least))
    )


def _product(factor: int, column: Column | str) -> Column:
    """A product that may pass 64 bits."""
    column = F.col(column) if isinstance(column, str) else column
    return F.lit(factor).cast("decimal(10,0)") * column.cast("decimal(20,0)")


def score(a: Column, left: Column, right: Column) -> Column:
    """floor(UNIT a / (left + right))."""
    whole = F.call_function("div", _product(UNIT, a), (left + right).cast("decimal(20,0)"))
    return whole.cast("long")


def _runs(words: Column, count: Column, length: int) -> Column:
    """All runs of ``length`` words as phrases."""
    starts = F.sequence(F.lit(1), F.greatest(count - (length - 1), F.lit(1)))
    return F.transform(starts, lambda i: F.concat_ws(" ", F.slice(words, i, F.lit(length))))


def collocations(docs: DataFrame, least: int = LEAST, kept: int = KEPT) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the ``kept`` best phrases of every language.

    A phrase has two to four words of one piece of text and occurs ``least`` times; its worst cut
    into two parts decides its score, and it is dropped where a longer phrase around it occurs
    nearly as often. Null texts are empty, a null lang is ``und``. Every row is a document, repeated
    ones too; other columns are ignored; an empty table gives no rows.
    """
    counts = written(phrase_counts(docs, least), "phrases")
    phrases = counts.where("phrase IS NOT NULL")
    words = F.split("phrase", " ")
    candidates = phrases.select(
        "lang", "phrase", F.col("n").alias("a"), words.alias("words"), F.size(words).alias("size")
    ).where("size > 1")

    # Phrases that lie in a longer one, with the most frequent of those.
    inner = F.concat(
        *[
            F.when(F.col("size") > length, _runs(F.col("words"), F.col("size"), length)).otherwise(
                F.array().cast("array<string>")
            )
            for length in range(2, LONGEST)
        ]
    )
    around = (
        candidates.where("size > 2")
        .select("lang", F.explode(inner).alias("phrase"), "a")
        .groupBy("lang", "phrase")
        .agg(F.max("a").alias("most"))
    )
    outer = candidates.join(around, ["lang", "phrase"], "left").where(
        F.col("most").isNull() | (_product(100, "most") < _product(COVERED, "a"))
    )

    cuts = outer.select(
        "lang", "phrase", "a", "words", "size",
        F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k"),
    ).select(
        "lang", "phrase", "a", "k",
        F.concat_ws(" ", F.slice("words", F.lit(1), F.col("k"))).alias("head"),
        F.concat_ws(" ", F.slice("words", F.col("k") + 1, F.col("size") - F.col("k"))).alias("tail"),
    )
    heads = phrases.select("lang", F.col("phrase").alias("head"), F.col("n").alias("l"))
    tails = phrases.select("lang", F.col("phrase").alias("tail"), F.col("n").alias("r"))
    worst = (
        cuts.join(heads, ["lang", "head"])
        .join(tails, ["lang", "tail"])
        .select(
            "lang", "phrase", "a",
            F.struct(score(F.col("a"), F.col("l"), F.col("r")).alias("score"), "k", "l", "r").alias("cut"),
        )
        .groupBy("lang", "phrase", "a")
        .agg(F.min("cut").alias("cut"))
        .select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")
    )
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    # The best of every share of a language first, so that no task sorts a whole language.
    shares = 1 + counts.count() // SHARE_ROWS
    shared = worst.withColumn("_share", F.pmod(F.xxhash64("phrase"), F.lit(shares)))
    shared = top_per_key(shared, ["lang", "_share"], order, kept).drop("_share")
    ranked = top_per_key(shared, ["lang"], order, kept, "rank")
    totals = counts.where("phrase IS NULL").select("lang", "n")
    return ranked.join(totals, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score"
    )


def op12_collocations(spark, sf_dir: str) -> DataFrame:
    return collocations(documents(spark, sf_dir))


_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

QUERIES = {"op12_collocations": op12_collocations}
ORACLES = {
    "op12_collocations": rf"""
WITH p AS (SELECT coalesce(lang, '{NO_LANG}') AS lang, unnest(string_split_regex(
    translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM p),
g AS (SELECT lang, len AS size, array_to_string(w[i:i + len - 1], ' ') AS phrase
  FROM (SELECT lang, w, len, unnest(range(1, len(w) - len + 2)) AS i
    FROM w, (SELECT unnest(range(1, {LONGEST + 1})) AS len))),
f AS (SELECT lang, phrase, any_value(size) AS size, count(*) AS a FROM g GROUP BY lang, phrase
  HAVING count(*) >= {LEAST}),
t AS (SELECT lang, count(*) AS n FROM g WHERE size = 1 GROUP BY lang),
c AS (SELECT lang, phrase, size, a, string_split(phrase, ' ') AS w FROM f WHERE size > 1),
longer AS (SELECT lang, array_to_string(w[i:i + len - 1], ' ') AS phrase, max(a) AS most
  FROM (SELECT *, unnest(range(1, size - len + 2)) AS i
    FROM c, (SELECT unnest(range(2, {LONGEST})) AS len) WHERE len < size) GROUP BY ALL),
o AS (SELECT c.* FROM c LEFT JOIN longer USING (lang, phrase)
  WHERE most IS NULL OR 100::hugeint * most < {COVERED}::hugeint * a),
k AS (SELECT o.lang, o.phrase, o.a, k, x.a AS l, y.a AS r,
    {UNIT}::hugeint * o.a // (x.a + y.a) AS score
  FROM (SELECT *, unnest(range(1, size)) AS k FROM o) o
  JOIN f x ON x.lang = o.lang AND x.phrase = array_to_string(o.w[1:o.k], ' ')
  JOIN f y ON y.lang = o.lang AND y.phrase = array_to_string(o.w[o.k + 1:], ' ')),
b AS (SELECT * FROM k QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
r AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank
  FROM b)
SELECT lang, rank::bigint AS rank, phrase, a::bigint AS a, l::bigint AS l, r::bigint AS r,
  n::bigint AS n, score::bigint AS score
FROM r JOIN t USING (lang) WHERE rank <= {KEPT}"""
}
