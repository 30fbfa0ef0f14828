"""Exact Jaccard join of documents on word shingles, by adaptive multi-match prefixes.

Shingles are ordered by (estimated frequency, hash), the same for every document. Two sets with
similarity t share at least l shingles among the first n - ceil(t n) + l of each, for every l; a
document whose prefix is costly (its shingles are frequent, so its candidates many) takes a larger
l: a longer prefix, but l matches asked for before anything is verified.

1. Frequencies are counted over all documents in 2 ** 22 cells; a task reports the cells that it
   saw often enough. They fix an order only, so their error costs candidates, never links.
2. Documents with equal sets are one class from here on (class id: a digest of the set).
3. Prefix shingles meet by value; those of a single class are dropped in passing.
4. First pass: every class is verified against the most central class of each of its prefix
   shingles. This links groups of near copies without a pair for each two of them.
5. Second pass: candidates that are still in different components go through the length,
   positional and multi-match filters, and what remains is verified. Where many components share a
   shingle, pairs must also agree in a sketch: a bit for each of 512 parts of the hashes says whether a
   set has an odd number of shingles there, and sets differ in as many shingles as in bits, at least.
   Together the passes decide every pair that could join two components, so the components are exact.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .connected import components
from .shared import mix, row_key, slices, span_hashes, spread, written

SHINGLE = 5
PERCENT = 80
CELLS = 1 << 22
# A task reports a cell once it has seen it in this many documents.
REPORTED = 4
# Estimated candidates that a document may have before it asks for one more match.
CHEAP = 64
MOST_MATCHES = 4
# 64-bit columns of a sketch, and the components that a shingle has before its classes need theirs.
SKETCH = tuple(f"sketch{i}" for i in range(8))
CROWDED = 4


def shingles(words, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of a slice's texts with the text of each, sorted by both."""
    grams, text = words.runs(width)
    at = np.arange(len(grams))
    at = at[text[at] == text[at + width - 1]] if len(grams) else at
    short = np.flatnonzero((words.counts > 0) & (words.counts < width))
    whole = span_hashes(words.hashes, words.first[short], words.first[short + 1])
    values = np.append(grams[at], whole)
    owner = np.append(text[at], short)
    order = np.lexsort((values, owner))
    values, owner = values[order], owner[order]
    new = np.ones(len(values), bool)
    new[1:] = (values[1:] != values[:-1]) | (owner[1:] != owner[:-1])
    return values[new], owner[new]


def _cell(values: np.ndarray) -> np.ndarray:
    return (values >> np.uint64(40)).astype(np.int64) & (CELLS - 1)


def _count(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(CELLS, np.int32)
        for batch in batches:
            for _, words in slices(batch, lower=True):
                values, _ = shingles(words, width)
                np.add.at(seen, _cell(values), 1)
        often = np.flatnonzero(seen >= REPORTED)
        yield pa.RecordBatch.from_arrays(
            [pa.array(often.astype(np.int32)), pa.array(seen[often].astype(np.int64))],
            ["cell", "n"],
        )

    return run


def frequency_order(docs: DataFrame, width: int):
    """A byte for each cell: the logarithm of its count (0: rare). At most CELLS rows arrive."""
    rows = (
        docs.select("text")
        .mapInArrow(_count(width), "cell int, n long")
        .groupBy("cell")
        .agg(F.sum("n").alias("n"))
        .select("cell", F.ceil(F.log2("n") * 2).cast("int").alias("level"))
        .toArrow()
    )
    levels = np.zeros(CELLS, np.uint8)
    levels[rows["cell"].to_numpy()] = np.minimum(rows["level"].to_numpy(), 63)
    return docs.sparkSession.sparkContext.broadcast(levels)


def ordered(words, width: int, levels: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Shingles as ordered numbers (level, hash), the text of each, and how many a text has."""
    values, owner = shingles(words, width)
    level = levels[_cell(values)].astype(np.uint64)
    values = (level << np.uint64(57)) | (values >> np.uint64(7))
    order = np.lexsort((values, owner))
    return values[order], owner[order], np.bincount(owner, minlength=len(words.counts))


def class_ids(values: np.ndarray, size: np.ndarray) -> np.ndarray:
    """A 64-bit digest of every set (0 for none), independent of order."""
    sums = np.append(np.uint64(0), np.cumsum(mix(values ^ np.uint64(0x51ED27))))
    borders = np.append(0, np.cumsum(size))
    total = sums[borders[1:]] - sums[borders[:-1]]
    return np.where(size > 0, mix(total + size.astype(np.uint64)) | np.uint64(1), np.uint64(0))


def sketches(values: np.ndarray, owner: np.ndarray, texts: int) -> np.ndarray:
    """(texts, 64-bit columns): a bit is set where an odd number of the text's shingles fall in its part."""
    bits = 64 * len(SKETCH)
    part = (values & np.uint64(bits - 1)).astype(np.int64)
    odd = np.bincount(owner * bits + part, minlength=texts * bits).astype(np.uint8) & 1
    return np.packbits(odd.reshape(texts, bits), axis=1, bitorder="little").view("<i8")


def needed(size, percent: int):
    """Shingles that a set shares with any similar one, at least."""
    return -(-size * percent // 100)


def _prefixes(width: int, percent: int, levels):
    names = ["doc_id", "row_key", "size", "class", "matches", "tokens", *SKETCH]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = levels.value
        for batch in batches:
            ids, keys = batch.column("doc_id"), batch.column("row_key")
            for rows, words in slices(batch, lower=True):
                values, owner, size = ordered(words, width, table)
                first = np.cumsum(size) - size
                base = size - needed(size, percent) + (size > 0)
                # Candidates that a prefix is expected to bring: the frequencies of its shingles.
                inside = spread(size) < base[owner]
                half_log = (values >> np.uint64(57)).astype(np.float64)
                cost = np.where(half_log > 0, 2 ** (half_log / 2), 0)
                cost = np.bincount(owner[inside], cost[inside], minlength=len(size))
                matches = 1 + np.floor(np.log2(np.maximum(cost / CHEAP, 1))).astype(np.int64)
                matches = np.minimum(matches, np.minimum(MOST_MATCHES, np.maximum(size, 1)))
                length = np.minimum(base + matches - 1, size)
                take = np.repeat(first, length) + spread(length)
                odd = sketches(values, owner, len(size))
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.slice(rows.start, rows.stop - rows.start),
                        keys.slice(rows.start, rows.stop - rows.start),
                        pa.array(size.astype(np.int32)),
                        pa.array(class_ids(values, size).view(np.int64)),
                        pa.array(matches.astype(np.int32)),
                        pa.ListArray.from_arrays(
                            pa.array(np.append(0, np.cumsum(length)).astype(np.int32)),
                            pa.array(values[take].view(np.int64)),
                        ),
                        *[pa.array(np.ascontiguousarray(column)) for column in odd.T],
                    ],
                    names,
                )

    return run


def _drop_lone(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Postings sorted by (token, class): repeats go, and so do tokens of a single class."""
    held: pa.RecordBatch | None = None
    met = False  # whether the held row's token has come up with another class before it
    for batch in batches:
        if held is not None:
            batch = pa.concat_batches([held, batch])
        if not len(batch):
            continue
        token = batch.column("token").to_numpy()
        owner = batch.column("class").to_numpy()
        new = np.ones(len(token), bool)
        new[1:] = (token[1:] != token[:-1]) | (owner[1:] != owner[:-1])
        batch, token = batch.filter(pa.array(new)), token[new]
        same = token[1:] == token[:-1]
        keep = np.append(same, False)
        keep[1:] |= same
        keep[0] |= met
        met = bool(keep[-1])
        held = batch.slice(len(batch) - 1)
        keep[-1] = False
        yield batch.filter(pa.array(keep))
    if met:
        yield held


def _sets(width: int, levels):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = levels.value
        for batch in batches:
            for _, words in slices(batch, lower=True):
                values, _, size = ordered(words, width, table)
                borders = np.append(0, np.cumsum(size)).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(class_ids(values, size).view(np.int64)),
                        pa.ListArray.from_arrays(
                            pa.array(borders), pa.array(values.view(np.int64))
                        ),
                    ],
                    ["class", "shingles"],
                )

    return run


def _similar(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for a, b in zip(batch.column("set_a"), batch.column("set_b"), strict=True):
                x, y = a.values.to_numpy(), b.values.to_numpy()
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * both >= percent * (len(x) + len(y) - both))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return run


def _required(n: Column, m: Column, percent: int) -> Column:
    """Least intersection of two sets of these sizes that are similar."""
    return F.ceil(percent * (n + m) / F.lit(100 + percent))


def _possible(size_a: str, place_a: str, size_b: str, place_b: str, percent: int) -> Column:
    """Whether sets that share the shingles at these places can be similar.

    They have at most as many in common before the shingle as the smaller place says, and after it
    as the smaller rest. Where the rest is too short the sizes are too far apart as well.
    """
    n, i, m, j = (F.col(c) for c in (size_a, place_a, size_b, place_b))
    return F.least(i, j) + F.least(n - i, m - j) >= _required(n, m, percent)


def _enough(percent: int) -> Column:
    """Whether two sets (n, m) with ``shared`` common prefix shingles can be similar.

    One of the two prefixes ends first, and all of its common shingles have been counted then; the
    rest of that set is all that can be common besides. So for what follows the last common one.
    """
    n, m = F.col("n"), F.col("m")

    def beyond(size: Column, matches: str) -> Column:
        return F.ceil(size * percent / F.lit(100)) - F.col(matches)

    after = F.greatest(beyond(n, "matches_n"), beyond(m, "matches_m"), F.lit(0))
    last = F.least(n - F.col("last_n"), m - F.col("last_m")) - 1
    common = F.col("shared")
    needed_both = _required(n, m, percent)
    return (
        (common >= F.least("matches_n", "matches_m", needed_both))
        & (common + after >= needed_both)
        & (common + last >= needed_both)
    )


def verified(
    pairs: DataFrame, classes: DataFrame, source: DataFrame, width: int, percent: int, levels
) -> DataFrame:
    """The pairs (a, b) of classes whose sets are similar enough.

    Only one text of every class in ``pairs`` is turned into a set again.
    """
    involved = pairs.select(F.explode(F.array("a", "b")).alias("class")).distinct()
    texts = involved.join(classes, "class").select(
        F.col("row.doc_id").alias("d"), F.col("row.row_key").alias("k")
    )
    same = source.doc_id.eqNullSafe(texts.d) & (source.row_key == texts.k)
    sets = written(
        source.join(texts, same, "left_semi")
        .select("text")
        .mapInArrow(_sets(width, levels), "class long, shingles array<long>"),
        "sets",
    )
    left = sets.select(F.col("class").alias("a"), F.col("shingles").alias("set_a"))
    right = sets.select(F.col("class").alias("b"), F.col("shingles").alias("set_b"))
    return (
        pairs.join(left, "a").join(right, "b")
        .select("a", "b", "set_a", "set_b")
        .mapInArrow(_similar(percent), "a long, b long")
    )


def _alike(percent: int) -> Column:
    """Whether sets with these sketches can be similar: all bits in which they differ stand for shingles
    that only one of them has."""
    differ = sum(
        (F.bit_count(F.col(f"{s}_a").bitwiseXOR(F.col(f"{s}_b"))) for s in SKETCH), F.lit(0)
    )
    n, m = F.col("size_a"), F.col("size_b")
    return differ <= n + m - 2 * _required(n, m, percent)


def meetings(placed: DataFrame, sketched: DataFrame, percent: int) -> DataFrame:
    """Pairs of classes (_a, _b) of different components, a row for each prefix shingle they share.

    The largest component of a shingle is not paired in itself. Pairs that cannot be similar are left
    out by their places and, where a shingle has many components, by their sketches (``sketched``).
    """
    per_root = placed.groupBy("token", "root").agg(F.count(F.lit(1)).alias("n"))
    top = per_root.groupBy("token").agg(
        F.max(F.struct("n", "root")).alias("top"), F.count(F.lit(1)).alias("roots")
    ).where("roots > 1").select("token", "roots", F.col("top.root").alias("top"))
    several = placed.join(top, "token")
    side = ["class", "size", "matches", "place", "root"]

    def met(rows: DataFrame, also: tuple[str, ...], condition: Column) -> DataFrame:
        one = rows.where("root <> top").select(
            "token", "top", *[F.col(c).alias(f"{c}_a") for c in [*side, *also]]
        )
        two = rows.select("token", *[F.col(c).alias(f"{c}_b") for c in [*side, *also]])
        return one.join(
            two,
            (one.token == two.token)
            & (F.col("root_a") != F.col("root_b"))
            & ((F.col("root_b") == F.col("top")) | (F.col("class_a") < F.col("class_b")))
            & _possible("size_a", "place_a", "size_b", "place_b", percent)
            & condition,
        ).select(*[f"{c}_{x}" for x in "ab" for c in side])

    crowded = several.where(F.col("roots") > CROWDED).join(sketched, "class")
    few = several.where(F.col("roots") <= CROWDED)
    return met(few, (), F.lit(True)).unionByName(met(crowded, SKETCH, _alike(percent)))


def join_similar(docs: DataFrame, width: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """Per document: doc_id, row_key, n_shingles, component_id (smallest doc_id reachable by links),
    group (the same for linked rows, null without words).

    A set holds the distinct ``width``-word shingles of the text with A-Z in lower case; a text of
    fewer words is one shingle, a null text or one without words has none and stands alone. Two
    documents link where 100 * intersection >= percent * union. Rows that repeat a doc_id come out
    once each; a null doc_id links like any other and is never the smallest. Other columns are
    ignored. Sets are compared as 64-bit hashes of their shingles.
    """
    levels = frequency_order(docs, width)
    source = docs.select("doc_id", row_key().alias("row_key"), "text")
    scheme = ", ".join(
        ["doc_id long, row_key int, size int, class long, matches int, tokens array<long>"]
        + [f"{s} long" for s in SKETCH]
    )
    prefixed = written(source.mapInArrow(_prefixes(width, percent, levels), scheme), "prefixes")
    classes = prefixed.where("size > 0").groupBy("class").agg(
        F.min("doc_id").alias("lead"), F.min(F.struct("doc_id", "row_key")).alias("row")
    )

    sketched = prefixed.where("size > 0").groupBy("class").agg(*[F.first(s).alias(s) for s in SKETCH])

    posting = prefixed.select(
        "class", "size", "matches", F.posexplode("tokens").alias("place", "token")
    )
    order = ["token", "class"]
    shared = written(
        posting.repartition("token")
        .sortWithinPartitions(*order)
        .mapInArrow(_drop_lone, posting.schema),
        "postings",
    )

    # First pass. The most central class has the most company over its prefix.
    company = shared.groupBy("token").agg(F.count(F.lit(1)).alias("company"))
    central = (
        shared.join(company, "token")
        .groupBy("class")
        .agg(F.sum(F.log2("company")).alias("weight"))
    )
    weighed = shared.join(central, "class")
    hubs = weighed.groupBy("token").agg(
        F.max(F.struct("weight", "class", "size", "place", "matches")).alias("hub")
    )
    proposals = written(
        shared.join(hubs, "token")
        .where(F.col("class") != F.col("hub.class"))
        .where(_possible("size", "place", "hub.size", "hub.place", percent))
        .groupBy(F.col("class").alias("a"), F.col("hub.class").alias("b"))
        .agg(
            F.count(F.lit(1)).alias("shared"),
            F.first("size").alias("n"),
            F.first("hub.size").alias("m"),
            F.first("matches").alias("matches_n"),
            F.first("hub.matches").alias("matches_m"),
            F.max("place").alias("last_n"),
            F.max("hub.place").alias("last_m"),
        )
        # Shingles with another hub are not counted, so this may pass over links: the second pass
        # finds them.
        .where(_enough(percent))
        .select("a", "b"),
        "proposals",
    )
    links = written(verified(proposals, classes, source, width, percent, levels), "links")
    labels = components(links)

    # Second pass: only pairs across components; the largest one of a token is not paired in itself.
    placed = written(
        shared.join(labels.withColumnRenamed("node", "class"), "class", "left").select(
            *shared.columns, F.coalesce("root", "class").alias("root")
        ),
        "placed",
    )
    def pick(first: str, second: str) -> Column:
        return F.when(F.col("class_a") < F.col("class_b"), F.col(first)).otherwise(F.col(second))

    candidates = (
        meetings(placed, sketched, percent)
        .groupBy(
            F.least("class_a", "class_b").alias("a"), F.greatest("class_a", "class_b").alias("b")
        )
        .agg(
            F.count(F.lit(1)).alias("shared"),
            *[
                F.first(pick(f"{c}_a", f"{c}_b")).alias(out_a)
                for c, out_a in (("size", "n"), ("matches", "matches_n"))
            ],
            *[
                F.first(pick(f"{c}_b", f"{c}_a")).alias(out_b)
                for c, out_b in (("size", "m"), ("matches", "matches_m"))
            ],
            F.max(pick("place_a", "place_b")).alias("last_n"),
            F.max(pick("place_b", "place_a")).alias("last_m"),
        )
        .where(_enough(percent))
        .select("a", "b")
    )
    more = verified(
        written(candidates, "candidates"), classes, source, width, percent, levels
    )
    linked = components(links.unionByName(more))

    lead = linked.join(classes.withColumnRenamed("class", "node"), "node").groupBy("root").agg(
        F.min("lead").alias("component")
    )
    by_class = (
        classes.join(linked.withColumnRenamed("node", "class"), "class", "left")
        .join(lead, "root", "left")
        .select(
            "class",
            F.coalesce("component", "lead").alias("component"),
            F.coalesce("root", "class").alias("group"),
        )
    )
    return (
        prefixed.select("doc_id", "row_key", "size", "class")
        .join(by_class, "class", "left")
        .select(
            "doc_id",
            "row_key",
            F.col("size").cast("long").alias("n_shingles"),
            F.coalesce("component", "doc_id").alias("component_id"),
            "group",
        )
    )


def keep_one(docs: DataFrame, width: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """``docs`` with one document of every group of linked ones: that with the smallest doc_id.

    Rows without words stay; of a group that has no doc_id one row stays; of rows that repeat a kept doc_id with a linked text
    one stays.
    """
    found = join_similar(docs, width, percent)
    # Every row without words is a group by itself.
    itself = F.when(F.col("group").isNull(), F.struct("doc_id", "row_key"))
    first = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "row_key")
    keep = (
        found.groupBy("group", itself.alias("itself"))
        .agg(F.min(first).alias("row"))
        .select(F.col("row.doc_id").alias("d"), F.col("row.row_key").alias("k"))
    )
    keyed = docs.withColumn("_key", row_key())
    kept = keyed.join(keep, keyed.doc_id.eqNullSafe(keep.d) & (keyed._key == keep.k), "left_semi")
    # Rows equal in doc_id and text lie in one partition by now; those without words stay.
    copy = F.when(~F.coalesce("text", F.lit("")).rlike(r"[^\x20\x09-\x0D]"), F.expr("uuid()"))
    return kept.withColumn("_copy", copy).dropDuplicates(["doc_id", "_key", "_copy"]).drop("_key", "_copy")


def op9_ngram_jaccard(spark, sf_dir: str) -> DataFrame:
    from .shared import documents

    return join_similar(documents(spark, sf_dir)).drop("row_key", "group")


# Registered without SQL: a self-join on all shingles is too slow on whole tables. Tests hold the
# query against a comparison of all pairs on a small fixture.
QUERIES = {"op9_ngram_jaccard": op9_ngram_jaccard}
ORACLES: dict[str, str] = {}
