"""Near-duplicate documents by MinHash: many universal hash minima, banding, verified links.

1. Documents with equal shingle sets are one class. A class has ``ROWS * BANDS`` minima, each under a
   multiply-add hash of its own, and a key for every band of ``ROWS`` of them. Two sets of similarity
   0.8 miss every band with a chance of (1 - 0.8^ROWS)^BANDS, below 1e-9.
2. First pass: classes of a bucket (equal band keys) meet its smallest class, the hub. The signatures, a
   byte of every minimum, drop pairs that agree too seldom; the rest is confirmed on the full sets.
3. Second pass: any two classes of a bucket share its hub. Where the classes around a hub are still in
   several components, they meet in square tiles with their sets: signatures are compared in blocks,
   what agrees is confirmed in the task, and only links that join two components come out, fewer than
   the tile has rows. The largest component of a hub meets the others, but not itself.
4. Components by alternating large-star and small-star.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .connected import components
from .shared import documents, mix, slices, span_hashes, spread, written

SHINGLE = 2
PERCENT = 80
ROWS = 4
BANDS = 40
# Equal minima of two signatures, at least: a pair of similarity 0.8 has 128 of 160 on average, and
# fewer than 90 with a chance below 1e-10.
AGREEING = 90
# Classes and shingles of a tile's side: a task compares two sides at a time.
TILE = 2048
TILE_SHINGLES = 1 << 21
# Elements of a block of hash values, of which a task holds a few at a time.
BLOCK = 1 << 19

_rng = np.random.default_rng(20)
FACTORS = _rng.integers(0, 1 << 63, ROWS * BANDS, np.uint64) * np.uint64(2) + np.uint64(1)
OFFSETS = _rng.integers(0, 1 << 63, ROWS * BANDS, np.uint64) * np.uint64(2)


def sets_of(words, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of a slice's texts, ordered by text and hash, and where texts begin."""
    grams, text = words.runs(width)
    at = np.arange(len(grams))
    at = at[text[at] == text[at + width - 1]] if len(grams) else at
    short = np.flatnonzero((words.counts > 0) & (words.counts < width))
    whole = span_hashes(words.hashes, words.first[short], words.first[short + 1])
    values, owner = np.append(grams[at], whole), np.append(text[at], short)
    order = np.lexsort((values, owner))
    values, owner = values[order], owner[order]
    new = np.ones(len(values), bool)
    new[1:] = (values[1:] != values[:-1]) | (owner[1:] != owner[:-1])
    values, owner = values[new], owner[new]
    return values, np.searchsorted(owner, np.arange(len(words.counts) + 1))


def minima(values: np.ndarray, borders: np.ndarray) -> np.ndarray:
    """A row of ``ROWS * BANDS`` minima for every set that is not empty."""
    full = np.flatnonzero(np.diff(borders))
    starts = borders[full]
    out = np.empty((len(full), len(FACTORS)), np.uint64)
    # In blocks of values, so that the products stay in the processor's cache.
    low = 0
    while low < len(full):
        high = int(np.searchsorted(starts, starts[low] + BLOCK // 16, "right"))
        high = max(low + 1, high)
        end = starts[high] if high < len(full) else len(values)
        some, first = values[starts[low] : end], starts[low:high] - starts[low]
        for k, (factor, offset) in enumerate(zip(FACTORS, OFFSETS, strict=True)):
            out[low:high, k] = np.minimum.reduceat(some * factor + offset, first)
        low = high
    return out


def digests(values: np.ndarray, borders: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two independent 64-bit sums over every set: equal sets, and only those, agree in both."""
    found = []
    for salt in (0x51ED270B, 0x2545F491):
        sums = np.append(np.uint64(0), np.cumsum(mix(values ^ np.uint64(salt))))
        found.append(mix(sums[borders[1:]] - sums[borders[:-1]] + np.uint64(salt)))
    return found[0], found[1]


def _class_of(first: np.ndarray, second: np.ndarray, size: np.ndarray) -> pa.Array:
    """16 bytes for every set, null for empty ones."""
    both = np.stack([first, second], axis=1).tobytes()
    names = [both[16 * i : 16 * i + 16] if n else None for i, n in enumerate(size.tolist())]
    return pa.array(names, pa.binary())


SIGNED = "doc_id long, row_key long, size long, class binary, head binary, bands array<long>"


def _sign(width: int):
    """Per document its class; minima only for the first of equal sets in a slice."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, words in slices(batch, lower=True):
                values, borders = sets_of(words, width)
                size = np.diff(borders)
                table = minima(values, borders)
                keys = table.reshape(len(table), BANDS, ROWS)
                band = np.zeros((len(table), BANDS), np.uint64)
                for r in range(ROWS):
                    band = mix(band + keys[:, :, r])
                # The top byte of a minimum is nearly constant for a large set: a mixed one is not.
                heads = (mix(table) >> np.uint64(56)).astype(np.uint8)
                names = _class_of(*digests(values, borders), size)
                full = size > 0
                where = np.cumsum(full) - 1
                signature = [
                    heads[where[i]].tobytes() if full[i] else None for i in range(len(size))
                ]
                offsets = np.append(0, np.cumsum(full) * BANDS).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(rows.start, rows.stop - rows.start),
                        batch.column("row_key").slice(rows.start, rows.stop - rows.start),
                        pa.array(size.astype(np.int64)),
                        names,
                        pa.array(signature, pa.binary()),
                        pa.ListArray.from_arrays(
                            pa.array(offsets), pa.array(band.ravel().view(np.int64))
                        ),
                    ],
                    ["doc_id", "row_key", "size", "class", "head", "bands"],
                )

    return run


def agreement(one: np.ndarray, two: np.ndarray) -> np.ndarray:
    """Equal bytes of every row of ``one`` with every row of ``two``, in blocks."""
    out = np.empty((len(one), len(two)), np.int16)
    step = max(1, BLOCK // max(1, two.size))
    for low in range(0, len(one), step):
        block = one[low : low + step, None, :] == two[None, :, :]
        out[low : low + step] = np.count_nonzero(block, axis=2)
    return out


def _signatures(column: pa.ChunkedArray) -> np.ndarray:
    rows = column.to_pylist()
    return np.frombuffer(b"".join(rows), np.uint8).reshape(len(rows), ROWS * BANDS)


def _agree(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs whose signatures agree often enough."""
    for batch in batches:
        if not len(batch):
            continue
        same = _signatures(batch.column("head_a")) == _signatures(batch.column("head_b"))
        keep = np.count_nonzero(same, axis=1) >= AGREEING
        yield batch.select(["a", "b"]).filter(pa.array(keep))


def _joining(percent: int):
    """Links between the two sides of a hub's tile that join components, confirmed on full sets."""

    def run(key: tuple, table: pa.Table) -> pa.Table:
        names = table["class"].to_pylist()
        heads = _signatures(table["head"])
        lists = table["shingles"].combine_chunks()
        size = pc.list_value_length(lists).to_numpy()
        begin = np.append(0, np.cumsum(size))
        _, code = np.unique(lists.flatten().to_numpy(), return_inverse=True)
        marked = np.zeros(int(code.max()) + 1, bool)
        parent = table["root"].combine_chunks().dictionary_encode().indices.to_pylist()
        group = list(range(max(parent) + 1))

        def top(i: int) -> int:
            at = parent[i]
            while group[at] != at:
                group[at] = group[group[at]]
                at = group[at]
            return at

        left = np.flatnonzero(table["left"].to_numpy())
        right = np.flatnonzero(table["right"].to_numpy())
        close = agreement(heads[left], heads[right]) >= AGREEING
        found = []
        for i, near in zip(left.tolist(), close, strict=True):
            mine = top(i)
            others = np.array([j for j in right[near].tolist() if top(j) != mine], np.int64)
            if not len(others):
                continue
            own = code[begin[i] : begin[i + 1]]
            marked[own] = True
            at = np.repeat(begin[others], size[others]) + spread(size[others])
            both = np.add.reduceat(marked[code[at]], np.cumsum(size[others]) - size[others], dtype=np.int64)
            marked[own] = False
            alike = 100 * both >= percent * (size[i] + size[others] - both)
            for j in others[alike].tolist():
                one, two = top(i), top(j)
                if one != two:
                    group[max(one, two)] = min(one, two)
                    found.append((names[i], names[j]))
        a, b = zip(*found, strict=True) if found else ((), ())
        return pa.table([pa.array(a, pa.binary()), pa.array(b, pa.binary())], names=["a", "b"])

    return run


def _tiles_of() -> Column:
    """The tiles that a row around a mixed hub goes to, and on which side of each it stands.

    Kind 0 compares the smaller components of a hub with each other, kind 1 with the largest.
    """

    def tile(kind: int, row: Column, column: Column, left: Column, right: Column) -> Column:
        parts = {"kind": F.lit(kind), "row": row, "column": column, "left": left, "right": right}
        return F.struct(*[c.alias(name) for name, c in parts.items()])

    def each(sides: str, make) -> Column:
        return F.transform(F.sequence(F.lit(0), F.col(sides) - 1), make)

    yes, no = F.lit(True), F.lit(False)
    side = F.pmod(F.hash("class"), F.col("sides"))
    top_side = F.pmod(F.hash("class"), F.col("top_sides"))
    small = F.concat(
        each("sides", lambda o: tile(0, F.least(side, o), F.greatest(side, o), side <= o, side >= o)),
        each("top_sides", lambda t: tile(1, t, side, no, yes)),
    )
    large = each("sides", lambda o: tile(1, top_side, o, yes, no))
    return F.when(F.col("root") == F.col("top"), large).otherwise(small)


def _sets(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, words in slices(batch, lower=True):
                values, borders = sets_of(words, width)
                yield pa.RecordBatch.from_arrays(
                    [
                        _class_of(*digests(values, borders), np.diff(borders)),
                        pa.ListArray.from_arrays(
                            pa.array(borders.astype(np.int32)), pa.array(values.view(np.int64))
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


def full_sets(names: DataFrame, classes: DataFrame, source: DataFrame, width: int) -> DataFrame:
    """(class, shingles) of every class in ``names``: one text of each becomes a set again."""
    texts = names.join(classes, "class").select(
        F.col("row.doc_id").alias("d"), F.col("row.row_key").alias("k")
    )
    same = source.doc_id.eqNullSafe(texts.d) & (source.row_key == texts.k)
    return written(
        source.join(texts, same, "left_semi")
        .select("text")
        .mapInArrow(_sets(width), "class binary, shingles array<long>"),
        "minhash-sets",
    ).dropDuplicates(["class"])  # rows that repeat a doc_id and its text


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) of classes whose full sets are similar enough."""
    left = sets.select(F.col("class").alias("a"), F.col("shingles").alias("set_a"))
    right = sets.select(F.col("class").alias("b"), F.col("shingles").alias("set_b"))
    return (
        pairs.join(left, "a").join(right, "b")
        .select("a", "b", "set_a", "set_b")
        .mapInArrow(_similar(percent), "a binary, b binary")
    )


def row_hash() -> Column:
    """Tells rows of one doc_id apart that hold different texts."""
    return F.xxhash64(F.coalesce("text", F.lit("")))


def near_duplicates(docs: DataFrame, width: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """Per document: doc_id, n_shingles, component_id (smallest doc_id reachable by links), kept
    (doc_id = component_id).

    A set holds the distinct ``width``-word shingles of the text with A-Z in lower case; a text of
    fewer words is one shingle, a null text or one without words has none and stands alone. Two
    documents link where 100 * intersection >= percent * union. Rows that repeat a doc_id come out
    once each. A null doc_id links like any other, is never the smallest, and is kept where its
    component has no other. Shingles are compared as 64-bit hashes, equal sets as 128-bit digests.
    Other columns are ignored; an empty table gives no rows. ``percent`` must not be below the 80
    that the bands are laid out for.
    """
    if percent < PERCENT:
        raise ValueError(f"the bands find pairs of {PERCENT} percent and more")
    source = docs.select("doc_id", row_hash().alias("row_key"), "text")
    signed = written(source.mapInArrow(_sign(width), SIGNED), "minhash-signed")
    row = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "row_key")
    # Equal sets have equal minima: any row speaks for its class.
    members = written(
        signed.where("size > 0")
        .groupBy("class")
        .agg(
            F.min("doc_id").alias("lead"),
            F.min(row).alias("row"),
            F.first("head").alias("head"),
            F.first("bands").alias("bands"),
            F.first("size").alias("size"),
        ),
        "minhash-classes",
    )
    classes = members.select("class", "lead", "row")
    heads = members.select("class", "head")

    # Buckets of several classes, each with its smallest one.
    entries = members.select("class", F.posexplode("bands").alias("band", "key"))
    hubs = (
        entries.groupBy("band", "key")
        .agg(F.min("class").alias("hub"), F.max("class").alias("other"))
        .where("hub <> other")
        .drop("other")
    )
    proposals = written(
        entries.join(hubs, ["band", "key"])
        .where("class <> hub")
        .select(F.col("hub").alias("a"), F.col("class").alias("b"))
        .distinct(),
        "minhash-proposals",
    )

    first = written(
        proposals.join(heads.toDF("a", "head_a"), "a")
        .join(heads.toDF("b", "head_b"), "b")
        .mapInArrow(_agree, "a binary, b binary"),
        "minhash-pairs",
    )
    involved = first.select(F.explode(F.array("a", "b")).alias("class")).distinct()
    sets = full_sets(involved, classes, source, width)
    links = written(confirmed(first, sets, percent), "minhash-links")
    labels = components(links)

    # Second pass: around every hub with several components.
    around = proposals.select(F.col("a").alias("hub"), F.col("b").alias("class"))
    rooted = written(
        around.join(labels.withColumnRenamed("node", "class"), "class", "left")
        .select("class", "hub", F.coalesce("root", "class").alias("root"))
        .join(members.select("class", "size"), "class"),
        "minhash-around",
    )
    mixed = (
        rooted.groupBy("hub", "root")
        .agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("tokens"))
        .groupBy("hub")
        .agg(
            F.max(F.struct("n", "root", "tokens")).alias("top"),
            F.sum("n").alias("n"),
            F.sum("tokens").alias("tokens"),
        )
        .where("n > top.n")
    )

    def sides(n: Column, tokens: Column) -> Column:
        return F.ceil(F.greatest(n / TILE, tokens / TILE_SHINGLES)).cast("int")

    mixed = mixed.select(
        "hub",
        F.col("top.root").alias("top"),
        sides(F.col("top.n"), F.col("top.tokens")).alias("top_sides"),
        sides(F.col("n") - F.col("top.n"), F.col("tokens") - F.col("top.tokens")).alias("sides"),
    )
    open_rows = written(rooted.join(mixed, "hub"), "minhash-open")
    open_sets = full_sets(open_rows.select("class").distinct(), classes, source, width)
    dealt = (
        open_rows.join(heads, "class")
        .join(open_sets, "class")
        .select("hub", "class", "root", "head", "shingles", F.explode(_tiles_of()).alias("tile"))
        .select("hub", "class", "root", "head", "shingles", "tile.*")
    )
    more = dealt.groupBy("hub", "kind", "row", "column").applyInArrow(_joining(percent), "a binary, b binary")
    linked = written(components(links.unionByName(more)), "minhash-components")

    lead = (
        linked.join(classes.withColumnRenamed("class", "node"), "node")
        .groupBy("root")
        .agg(F.min("lead").alias("component"))
    )
    by_class = (
        classes.join(linked.withColumnRenamed("node", "class"), "class", "left")
        .join(lead, "root", "left")
        .select("class", F.coalesce("component", "lead").alias("component"))
    )
    return (
        signed.select("doc_id", "size", "class")
        .join(by_class, "class", "left")
        .select(
            "doc_id",
            F.col("size").alias("n_shingles"),
            F.coalesce("component", "doc_id").alias("component_id"),
        )
        .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
    )


def op13_minhash(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(documents(spark, sf_dir))


QUERIES = {"op13_minhash": op13_minhash}
ORACLES: dict[str, str] = {}
