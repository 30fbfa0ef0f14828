"""Benchmark decontamination as a prefix-filtered set join over item-sized windows.

An item is cut into windows of ``window`` words (a shorter item is one window). A window is
contained in a document only if all its words are, so the necessary prefix is one word: the rarest
over all documents. Document positions of that word are the only candidates; length and position
say whether the whole window can lie there, and the words themselves decide.

The item side is broadcast in blocks of at most ``block`` windows, counted beforehand, so its size
is bounded however large the benchmark is; every block meets all documents.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import row_key, written

WINDOW = 10
BLOCK_WINDOWS = 200_000
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# Every ASCII character but digits and small letters parts words.
_GAP = "".join(map(chr, [*range(0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)]))
_GAP_PATTERN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def item_words(text: str = "text"):
    """Words of a text as an array; none for a null text."""
    lowered = F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)
    bare = F.trim(lowered, F.lit(_GAP))
    return F.when(bare == "", F.array().cast("array<string>")).otherwise(
        F.split(bare, _GAP_PATTERN)
    )


def item_windows(items: DataFrame, window: int) -> DataFrame:
    """(item_id, words) for every window of every item."""
    cut = items.select("item_id", item_words().alias("w")).where(F.size("w") > 0)
    last = F.greatest(F.size("w") - (window - 1), F.lit(1))
    return cut.select(
        "item_id", "w", F.explode(F.sequence(F.lit(1), last)).alias("at")
    ).select("item_id", F.slice("w", F.col("at"), F.lit(window)).alias("window"))


def _occurrences(words: DataFrame, windows: DataFrame) -> DataFrame:
    """(doc_id, row_key, start, window) for the places where a window lies in a document."""
    placed = windows.select("window", F.posexplode("window").alias("offset", "word"))
    vocabulary = placed.select("word").distinct()
    seen = words.select(F.explode("words").alias("word"))
    rarity = (
        seen.join(F.broadcast(vocabulary), "word").groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    )
    # Windows with a word that no document has keep the null, which sorts first and joins nothing.
    anchors = (
        placed.join(rarity, "word", "left")
        .groupBy("window")
        .agg(F.min(F.struct("n", "word", "offset")).alias("first"))
        .select(
            "window", F.col("first.word").alias("word"), F.col("first.offset").alias("offset")
        )
    )
    length = F.size("window")
    start = F.col("at") - F.col("offset")
    return (
        words.select("doc_id", "row_key", "words", F.posexplode("words").alias("at", "word"))
        .join(F.broadcast(anchors), "word")
        .where((start >= 0) & (start + length <= F.size("words")))
        .where(F.slice("words", start + 1, length) == F.col("window"))
        .select("doc_id", "row_key", start.alias("start"), "window")
    )


def find_leaks(
    docs: DataFrame, items: DataFrame, window: int = WINDOW, block: int = BLOCK_WINDOWS
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Words of every document, windows of every item, and places where a window occurs."""
    # Read for the rarity of words, for their places and for their number: cut into words once.
    words = written(
        docs.select("doc_id", row_key().alias("row_key"), item_words().alias("words")), "words"
    )
    by_item = written(item_windows(items, window).distinct(), "windows")
    distinct = by_item.select("window").distinct()
    blocks = max(1, -(-distinct.count() // block))
    numbered = distinct.withColumn("block", F.pmod(F.xxhash64("window"), F.lit(blocks)))
    parts = [
        _occurrences(words, numbered.where(F.col("block") == b).select("window"))
        for b in range(blocks)
    ]
    return words, by_item, written(reduce(DataFrame.unionByName, parts), "occurrences")


def mark_leaks(
    docs: DataFrame, items: DataFrame, window: int = WINDOW, block: int = BLOCK_WINDOWS
) -> DataFrame:
    """Per document: doc_id, row_key, n_words, n_hit, n_items, items, contaminated.

    ``n_hit`` counts the words inside any occurrence, ``items`` lists the items (as strings, sorted)
    that have one. A null text or item has no words; documents without a hit have an empty list. Rows
    that repeat a doc_id come out once each; an item listed twice counts once; empty tables give
    empty or clean results. Other columns are ignored.
    """
    words, by_item, found = find_leaks(docs, items, window, block)
    key = ["doc_id", "row_key"]
    hit = (
        found.select(*key, "start", F.size("window").alias("length")).distinct()
        .select(*key, F.explode(F.sequence("start", F.expr("start + length - 1"))).alias("at"))
        .distinct()
        .groupBy(*key)
        .agg(F.count(F.lit(1)).alias("n_hit"))
    )
    which = (
        found.select(*key, "window").distinct()
        .join(by_item, "window")
        .select(*key, F.col("item_id").cast("string").alias("item"))
        .distinct()
        .groupBy(*key)
        .agg(F.array_sort(F.collect_list("item")).alias("items"))
    )
    # Hits keep one row per key; a null doc_id must find its own again, hence the null-safe join.
    marks = hit.join(which, (hit.doc_id.eqNullSafe(which.doc_id)) & (hit.row_key == which.row_key)).select(
        hit.doc_id.alias("d"), hit.row_key.alias("k"), "n_hit", "items"
    )
    sized = words.select(*key, F.size("words").cast("long").alias("n_words"))
    none = F.array().cast("array<string>")
    return sized.join(
        marks, sized.doc_id.eqNullSafe(F.col("d")) & (sized.row_key == F.col("k")), "left"
    ).select(
        *key,
        "n_words",
        F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.size(F.coalesce("items", none)).cast("long").alias("n_items"),
        F.coalesce("items", none).alias("items"),
        F.coalesce(F.col("n_hit") > 0, F.lit(False)).alias("contaminated"),
    )


def drop_leaks(docs: DataFrame, items: DataFrame, window: int = WINDOW) -> DataFrame:
    """``docs`` without the documents in which a window of an item occurs."""
    _, _, found = find_leaks(docs, items, window)
    leaks = found.select(F.col("doc_id").alias("_d"), F.col("row_key").alias("_k")).distinct()
    same = docs.doc_id.eqNullSafe(leaks._d) & (row_key() == leaks._k)
    return docs.join(leaks, same, "left_anti")


def op6_decontamination(spark, sf_dir: str) -> DataFrame:
    from .shared import documents

    found = mark_leaks(documents(spark, sf_dir), documents(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        "n_items",
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        "contaminated",
    )


_SQL_WORDS = f"""list_filter(regexp_split_to_array(
    translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'),
    lambda x: x <> '')"""

ORACLES = {
    "op6_decontamination": f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_SQL_WORDS} AS w FROM documents),
i AS (SELECT item_id, {_SQL_WORDS} AS w FROM benchmark),
iw AS (
  SELECT DISTINCT item_id, least(len(w), {WINDOW}) AS n,
    array_to_string(w[pos : pos + least(len(w), {WINDOW}) - 1], ' ') AS s
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - {WINDOW - 1}, 1) + 1)) AS pos
        FROM i WHERE len(w) > 0)),
dw AS (
  SELECT r, pos, n, array_to_string(w[pos : pos + n - 1], ' ') AS s
  FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS pos
        FROM d, (SELECT DISTINCT n FROM iw) WHERE len(w) >= n)),
f AS (SELECT r, pos, n, item_id FROM dw JOIN iw USING (n, s)),
h AS (SELECT r, count(DISTINCT p) AS n_hit
      FROM (SELECT r, unnest(range(pos, pos + n)) AS p FROM f) GROUP BY r),
k AS (SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
      FROM (SELECT DISTINCT r, item_id::varchar AS item FROM f) GROUP BY r)
SELECT doc_id, len(w)::bigint AS n_words, coalesce(n_hit, 0)::bigint AS n_hit,
  coalesce(n_items, 0)::bigint AS n_items, sha256(coalesce(items, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN h USING (r) LEFT JOIN k USING (r)"""
}
QUERIES = {"op6_decontamination": op6_decontamination}
