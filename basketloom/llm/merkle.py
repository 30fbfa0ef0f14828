"""Document fingerprints: a Merkle tree over leaves, paragraphs and sections.

A leaf is ``LEAF_WORDS`` words of a paragraph, a paragraph is a line, a section ends behind a
paragraph whose digest says so (every eighth, about), so an edit moves no border but its own. The
fingerprint is one string, ``root:tree``: the root tells equality, the tree lists the leaf digests
(leaves joined by ``,``, paragraphs by ``;``, sections by ``|``). Where two trees differ, so do the
branches above: ``differing_paragraphs`` follows them to the edits.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.running import with_balanced_blocks

from .shared import documents, row_key

LEAF_WORDS = 2
LEAF_DIGITS = 8
# Rows of one ordered block; blocks are what windows are partitioned by.
BLOCK_ROWS = 4000
MOST_BLOCKS = 1 << 20


def tree(text: Column) -> Column:
    """Leaf digests of a text in their paragraphs and sections."""
    groups = F.regexp_replace(text, f"((?:[^ \n]+ +){{{LEAF_WORDS}}})", "$1\x01")
    paragraphs = F.transform(
        F.split(groups, "\n", -1),
        lambda p: F.array_join(
            F.transform(
                F.split(p, "\x01", -1), lambda leaf: F.substring(F.md5(leaf), 1, LEAF_DIGITS)
            ),
            ",",
        ),
    )
    return F.regexp_replace(F.array_join(paragraphs, ";"), "([08]);", "$1|")


def root(nodes: Column) -> Column:
    """Digest of the sections' digests, each of its paragraphs' digests."""

    def joined(parts: Column) -> Column:
        return F.sha2(F.array_join(parts, ""), 256)

    return joined(
        F.transform(
            F.split(nodes, r"\|", -1),
            lambda s: joined(F.transform(F.split(s, ";", -1), lambda p: F.sha2(p, 256))),
        )
    )


def likeness(a: Column, b: Column) -> Column:
    """Shared share of the distinct leaves of two trees: 1 for equal ones, 0 for disjoint ones."""
    x = F.array_distinct(F.split(a, "[,;|]", -1))
    y = F.array_distinct(F.split(b, "[,;|]", -1))
    both = F.size(F.array_intersect(x, y))
    return both / (F.size(x) + F.size(y) - both)


def fingerprint(text: Column) -> Column:
    """``root:tree`` of a text; a null text counts as empty."""
    nodes = tree(F.coalesce(text, F.lit("")))
    return F.concat(root(nodes), F.lit(":"), nodes)


def differing_paragraphs(a: Column, b: Column) -> Column:
    """Numbers (from 0) of the paragraphs of fingerprint ``a`` that ``b`` does not have.

    Sections that ``b`` has as well are passed over whole; equal roots have no difference.
    """
    own, other = F.split_part(a, F.lit(":"), F.lit(2)), F.split_part(b, F.lit(":"), F.lit(2))
    sections = F.split(own, r"\|", -1)
    known = F.split(other, r"\|", -1)
    leaves = F.split(other, r"[;|]", -1)
    marked = F.flatten(
        F.transform(
            sections,
            lambda s: F.when(
                F.array_contains(known, s), F.transform(F.split(s, ";", -1), lambda p: F.lit(False))
            ).otherwise(F.transform(F.split(s, ";", -1), lambda p: ~F.array_contains(leaves, p))),
        )
    )
    places = F.transform(marked, lambda m, i: F.when(m, i))
    return F.when(F.substring_index(a, ":", 1) == F.substring_index(b, ":", 1), F.array().cast(
        "array<int>"
    )).otherwise(F.filter(places, lambda i: i.isNotNull()))


def with_next(docs: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """doc_id, row_key, text and the text of the next document in descending doc_id order.

    The last one is followed by the first. Rows are ordered in blocks of doc_id ranges; the last row
    of a block is copied to the next block that has rows, so texts move once. Rows that repeat a
    doc_id follow each other by the hash of their text; a null doc_id comes last.
    """
    source = docs.select("doc_id", row_key().alias("row_key"), F.coalesce("text", F.lit("")).alias("text"))
    source = source.withColumn("_rank", F.coalesce("doc_id", F.lit(-(1 << 63))))
    rows = docs.count()
    blocks = min(MOST_BLOCKS, max(4, -(-rows // block_rows)))
    ranked = with_balanced_blocks(source, "_rank", [], fan=max(2, int(blocks**0.5) + 1))
    # One row per block: what is last in it, and the block that has rows after it (or the first).
    last = ranked.groupBy("_block").agg(F.max(F.struct("_rank", "row_key")).alias("_last"))
    after = Window.orderBy("_block")
    whole = after.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    links = last.select(
        F.col("_last._rank").alias("_last_rank"),
        F.col("_last.row_key").alias("_last_key"),
        F.coalesce(F.lead("_block").over(after), F.first("_block").over(whole)).alias("_next"),
    )
    at_end = (ranked._rank == links._last_rank) & (ranked.row_key == links._last_key)
    # ``links`` has a row per block, MOST_BLOCKS at most.
    copies = ranked.join(F.broadcast(links), at_end, "left").withColumn(
        "_to",
        F.when(
            F.col("_next").isNotNull(),
            F.array(
                F.struct(F.col("_block").alias("block"), F.lit(1).alias("own")),
                F.struct(F.col("_next").alias("block"), F.lit(0).alias("own")),
            ),
        ).otherwise(F.array(F.struct(F.col("_block").alias("block"), F.lit(1).alias("own")))),
    )
    dealt = copies.select("doc_id", "_rank", "row_key", "text", F.explode("_to").alias("_to"))
    line = Window.partitionBy("_to.block").orderBy("_to.own", "_rank", "row_key")
    return (
        dealt.withColumn("next_text", F.lag("text").over(line))
        .where("_to.own = 1")
        .select("doc_id", "row_key", "text", "next_text")
    )


def op5_merkle(spark, sf_dir: str) -> DataFrame:
    n = F.length("text")
    cut = F.floor(n / 3).cast("int")
    edited = with_next(documents(spark, sf_dir)).select(
        "doc_id",
        n.cast("long").alias("n_chars"),
        "text",
        "next_text",
        F.concat(
            F.substring("text", F.lit(1), n - cut), F.substring("next_text", F.lit(1), cut)
        ).alias("edited"),
    )
    nodes = edited.select(
        "doc_id",
        "n_chars",
        F.sha2("edited", 256).alias("edited_sha256"),
        tree(F.col("text")).alias("own"),
        tree(F.col("edited")).alias("changed"),
        tree(F.col("next_text")).alias("other"),
    )
    return nodes.select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        F.concat(root(F.col("own")), F.lit(":"), "own").alias("fingerprint"),
        F.concat(root(F.col("changed")), F.lit(":"), "changed").alias("edited_fingerprint"),
        likeness(F.col("own"), F.col("changed")).alias("near_edited"),
        likeness(F.col("own"), F.col("other")).alias("near_next"),
    )


def _sql_tree(text: str) -> str:
    return f"""regexp_replace(array_to_string(list_transform(
    string_split(regexp_replace({text}, '((?:[^ \n]+ +){{{LEAF_WORDS}}})', '\\1' || chr(1), 'g'), chr(10)),
    lambda p: array_to_string(list_transform(string_split(p, chr(1)),
      lambda x: left(md5(x), {LEAF_DIGITS})), ',')), ';'), '([08]);', '\\1|', 'g')"""


def _sql_root(nodes: str) -> str:
    return f"""sha256(array_to_string(list_transform(string_split({nodes}, '|'),
    lambda s: sha256(array_to_string(list_transform(string_split(s, ';'),
      lambda p: sha256(p)), ''))), '')) || ':' || {nodes}"""


def _sql_likeness(a: str, b: str) -> str:
    x, y = (f"list_distinct(string_split(translate({c}, ';|', ',,'), ','))" for c in (a, b))
    both = f"len(list_intersect({x}, {y}))"
    return f"{both}::double / (len({x}) + len({y}) - {both})"


ORACLES = {
    "op5_merkle": f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
l AS (SELECT doc_id, text, coalesce(lead(text) OVER (ORDER BY doc_id DESC),
        first_value(text) OVER (ORDER BY doc_id DESC)) AS nxt FROM d),
e AS (SELECT *, left(text, (length(text) - length(text) // 3)::int)
        || left(nxt, (length(text) // 3)::int) AS edited FROM l),
t AS (SELECT doc_id, length(text) AS n_chars, sha256(edited) AS edited_sha256,
        {_sql_tree("text")} AS own, {_sql_tree("edited")} AS changed, {_sql_tree("nxt")} AS other
      FROM e)
SELECT doc_id, n_chars::bigint AS n_chars, edited_sha256, {_sql_root("own")} AS fingerprint,
  {_sql_root("changed")} AS edited_fingerprint, {_sql_likeness("own", "changed")} AS near_edited,
  {_sql_likeness("own", "other")} AS near_next
FROM t"""
}
QUERIES = {"op5_merkle": op5_merkle}
