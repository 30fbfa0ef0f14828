"""Source divergence audit: how far the sources of a language differ in the terms they use.

1. In every task Arrow's own kernels lower A-Z, cut the texts into terms, code them and count them by
   (language, source, term); a bounded table of partial counts goes out, never a row per word.
2. The partial counts meet by (language, term). Terms of too few documents go there.
3. Shards of the kept counts become columns, one per source, and every pair of sources sums its
   divergence over the terms of the shard in 64-bit integers. Sources come in tiles, so a shard's
   columns are bounded however many sources a language has.

Smoothed shares are p = 1 + floor(10^9 (count + 2) / (N + 2 V)); a term gives a pair
floor((p - q)^2 / (p + q)). All of it is integer arithmetic.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.running import top_per_key
from .shared import SLICE_BYTES, documents, written

BREAK = r"[\x00-\x40\x5B-\x60\x7B-\x7F]+"
LEAST_DOCUMENTS = 10
TOP_TERMS = 10
UNIT = 1_000_000_000
# Rows of partial counts that a task holds before it passes them on.
HELD_ROWS = 1 << 20
# Sources of a tile, and counts of a shard: a shard's task holds TILE * 2 columns at most.
TILE = 256
SHARD_ROWS = 200_000

COUNTS = "lang string, source string, term string, n long, docs long"


def _slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Parts of a batch with about ``SLICE_BYTES`` of text; a longer text is a part by itself."""
    upto = np.cumsum(pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy(False))
    low = 0
    while low < len(upto):
        done = upto[low - 1] if low else 0
        high = max(low + 1, int(np.searchsorted(upto, done + SLICE_BYTES, "right")))
        yield batch.slice(low, high - low)
        low = high


def _terms_of(part: pa.RecordBatch) -> pa.Table:
    """(lang, source, term, n, docs) of a few documents; a group without terms has a null term."""
    lang, source = (pc.fill_null(part.column(c), "") for c in ("lang", "source"))
    text = pc.ascii_lower(pc.fill_null(part.column("text"), ""))
    cut = pc.split_pattern_regex(text, pattern=BREAK)
    owner, term = pc.list_parent_indices(cut), pc.list_flatten(cut)
    full = pc.greater(pc.binary_length(term), 0)
    owner, coded = owner.filter(full), term.filter(full).dictionary_encode()
    # Once by document, for the number of documents; then by group.
    docs = pa.table({"doc": owner, "code": coded.indices})
    docs = docs.group_by(["doc", "code"], use_threads=False).aggregate([([], "count_all")])
    rows = pa.table(
        {
            "lang": lang.take(docs["doc"]).cast(pa.string()),
            "source": source.take(docs["doc"]).cast(pa.string()),
            "code": docs["code"],
            "n": docs["count_all"],
        }
    ).group_by(["lang", "source", "code"], use_threads=False)
    rows = rows.aggregate([("n", "sum"), ("n", "count")])
    groups = pa.table({"lang": lang.cast(pa.string()), "source": source.cast(pa.string())})
    groups = groups.group_by(["lang", "source"], use_threads=False).aggregate([([], "count_all")])
    found = pa.table(
        {
            "lang": rows["lang"],
            "source": rows["source"],
            "term": coded.dictionary.take(rows["code"]).cast(pa.string()),
            "n": rows["n_sum"],
            "docs": rows["n_count"],
        }
    )
    bare = pa.table(
        {
            "lang": groups["lang"],
            "source": groups["source"],
            "term": pa.nulls(len(groups), pa.string()),
            "n": pa.array(np.zeros(len(groups), np.int64)),
            "docs": groups["count_all"],
        }
    )
    return pa.concat_tables([found, bare])


def _merge(tables: list[pa.Table]) -> pa.Table:
    keys = ["lang", "source", "term"]
    merged = pa.concat_tables(tables).group_by(keys, use_threads=False)
    merged = merged.aggregate([("n", "sum"), ("docs", "sum")])
    return merged.select([*keys, "n_sum", "docs_sum"]).rename_columns([*keys, "n", "docs"])


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: list[pa.Table] = []
    rows = 0
    for batch in batches:
        for part in _slices(batch):
            held.append(_terms_of(part))
            rows += len(held[-1])
            if rows > HELD_ROWS:
                held = [_merge(held)]
                rows = len(held[0])
                if rows > HELD_ROWS // 2:
                    yield from held[0].to_batches()
                    held, rows = [], 0
    if held:
        yield from _merge(held).to_batches()


def term_counts(docs: DataFrame, least_documents: int = LEAST_DOCUMENTS) -> DataFrame:
    """(lang, source, term, n, lang_n, opens): counts of the terms of enough documents.

    ``lang_n`` is the term's count in the language; ``opens`` is 1 in one row of every (lang, term).
    Every (lang, source) has a row with a null term besides.
    """
    term = Window.partitionBy("lang", "term")
    merged = (
        docs.select("lang", "source", "text")
        .mapInArrow(_count, COUNTS)
        .repartition("lang", "term")
        .groupBy("lang", "source", "term")
        .agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    )
    place = F.row_number().over(term.orderBy("source"))
    return (
        merged.select(
            "lang",
            "source",
            "term",
            "n",
            F.sum("n").over(term).alias("lang_n"),
            F.sum("docs").over(term).alias("lang_docs"),
            F.when(F.col("term").isNotNull() & (place == 1), 1).otherwise(0).alias("opens"),
        )
        .where(F.col("term").isNull() | (F.col("lang_docs") >= least_documents))
        .drop("lang_docs")
    )


def group_sizes(counts: DataFrame) -> DataFrame:
    """(lang, source, total, lang_total, terms, place, sources) of every group."""
    lang = Window.partitionBy("lang")
    return (
        counts.groupBy("lang", "source")
        .agg(F.sum("n").alias("total"), F.sum("opens").alias("opens"))
        .select(
            "lang",
            "source",
            "total",
            F.sum("total").over(lang).alias("lang_total"),
            F.sum("opens").over(lang).alias("terms"),
            (F.row_number().over(lang.orderBy("source")) - 1).alias("place"),
            F.count(F.lit(1)).over(lang).alias("sources"),
        )
    )


def share(count: Column, total: Column, terms: Column) -> Column:
    """1 + floor(UNIT (count + 2) / (total + 2 terms)); null where there are no terms."""
    above = F.lit(UNIT).cast("decimal(10,0)") * (count + 2).cast("decimal(20,0)")
    below = (total + 2 * terms).cast("decimal(20,0)")
    found = F.call_function("div", above, F.when(terms > 0, below))
    return (found + 1).cast("long")


def divergence(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), p + q)


def _shares(count: np.ndarray, total: np.ndarray, terms: int) -> np.ndarray:
    """``share`` in 64-bit integers: three steps of a thousand, each with its remainder."""
    below = total + 2 * terms
    rest = count + 2
    found = np.zeros_like(rest)
    for _ in range(3):
        whole, rest = np.divmod(rest * 1000, below)
        found = found * 1000 + whole
    return found + 1


PAIRS = "lang string, a int, b int, value long, seen long"


def _compare(key, counts: pa.Table, sizes: pa.Table) -> pa.Table:
    """Divergences of the sources of two tiles, summed over the terms of a shard."""
    first, second = key[1].as_py(), key[2].as_py()
    place = sizes["place"].to_numpy()
    order = np.argsort(place)
    place = place[order]
    total = sizes["total"].to_numpy()[order]
    terms = sizes["terms"][0].as_py()
    mine = np.flatnonzero(place // TILE == first)
    others = np.flatnonzero(place // TILE == second)
    sums = np.zeros((len(mine), len(others)), np.int64)
    coded = counts["term"].combine_chunks().dictionary_encode()
    seen = len(coded.dictionary)
    code = coded.indices.to_numpy()
    column = np.searchsorted(place, counts["place"].to_numpy())
    n = counts["n"].to_numpy()
    by_code = np.argsort(code, kind="stable")
    block = max(1, (1 << 20) // max(1, len(place)))
    for low in range(0, seen, block):
        high = min(seen, low + block)
        at = by_code[
            np.searchsorted(code, low, sorter=by_code) : np.searchsorted(code, high, sorter=by_code)
        ]
        table = np.zeros((high - low, len(place)), np.int64)
        table[code[at] - low, column[at]] = n[at]
        p = _shares(table, total[None, :], terms)
        q = p[:, others]
        for i, own in enumerate(mine):
            x = p[:, own][:, None]
            gap = x - q
            sums[i] += (gap * gap // (x + q)).sum(axis=0)
    a, b = np.meshgrid(place[mine], place[others], indexing="ij")
    wanted = a < b
    size = int(wanted.sum())
    return pa.table(
        {
            "lang": pa.array([key[0].as_py()] * size, pa.string()),
            "a": pa.array(a[wanted].astype(np.int32)),
            "b": pa.array(b[wanted].astype(np.int32)),
            "value": pa.array(sums[wanted]),
            "seen": pa.array(np.full(size, seen, np.int64)),
        }
    )


def pair_divergences(counts: DataFrame, sizes: DataFrame) -> DataFrame:
    """(lang, source, item, value) for every two sources of a language, both ways round.

    A term that neither of two tiles has in a shard adds the divergence of two zero counts, which is
    one number for a pair of sources; so only occurring counts move.
    """
    shards = max(1, -(-counts.count() // SHARD_ROWS))
    tile = F.floor(F.col("place") / TILE)
    others = F.sequence(F.lit(0), F.floor((F.col("sources") - 1) / TILE))

    def dealt(df: DataFrame, *columns: str) -> DataFrame:
        """A row for every pair of tiles that its own tile belongs to."""
        return df.select("*", tile.alias("_tile"), F.explode(others).alias("_other")).select(
            "lang",
            F.least("_tile", "_other").alias("first"),
            F.greatest("_tile", "_other").alias("second"),
            *columns,
        )

    key = ["lang", "first", "second", "shard"]
    rows = counts.where("term IS NOT NULL").join(sizes, ["lang", "source"]).select(
        "lang", "place", "sources", "term", "n",
        F.pmod(F.xxhash64("term"), F.lit(shards)).alias("shard"),
    )
    # Renamed to itself: the two sides of a cogroup must not share columns.
    rows = dealt(rows, "shard", "place", "term", "n").toDF(*key, "place", "term", "n")
    every = sizes.select("*", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"))
    every = dealt(every.withColumn("shard", F.col("shard").cast("long")), "shard", "place", "total", "terms")
    found = (
        rows.groupBy(*key)
        .cogroup(every.groupBy(*key))
        .applyInArrow(_compare, PAIRS)
        .groupBy("lang", "a", "b")
        .agg(F.sum("value").alias("value"), F.sum("seen").alias("seen"))
    )
    none = share(F.lit(0), F.col("total"), F.col("terms"))
    side = sizes.select("lang", "place", "source", "terms", none.alias("none"))
    one = side.toDF("lang", "a", "source_a", "terms", "none_a")
    two = side.drop("terms").toDF("lang", "b", "source_b", "none_b")
    rest = (F.col("terms") - F.col("seen")) * divergence(F.col("none_a"), F.col("none_b"))
    valued = found.join(one, ["lang", "a"]).join(two, ["lang", "b"]).select(
        "lang",
        "source_a",
        "source_b",
        (F.col("value") + F.coalesce(rest, F.lit(0))).alias("value"),
    )
    back = valued.select("lang", F.col("source_b"), F.col("source_a"), "value")
    return valued.union(back).toDF("lang", "source", "item", "value")


def distinctive_terms(counts: DataFrame, sizes: DataFrame) -> DataFrame:
    """(lang, source, item, value) of the terms that a group uses more than its language."""
    p = share(F.col("n"), F.col("total"), F.col("terms"))
    q = share(F.col("lang_n"), F.col("lang_total"), F.col("terms"))
    return (
        counts.where("term IS NOT NULL AND n > 0")
        .join(sizes, ["lang", "source"])
        .select("lang", "source", F.col("term").alias("item"), p.alias("p"), q.alias("q"))
        .where("p > q")
        .select("lang", "source", "item", divergence(F.col("p"), F.col("q")).alias("value"))
    )


def audit(docs: DataFrame, least_documents: int = LEAST_DOCUMENTS, top: int = TOP_TERMS) -> DataFrame:
    """lang, source, part (``pair``, ``term``), item, value, rank.

    Null text, lang and source count as ''. Every row is a document, repeated ones too. Part
    ``pair`` has every other source of the language, part ``term`` the ``top`` terms that the group
    uses more than its language does. A language without kept terms has pairs of value 0; a source
    that is alone has no pairs. Other columns are ignored; an empty table gives no rows.
    """
    counts = written(term_counts(docs, least_documents), "term-counts")
    sizes = written(group_sizes(counts), "group-sizes")
    group = ["lang", "source"]
    order = [F.desc("value"), F.asc("item")]
    pairs = pair_divergences(counts, sizes)
    ranked = pairs.withColumn(
        "rank", F.row_number().over(Window.partitionBy(*group).orderBy(*order))
    )
    terms = top_per_key(distinctive_terms(counts, sizes), group, order, top, "rank")
    columns = ["item", "value", "rank"]
    return ranked.select(*group, F.lit("pair").alias("part"), *columns).unionByName(
        terms.select(*group, F.lit("term").alias("part"), *columns)
    )


def op11_divergence(spark, sf_dir: str) -> DataFrame:
    return audit(documents(spark, sf_dir))


_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _sql_share(count: str, total: str) -> str:
    return f"(1 + {UNIT}::hugeint * ({count} + 2) // ({total} + 2 * v))"


QUERIES = {"op11_divergence": op11_divergence}
ORACLES = {
    "op11_divergence": rf"""
WITH d AS (SELECT row_number() OVER () AS id, coalesce(lang, '') AS lang,
    coalesce(source, '') AS source,
    regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'),
      '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
w AS (SELECT id, lang, source, unnest(w) AS term FROM d),
kept AS (SELECT lang, term, count(*)::hugeint AS lang_n FROM w GROUP BY ALL
  HAVING count(DISTINCT id) >= {LEAST_DOCUMENTS}),
langs AS (SELECT d.lang, coalesce(any_value(k.v), 0)::hugeint AS v,
    coalesce(any_value(k.n), 0)::hugeint AS lang_total
  FROM d LEFT JOIN (SELECT lang, count(*) AS v, sum(lang_n) AS n FROM kept GROUP BY lang) k
  ON d.lang = k.lang GROUP BY d.lang),
c AS (SELECT w.lang, source, w.term, count(*)::hugeint AS n FROM w JOIN kept USING (lang, term)
  GROUP BY ALL),
g AS (SELECT d.lang, d.source, coalesce(any_value(t.n), 0)::hugeint AS total
  FROM (SELECT DISTINCT lang, source FROM d) d
  LEFT JOIN (SELECT lang, source, sum(n) AS n FROM c GROUP BY ALL) t
  ON d.lang = t.lang AND d.source = t.source GROUP BY ALL),
p AS (SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n,
    {_sql_share("coalesce(c.n, 0)", "total")} AS p, {_sql_share("lang_n", "lang_total")} AS q
  FROM g JOIN langs USING (lang) JOIN kept k ON g.lang = k.lang
  LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
pair AS (SELECT a.lang, a.source, b.source AS item,
    coalesce((SELECT sum((x.p - y.p) * (x.p - y.p) // (x.p + y.p)) FROM p x JOIN p y
      ON x.lang = y.lang AND x.term = y.term
      WHERE x.lang = a.lang AND x.source = a.source AND y.source = b.source), 0) AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source),
term AS (SELECT lang, source, term AS item, (p - q) * (p - q) // (p + q) AS value
  FROM p WHERE n > 0 AND p > q),
r AS (SELECT lang, source, 'pair' AS part, item, value FROM pair
  UNION ALL SELECT lang, source, 'term', item, value FROM term)
SELECT lang, source, part, item, value::bigint AS value, rank::int AS rank FROM (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank
  FROM r) WHERE part = 'pair' OR rank <= {TOP_TERMS}"""
}
