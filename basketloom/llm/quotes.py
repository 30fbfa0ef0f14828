"""Quotation linking: nested quotes are parsed, joined to the messages they come from, and removed.

A line's level is the number of ``>`` that open it. Consecutive lines of one level are a passage.
Lines are normalised (lower case, single blanks) and hashed; a quoted line comes from the first
earlier message of the conversation that says it unquoted; a passage from the message that most of
its lines come from, the latest of these on a tie. A message replies to the origin of its passages
of level one. Replies hang in threads, each ordered so that a message follows what it answers.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators.running import running_totals
from .shared import documents, written

# Turns of one conversation that are ranked in one block.
BLOCK_TURNS = 4096
_LEVEL = r"^((?:[ \t]*>)*)"
_ATTRIBUTION = r"^On .* wrote:[ \t]*$"


def parsed_lines(messages: DataFrame) -> DataFrame:
    """conv_id, turn, place, level, line (without marks), key (hash; null for a blank line)."""
    marks = F.regexp_extract("raw", _LEVEL, 1)
    split = messages.select(
        "conv_id", "turn", F.posexplode(F.split(F.coalesce("text", F.lit("")), "\n", -1)).alias("place", "raw")
    )
    levelled = split.select(
        "conv_id",
        "turn",
        "place",
        F.length(F.regexp_replace(marks, "[^>]", "")).alias("level"),
        F.when(marks == "", F.col("raw"))
        .otherwise(F.regexp_replace("raw", _LEVEL + " ?", ""))
        .alias("line"),
    )
    plain = F.trim(F.regexp_replace(F.lower("line"), r"\s+", " "))
    return levelled.withColumn("key", F.when(plain != "", F.md5(plain)))


def link_quotes(messages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(messages, passages) of a table (conv_id, turn, text).

    Messages: conv_id, turn, parent_turn, root_turn, depth, position, n_quoted, own_text, where
    ``position`` counts the messages of a thread from 1. Passages: conv_id, turn, first_line, level,
    n_lines, origin_turn (null where no earlier message has a line of it).

    A null text is an empty message. Messages that repeat a (conv_id, turn) are one: the greatest
    text stays. Rows without conv_id or turn belong to no conversation and are left out. An empty
    table gives empty results; other columns are ignored.
    """
    key = ["conv_id", "turn"]
    once = messages.where("conv_id is not null and turn is not null").groupBy(*key).agg(
        F.max("text").alias("text")
    )
    in_message = Window.partitionBy(*key).orderBy("place")
    lines = parsed_lines(once)
    following = F.lead("level").over(in_message)
    # A line that announces a quotation goes with it.
    announces = (F.col("level") == 0) & (following > 0) & F.col("line").rlike(_ATTRIBUTION)
    marked = lines.withColumn("announces", F.coalesce(announces, F.lit(False)))
    starts = F.coalesce((F.col("level") != F.lag("level").over(in_message)).cast("int"), F.lit(1))
    marked = written(
        marked.withColumn("starts", starts)
        .withColumn("passage", F.sum("starts").over(in_message))
        .drop("starts"),
        "lines",
    )

    own = marked.where("level = 0 and not announces")
    texts = own.groupBy(*key).agg(
        F.array_join(
            F.transform(F.array_sort(F.collect_list(F.struct("place", "line"))), lambda x: x.line),
            "\n",
        ).alias("own_text")
    )
    # A line has one origin: its first message. So a line that many repeat joins one row.
    origins = own.where("key is not null").groupBy("conv_id", "key").agg(
        F.min("turn").alias("origin")
    )
    quoted = marked.where("level > 0 and key is not null")
    votes = (
        quoted.join(origins, ["conv_id", "key"])
        .where("origin < turn")
        .groupBy(*key, "passage", "level", "origin")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    winner = votes.groupBy(*key, "passage").agg(F.max(F.struct("n", "origin")).alias("best"))
    passages = (
        marked.where("level > 0")
        .groupBy(*key, "passage", "level")
        .agg(F.min("place").alias("first_line"), F.count(F.lit(1)).alias("n_lines"))
        .join(winner, [*key, "passage"], "left")
        .select(*key, "first_line", "level", "n_lines", F.col("best.origin").alias("origin_turn"))
    )
    replies = (
        votes.where("level = 1")
        .groupBy(*key, "origin")
        .agg(F.sum("n").alias("n"))
        .groupBy(*key)
        .agg(F.max(F.struct("n", "origin")).alias("best"))
        .select(*key, F.col("best.origin").alias("parent_turn"))
    )
    threads = _threads(replies)
    counted = quoted.groupBy(*key).agg(F.count(F.lit(1)).alias("n_quoted"))
    placed = (
        once.select(*key)
        .join(texts, key, "left")
        .join(threads, key, "left")
        .join(counted, key, "left")
        .select(
            *key,
            "parent_turn",
            F.coalesce("root_turn", "turn").alias("root_turn"),
            F.coalesce("depth", F.lit(0)).alias("depth"),
            F.coalesce("n_quoted", F.lit(0)).alias("n_quoted"),
            F.coalesce("own_text", F.lit("")).alias("own_text"),
        )
    )
    # Parents have smaller turns, so the turn orders a thread. Ranks need no text.
    ranks = running_totals(
        placed.select(*key, "root_turn"),
        keys=["conv_id", "root_turn"],
        block=F.floor(F.col("turn") / BLOCK_TURNS),
        order=["turn"],
        totals={"position": F.lit(1)},
    ).select(*key, "position")
    return placed.join(ranks, key), passages


def _threads(replies: DataFrame) -> DataFrame:
    """Root and depth of every reply, by pointers that double their reach each round.

    A pointer that meets no further reply has found its root: later rounds read its row, but move
    only the rows that are still on their way.
    """
    moving = written(
        replies.select(
            "conv_id", "turn", "parent_turn", F.col("parent_turn").alias("root_turn"),
            F.lit(1).alias("depth"),
        ),
        "threads",
    )
    settled = moving.limit(0)
    while True:
        step = settled.unionByName(moving).select(
            "conv_id",
            F.col("turn").alias("root_turn"),
            F.col("root_turn").alias("next_root"),
            F.col("depth").alias("more"),
        )
        moved = written(
            moving.join(step, ["conv_id", "root_turn"], "left").select(
                "conv_id",
                "turn",
                "parent_turn",
                F.coalesce("next_root", "root_turn").alias("root_turn"),
                (F.col("depth") + F.coalesce("more", F.lit(0))).alias("depth"),
                F.col("next_root").isNotNull().alias("went"),
            ),
            "threads",
        )
        settled = settled.unionByName(moved.where("not went").drop("went"))
        moving = moved.where("went").drop("went")
        if moving.isEmpty():
            return settled


def quoting_archive(conversations: DataFrame) -> DataFrame:
    """``conversations`` as mail: every turn quotes the one before it, which quotes its own.

    Rows that repeat a turn are one message, as in ``link_quotes``: the greatest text stays.
    """
    text = F.coalesce("text", F.lit("")).alias("text")
    base = (
        conversations.groupBy("conv_id", "turn")
        .agg(F.max(F.struct(text, "role")).alias("kept"))
        .select("conv_id", "turn", "kept.role", "kept.text")
    )

    def earlier(by: int) -> DataFrame:
        return base.select(
            "conv_id", (F.col("turn") + by).alias("turn"), F.col("role").alias(f"role_{by}"),
            F.col("text").alias(f"text_{by}"),
        )

    def quote(text: str, marks: str):
        return F.concat(F.lit(marks), F.regexp_replace(text, "\n", "\n" + marks))

    joined = base.join(earlier(1), ["conv_id", "turn"], "left").join(
        earlier(2), ["conv_id", "turn"], "left"
    )
    return joined.select(
        "conv_id",
        "turn",
        F.concat_ws(
            "\n",
            "text",
            F.when(F.col("text_1").isNotNull(), F.concat(F.lit("On another day "), "role_1", F.lit(" wrote:"))),
            quote("text_1", "> "),
            quote("text_2", "> > "),
        ).alias("text"),
    )


def op1_quotes(spark, sf_dir: str) -> DataFrame:
    """Threads of the mail archive made of ``conversations``."""
    messages, _ = link_quotes(quoting_archive(documents(spark, sf_dir, "conversations")))
    return messages.select(
        "conv_id",
        "turn",
        "parent_turn",
        "root_turn",
        F.col("depth").cast("long").alias("depth"),
        F.col("position").cast("long").alias("position"),
        F.col("n_quoted").cast("long").alias("n_quoted"),
        F.sha2("own_text", 256).alias("own_sha256"),
    )


ORACLES = {
    "op1_quotes": """
WITH RECURSIVE c AS (SELECT conv_id, turn, coalesce(text, '') AS text FROM conversations),
l AS (SELECT conv_id, turn, md5(k) AS k FROM (
  SELECT conv_id, turn, trim(regexp_replace(lower(unnest(string_split(text, chr(10)))), '\\s+', ' ', 'g')) AS k
  FROM c) WHERE k <> ''),
o AS (SELECT conv_id, k, min(turn) AS origin FROM l GROUP BY ALL),
q AS (SELECT conv_id, turn + 1 AS turn, k, 1 AS level FROM l
  UNION ALL SELECT conv_id, turn + 2, k, 2 FROM l),
m AS (SELECT q.* FROM q JOIN c USING (conv_id, turn)),
v AS (SELECT conv_id, turn, origin, count(*) AS n FROM m JOIN o USING (conv_id, k)
  WHERE level = 1 AND origin < turn GROUP BY ALL),
p AS (SELECT conv_id, turn, arg_max(origin, (n, origin)) AS parent_turn FROM v GROUP BY ALL),
r AS (SELECT conv_id, turn, turn AS root_turn, 0 AS depth FROM c ANTI JOIN p USING (conv_id, turn)
  UNION ALL SELECT p.conv_id, p.turn, r.root_turn, r.depth + 1
  FROM p JOIN r ON p.conv_id = r.conv_id AND p.parent_turn = r.turn),
n AS (SELECT conv_id, turn, count(*) AS n_quoted FROM m GROUP BY ALL)
SELECT conv_id, turn, parent_turn, root_turn, depth::bigint AS depth,
  row_number() OVER (PARTITION BY conv_id, root_turn ORDER BY turn) AS position,
  coalesce(n_quoted, 0)::bigint AS n_quoted, sha256(text) AS own_sha256
FROM r JOIN c USING (conv_id, turn) LEFT JOIN p USING (conv_id, turn)
LEFT JOIN n USING (conv_id, turn)"""
}
QUERIES = {"op1_quotes": op1_quotes}
