"""Language-model scoring with a probabilistic suffix tree.

A text is its tokens, each followed by a stop symbol; symbols are bytes. A context is the string of
up to ``depth`` symbols before a symbol; it may reach over the stop into the token before, by
``TAIL`` symbols. A context is kept if its next-symbol distribution diverges from the one of its
longest kept suffix (count-weighted relative entropy above ``threshold`` a symbol); distributions are
smoothed with that suffix's; a symbol is scored in the longest kept suffix of what precedes it. The
kept contexts form an automaton, so a text is scored in one walk. A token's probability mixes the
walk with its share of all training tokens (weight ``word_share``).

Words are counted over all training documents and joined to the documents as a table keyed by word:
documents are gathered in blocks, a block asks once for each of its distinct words, and the answers
meet the block's texts again. Nothing that grows with the corpus passes through the driver: it
gathers only contexts whose share of all symbols is at least ``least_share``, so at most
depth / least_share of them.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import documents, fold, row_key, written

DEPTH = 7
LEAST_SHARE = 5e-6
# Nats that a context must save over its suffix to be kept, per distinct next symbol.
THRESHOLD = 4.0
# Weight of the shorter suffix's distribution, in observations for each distinct next symbol.
PRIOR = 1.0
WORD_SHARE = 0.2
BLOCK_CHARS = 8 << 20
# The stop symbol cannot occur inside a word, the end token is no word.
STOP, END = 0x20, b"\x0a"
SYMBOLS = 256
# Symbols of the token before, and of the token itself, that contexts over the stop are counted for.
TAIL, HEAD = 5, 3
# n-grams that a task adds up before it hands them on.
MOST_GRAMS = 1_000_000
STREAM_BYTES = 1 << 20
LANE = 512


def tokens(text: str | None) -> list[bytes]:
    """Words in lower case (A-Z), split at blank, tab, LF, VT, FF and CR, and one end."""
    words = text.encode().lower().split() if text else []
    words.append(END)
    return words


def _word_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["word", "n"]

    def out(seen: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(seen.keys(), pa.binary()), pa.array(seen.values(), pa.int64())], names
        )

    seen: Counter = Counter()
    for batch in batches:
        for text in batch.column("text"):
            seen.update(tokens(text.as_py()))
        if len(seen) > 400_000:
            yield out(seen)
            seen = Counter()
    if seen:
        yield out(seen)


def streams(texts: Iterator) -> Iterator[tuple[np.ndarray, list[int]]]:
    """Symbols of texts in turn, as after an end token, with the number of tokens of each text."""
    parts, counts, size = [END], [], 0
    for text in texts:
        own = tokens(text.as_py())
        parts += own
        counts.append(len(own))
        size += len(parts[-1]) + 6 * len(own)
        if size > STREAM_BYTES:
            yield np.frombuffer(b" ".join(parts) + b" ", np.uint8), counts
            parts, counts, size = [END], [], 0
    if counts:
        yield np.frombuffer(b" ".join(parts) + b" ", np.uint8), counts


def _borders(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of (last TAIL bytes of a token, first HEAD bytes of the next), as 8 bytes each."""

    def merged(keys: list[np.ndarray], sizes: list[np.ndarray]):
        key, at = np.unique(np.concatenate(keys), return_inverse=True)
        return [key], [np.bincount(at, np.concatenate(sizes)).astype(np.int64)]

    def out() -> pa.RecordBatch:
        key, n = merged(keys, sizes)
        return pa.RecordBatch.from_arrays(
            [pa.array(key[0].view(np.int64)), pa.array(n[0])], ["key", "n"]
        )

    keys: list[np.ndarray] = []
    sizes: list[np.ndarray] = []
    for batch in batches:
        for symbols, _ in streams(batch.column("text")):
            padded = np.concatenate([np.full(TAIL, STOP, np.uint8), symbols])
            start = np.flatnonzero(padded[TAIL:-1] == STOP) + TAIL + 1
            key = np.zeros((len(start), 8), np.uint8)
            inside = np.ones(len(start), bool)
            for j in range(TAIL):
                byte = padded[start - 2 - j]
                inside &= byte != STOP
                key[:, TAIL - 1 - j] = np.where(inside, byte, 0)
            inside[:] = True
            for j in range(HEAD):
                byte = padded[np.minimum(start + j, len(padded) - 1)]
                key[:, TAIL + j] = np.where(inside, byte, 0)
                inside &= byte != STOP
            own, n = np.unique(key.view(np.uint64).ravel(), return_counts=True)
            keys.append(own)
            sizes.append(n)
            if sum(map(len, keys)) > 2_000_000:
                keys, sizes = merged(keys, sizes)
                if len(keys[0]) > 1_000_000:
                    yield out()
                    keys, sizes = [], []
    if keys:
        yield out()


def _counted(grams: Iterator[tuple[bytes, int]]) -> Iterator[pa.RecordBatch]:
    """Sums of a task's n-grams, in batches of bounded size."""
    seen: dict[bytes, int] = {}

    def out() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(seen.keys(), pa.binary()), pa.array(seen.values(), pa.int64())], ["gram", "n"]
        )

    for gram, n in grams:
        seen[gram] = seen.get(gram, 0) + n
        if len(seen) > MOST_GRAMS:
            yield out()
            seen = {}
    if seen:
        yield out()


def _border_contexts(depth: int):
    """Counted token borders -> counts of (context, symbol) for contexts over the stop."""

    def grams(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[bytes, int]]:
        for batch in batches:
            body = batch.column("key").to_numpy().tobytes()
            for i, n in enumerate(batch.column("n").to_pylist()):
                raw = body[8 * i : 8 * i + 8]
                tail = raw[:TAIL].lstrip(b"\0")
                line = tail + b" " + raw[TAIL:].rstrip(b"\0")
                for end in range(len(tail) + 2, len(line) + 1):
                    for start in range(max(0, end - 1 - depth), len(tail)):
                        yield line[start:end], n

    return lambda batches: _counted(grams(batches))


def _contexts(depth: int):
    """Counted words -> counts of (context, symbol) for contexts of 0 .. depth symbols."""

    def grams(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[bytes, int]]:
        for batch in batches:
            for word, n in zip(batch.column("word").to_pylist(), batch.column("n").to_pylist()):
                marked = b" " + word + b" "
                for end in range(2, len(marked) + 1):
                    for start in range(max(0, end - 1 - depth), end):
                        yield marked[start:end], n

    return lambda batches: _counted(grams(batches))


class SuffixTree:
    """Kept contexts as states of an automaton: next state and log10 probability by symbol."""

    def __init__(self, counts: dict[bytes, dict[int, int]], threshold: float, prior: float):
        """``counts``: context -> symbol -> count, with every suffix of a context present."""
        uniform = np.full(SYMBOLS, 1.0 / SYMBOLS)
        smooth: dict[bytes, np.ndarray] = {}
        for context in sorted(counts, key=len):
            # The distribution of the longest kept suffix, which stands in if this is not kept.
            parent = uniform
            for i in range(1, len(context) + 1):
                if context[i:] in smooth:
                    parent = smooth[context[i:]]
                    break
            at = np.fromiter(counts[context].keys(), np.int64)
            n = np.fromiter(counts[context].values(), np.float64)
            total = n.sum()
            gain = (n * np.log(n / max(total, 1) / parent[at])).sum()
            if context and gain < threshold * len(at):
                continue
            weight = max(prior * len(at), 1.0)
            own = parent * (weight / (total + weight))
            own[at] += n / (total + weight)
            smooth[context] = own
        # States also need every prefix of a kept context, to walk there symbol by symbol.
        states = {c[:i] for c in smooth for i in range(len(c) + 1)}
        names = sorted(states, key=lambda c: (len(c), c))
        number = {c: i for i, c in enumerate(names)}
        self.step = np.zeros((len(names), SYMBOLS), np.int32)
        self.log = np.zeros((len(names), SYMBOLS), np.float32)
        follow: dict[bytes, list[int]] = {}
        for c in names[1:]:
            follow.setdefault(c[:-1], []).append(c[-1])
        for i, context in enumerate(names):
            suffixes = [context[k:] for k in range(len(context) + 1)]
            self.log[i] = np.log10(smooth[next(c for c in suffixes if c in smooth)])
            if context:
                # A symbol without a longer state leads where it leads from the shorter one.
                self.step[i] = self.step[number[next(c for c in suffixes[1:] if c in number)]]
            for s in follow.get(context, []):
                self.step[i, s] = number[context + bytes([s])]
        self.kept = len(smooth)

    def walk(self, symbols: np.ndarray, warm: int) -> np.ndarray:
        """log10 probability of every symbol, given what precedes it in ``symbols``.

        The text is cut into lanes that are walked side by side. A state depends on the last
        ``warm`` symbols at most, so each lane begins that much earlier.
        """
        lanes = -(-len(symbols) // LANE)
        line = np.full(warm + lanes * LANE, STOP, np.uint8)
        line[warm : warm + len(symbols)] = symbols
        at = np.arange(lanes) * LANE
        state = np.zeros(lanes, np.int32)
        out = np.empty((LANE, lanes), np.float32)
        for place in range(warm + LANE):
            symbol = line[at + place]
            if place >= warm:
                out[place - warm] = self.log[state, symbol]
            state = self.step[state, symbol]
        return out.T.ravel()[: len(symbols)]


def grow(
    words: DataFrame, borders: DataFrame, depth: int, least_share: float, threshold: float, prior: float
) -> SuffixTree:
    """The tree for tables of counted words (word, n) and token borders (key, n)."""
    grams = written(
        words.mapInArrow(_contexts(depth), "gram binary, n long")
        .unionByName(borders.mapInArrow(_border_contexts(depth), "gram binary, n long"))
        .groupBy("gram")
        .agg(F.sum("n").alias("n")),
        "grams",
    )
    context = F.expr("substring(gram, 1, length(gram) - 1)")
    sizes = grams.groupBy(context.alias("context")).agg(F.sum("n").alias("size"))
    symbols = grams.where("length(gram) = 1").agg(F.sum("n")).first()[0] or 0
    frequent = sizes.where(F.col("size") >= max(2, math.ceil(least_share * symbols)))
    table = (
        grams.withColumn("context", context)
        .join(frequent, "context")
        .select("context", F.expr("substring(gram, length(gram), 1)").alias("symbol"), "n")
        .toArrow()
    )
    counts: dict[bytes, dict[int, int]] = {b"": {}}
    for c, s, n in zip(*(table[x].to_pylist() for x in ("context", "symbol", "n"))):
        counts.setdefault(c, {})[s[0]] = n
    return SuffixTree(counts, threshold, prior)


def _distinct(table: pa.Table) -> pa.Table:
    """The distinct words of a block."""
    seen: set[bytes] = set()
    for text in table["text"]:
        seen.update(tokens(text.as_py()))
    block = table["block"][0].as_py()
    words = pa.array(seen, pa.binary())
    return pa.table({"block": pa.array([block] * len(words), pa.int64()), "word": words})


def _sum_up(total: int, distinct: int, word_share: float, depth: int, tree):
    names = ["doc_id", "row_key", "n_tokens", "n_known", "base_score", "score"]
    kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.float64(), pa.float64()]
    norm = math.log10(total + 0.5 * (distinct + 1))

    def run(key, docs: pa.Table, answers: pa.Table) -> pa.Table:
        words = answers["word"].to_pylist()
        n = answers["n"].fill_null(0).to_numpy().astype(float)
        base = np.log10(n + 0.5) - norm
        place = {w: i for i, w in enumerate(words)}
        found: list[tuple] = []
        for symbols, counts in streams(docs["text"]):
            logs = tree.value.walk(symbols, depth + 1).astype(float)
            stops = np.flatnonzero(symbols == STOP)
            # Symbols of a token run from behind the stop before it to its own stop.
            spelt = np.add.reduceat(logs, stops[:-1] + 1)
            parts = symbols.tobytes().split(b" ")[1:-1]
            at = np.array([place[w] for w in parts])
            own = spelt
            if total:
                share = np.log10(n[at] / total, where=n[at] > 0, out=np.full(len(at), -np.inf))
                own = np.logaddexp(
                    (share + math.log10(word_share)) * math.log(10),
                    (spelt + math.log10(1 - word_share)) * math.log(10),
                ) / math.log(10)
            first = np.cumsum(counts) - counts
            found += zip(
                counts,
                np.add.reduceat((n[at] > 0).astype(np.int64), first).tolist(),
                np.add.reduceat(base[at], first).tolist(),
                np.add.reduceat(own, first).tolist(),
            )
        columns = [docs["doc_id"], docs["row_key"], *(zip(*found) if found else [[]] * 4)]
        return pa.table(
            {k: c if hasattr(c, "type") else pa.array(c, t) for k, c, t in zip(names, columns, kinds)}
        )

    return run


def score_texts(
    docs: DataFrame,
    training,
    depth: int = DEPTH,
    least_share: float = LEAST_SHARE,
    threshold: float = THRESHOLD,
    prior: float = PRIOR,
    word_share: float = WORD_SHARE,
    block_chars: int = BLOCK_CHARS,
) -> DataFrame:
    """Per row: doc_id, row_key, n_tokens, n_known, train_tokens, base_score, score.

    ``training`` is the condition for the rows to learn from. A null or empty text is one token, the
    end. ``base_score`` sums add-half unigram log10 probabilities, ``score`` those of the tree. Rows
    that repeat a doc_id come out once each; without training rows every token is unknown and the
    tree is uniform; other columns are ignored.
    """
    source = docs.select("doc_id", row_key().alias("row_key"), "text", training.alias("_train"))
    words = written(
        source.where("_train").select("text")
        .mapInArrow(_word_counts, "word binary, n long")
        .groupBy("word")
        .agg(F.sum("n").alias("n")),
        "words",
    )
    n_train, distinct = words.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))).first()
    borders = (
        source.where("_train").select("text")
        .mapInArrow(_borders, "key long, n long")
        .groupBy("key")
        .agg(F.sum("n").alias("n"))
    )
    tree = docs.sparkSession.sparkContext.broadcast(
        grow(words, borders, depth, least_share, threshold, prior)
    )

    chars = source.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = max(1, -(-chars // block_chars))
    blocked = source.select(
        F.pmod(F.xxhash64("doc_id", "row_key"), F.lit(blocks)).alias("block"),
        "doc_id",
        "row_key",
        "text",
    )
    asked = blocked.groupBy("block").applyInArrow(_distinct, "block long, word binary")
    answers = asked.join(words, "word", "left").select("block", "word", "n")
    schema = (
        "doc_id long, row_key int, n_tokens long, n_known long, base_score double, score double"
    )
    return (
        blocked.groupBy("block")
        .cogroup(answers.groupBy("block"))
        .applyInArrow(_sum_up(n_train, distinct, word_share, depth, tree), schema)
        .withColumn("train_tokens", F.lit(n_train).cast("long"))
    )


def op3_suffix_tree_lm(spark, sf_dir: str) -> DataFrame:
    held_out = fold("doc_id", 5) == 1
    return score_texts(documents(spark, sf_dir), ~held_out).select(
        "doc_id", held_out.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score",
        "score",
    )


# The tree itself has no SQL; tests check counts and base scores against a direct computation, and
# that the tree is a distribution which beats the base on documents held out.
QUERIES = {"op3_suffix_tree_lm": op3_suffix_tree_lm}
ORACLES: dict[str, str] = {}
