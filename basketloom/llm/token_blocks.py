"""Token ids in entropy-coded blocks: static range asymmetric numeral system (rANS).

File format: a Parquet table of blocks in ascending order of (part, number). A block is one binary
frame that can be decoded by itself with the table of frequencies:

    magic ``TKB1`` | lanes u32 | ids u32 | checkpoints u32 | words u32 | crc32 of the ids u32
    final state of every lane u64 | checkpoints: (step u32, word u32, states u64 per lane) | words u32

Ids are dealt over ``lanes`` interleaved coders, so one numpy operation advances them all.
Checkpoints hold the states in mid-block: decoding may start at any of them.
"""

from __future__ import annotations

import os
import string
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .shared import LOWER, SPACE, bodies, changes, distinct_spans, documents, gathered, written

END_ID = 2
LANES = 1024
BLOCK_IDS = 1 << 18
# Frequencies add up to 2 ** BITS; states stay in [2 ** 31, 2 ** 63).
BITS = 22
LOW = np.uint64(1 << 31)
# Steps between two checkpoints.
CHECKPOINT = 128
# Distinct parts of texts in each of the two generations that a task remembers.
REMEMBERED = 400_000
# Bytes of texts whose parts are looked up together, and parts that are encoded as one text.
TEXT_BYTES = 4 << 20
JOINED = 100
# Characters that may part them.
SEPARATORS = "\u00bd\u00bc\u00b2\u00b3"
MAGIC = b"TKB1"
# Stands for a null doc_id in the file.
NO_ID = -(1 << 63)
# Kinds of bytes: 0 white space, 1 letters, 2 digits, 3 punctuation, 4 the apostrophe, 5 all others.
KINDS = np.full(256, 5, np.uint8)
KINDS[SPACE] = 0
for _kind, _characters in enumerate([string.ascii_letters, string.digits, string.punctuation, "'"], 1):
    KINDS[list(_characters.encode())] = _kind
# Between which kinds a text always parts: not after an apostrophe, which may begin "'s" or end a run
# of punctuation, not inside such a run, and not beside bytes whose kind depends on the character.
CUTS = np.zeros((6, 6), bool)
CUTS[1:5, 1:5] = ~np.eye(4, dtype=bool)
CUTS[2, 2] = True
CUTS[4, 1] = CUTS[3, 4] = CUTS[4, 3] = False
_tokenizers: dict[str, tuple] = {}


# ---- frequencies --------------------------------------------------------------------------


def scaled(counts: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Integer frequencies with sum 2 ** bits, at least 1 for every id."""
    total = 1 << bits
    if len(counts) * 2 > total:
        raise ValueError("more ids than the table of frequencies can hold")
    share = counts / max(counts.sum(), 1) * (total - len(counts))
    freq = np.floor(share).astype(np.int64) + 1
    rest = total - freq.sum()
    # What rounding left over goes to the largest frequencies, where it matters least.
    freq[np.argsort(-counts, kind="stable")[: max(0, rest)]] += 1
    freq[np.argmax(freq)] += total - freq.sum()
    return freq.astype(np.uint64)


class Frequencies:
    def __init__(self, freq: np.ndarray):
        self.freq = freq
        self.start = (np.cumsum(freq) - freq).astype(np.uint64)
        self.symbol = np.repeat(np.arange(len(freq), dtype=np.uint32), freq.astype(np.int64))


# ---- one block ----------------------------------------------------------------------------


def encode_block(ids: np.ndarray, table: Frequencies, lanes: int = LANES) -> bytes:
    """Frame of ``ids``; coded from the last step to the first, so that decoding runs forwards."""
    n = len(ids)
    steps = -(-n // lanes)
    state = np.full(lanes, LOW, np.uint64)
    words: list[np.ndarray] = []
    marks: list[tuple[int, int, np.ndarray]] = []
    count = 0
    for step in range(steps - 1, -1, -1):
        row = ids[step * lanes : (step + 1) * lanes].astype(np.int64)
        k = len(row)
        freq = table.freq[row]
        own = state[:k]
        # A state that would leave its range gives its low word away first.
        full = own >= freq << np.uint64(63 - BITS)
        if full.any():
            # The decoder takes words in lane order, so they go out in reverse.
            out = (own[full] & np.uint64(0xFFFFFFFF)).astype("<u4")[::-1]
            words.append(out)
            count += len(out)
            own = np.where(full, own >> np.uint64(32), own)
        state[:k] = ((own // freq) << np.uint64(BITS)) + own % freq + table.start[row]
        if step % CHECKPOINT == 0 and step:
            marks.append((step, count, state.copy()))
    body = (np.concatenate(words)[::-1] if words else np.zeros(0, "<u4")).astype("<u4")
    head = np.array(
        [lanes, n, len(marks), len(body), zlib.crc32(ids.astype("<u4").tobytes())], "<u4"
    )
    parts = [MAGIC, head.tobytes(), state.astype("<u8").tobytes()]
    for step, at, states in reversed(marks):
        parts += [np.array([step, count - at], "<u4").tobytes(), states.astype("<u8").tobytes()]
    return b"".join([*parts, body.tobytes()])


def decode_block(frame: bytes, table: Frequencies, first: int = 0, last: int | None = None):
    """Ids of a frame; ``first`` and ``last`` bound the segments between checkpoints to decode.

    Segments are independent of each other. The checksum covers the whole block and is verified
    when the whole block is read.
    """
    if frame[:4] != MAGIC:
        raise ValueError("not a block of token ids")
    lanes, n, marks, count, crc = np.frombuffer(frame, "<u4", 5, 4).tolist()
    at = 24
    points = [(0, 0, np.frombuffer(frame, "<u8", lanes, at))]
    at += 8 * lanes
    for _ in range(marks):
        step, word = np.frombuffer(frame, "<u4", 2, at).tolist()
        points.append((step, word, np.frombuffer(frame, "<u8", lanes, at + 8)))
        at += 8 + 8 * lanes
    words = np.frombuffer(frame, "<u4", count, at)
    steps = -(-n // lanes)
    last = len(points) if last is None else last
    stop = points[last][0] if last < len(points) else steps
    begin, word, state = points[first]
    state = state.copy()
    out = np.empty((stop - begin) * lanes, np.uint32)
    mask = np.uint64((1 << BITS) - 1)
    for step in range(begin, stop):
        k = min(lanes, n - step * lanes)
        own = state[:k]
        slot = own & mask
        symbol = table.symbol[slot]
        out[(step - begin) * lanes : (step - begin) * lanes + k] = symbol
        own = table.freq[symbol] * (own >> np.uint64(BITS)) + slot - table.start[symbol]
        low = np.flatnonzero(own < LOW)
        own[low] = (own[low] << np.uint64(32)) | words[word : word + len(low)]
        word += len(low)
        state[:k] = own
    out = out[: min(n, stop * lanes) - begin * lanes]
    # A whole block ends in the states that its coders began with.
    whole = first == 0 and last == len(points)
    if whole and ((state != LOW).any() or word != count):
        raise ValueError("a block of token ids is damaged")
    if whole and zlib.crc32(out.astype("<u4").tobytes()) != crc:
        raise ValueError("a block of token ids is damaged")
    return out


# ---- Spark ----------------------------------------------------------------------------------


def _tokenizer(path: str) -> tuple:
    if path not in _tokenizers:
        # A task has one core; threads of the library would only contend for it.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, normalizers

        tokenizer = Tokenizer.from_file(path)

        def ids(text: str) -> list[int]:
            return tokenizer.encode(text, add_special_tokens=False).ids

        upper, lower = string.ascii_uppercase, string.ascii_lowercase
        folds = all(ids(a) == ids(b) for a, b in zip(upper, lower))
        others = [c for c in string.punctuation + string.digits if c != "'"]
        # "ab" is one id or more by itself, and so for every run of letters: a character that ends
        # such runs leaves them as they are.
        finer = folds and all(ids(f"ab{c}ab") == [*ids("ab"), *ids(c), *ids("ab")] for c in others)
        # A character that is one id wherever it stands alone: it parts words of a joined text.
        marks = [
            c for c in SEPARATORS
            if len(ids(c)) == 1 and ids(f"a {c} {c} b") == ids("a") + 2 * ids(c) + ids("b")
        ]
        mark = (marks[0], ids(marks[0])[0]) if marks else None
        # Words of a-z are what normalizing gives back; they need no more than that it ends.
        quick = Tokenizer.from_file(path)
        quick.normalizer = normalizers.Lowercase()
        pairs = [f"{a}{b}" for a in lower for b in lower]
        same = finer and mark and ids(" ".join(pairs)) == quick.encode(" ".join(pairs), add_special_tokens=False).ids
        _tokenizers[path] = tokenizer, quick if same else tokenizer, [{}, {}], folds, finer, mark
    return _tokenizers[path]


def _coded(tokenizer, mark: tuple[str, int] | None, words: list[bytes]) -> Iterator[bytes]:
    """Ids of every word as little-endian 32-bit integers; many words are encoded as one text."""

    def by_itself(some: list[str]) -> Iterator[bytes]:
        for coded in tokenizer.encode_batch_fast(some, add_special_tokens=False):
            yield np.array(coded.ids, "<u4").tobytes()

    for low in range(0, len(words), 10_000):
        part = [w.decode() for w in words[low : low + 10_000]]
        groups = [part[i : i + JOINED] for i in range(0, len(part), JOINED)]
        if mark is None:
            yield from by_itself(part)
            continue
        joined = [f" {mark[0]} ".join(g) for g in groups]
        for own, coded in zip(
            groups, tokenizer.encode_batch_fast(joined, add_special_tokens=False), strict=True
        ):
            ids = np.array(coded.ids, "<u4")
            ends = np.append(np.flatnonzero(ids == mark[1]), len(ids))
            if len(ends) != len(own):  # a word holds the separator itself
                yield from by_itself(own)
                continue
            body, starts = ids.tobytes(), np.append(0, ends[:-1] + 1)
            for a, b in zip((4 * starts).tolist(), (4 * ends).tolist()):
                yield body[a:b]


def ids_of(texts: pa.Array | list[str | None], path: str, end: int) -> list[np.ndarray]:
    """Ids of every text and the end id.

    This tokenizer drops white space and never joins what it parts, so a text's ids are those of its
    parts, and every distinct part is encoded once. It parts ASCII letters, digits and punctuation as
    well (``CUTS``). Where it ignores the case of A-Z, parts that differ in it are one; combining
    marks, which may compose with one case only, forbid that, and so does ``<|``, which may begin a
    special token (of one case, and of letters and punctuation).
    """
    tokenizer, quick, generations, folds, finer, mark = _tokenizer(path)
    column = texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string())
    out = []
    for _, data, offsets in bodies(column, TEXT_BYTES):
        # Bytes part at ASCII white space at least, all of which the tokenizer drops.
        border = changes(SPACE[data])
        if folds:
            special = np.flatnonzero((data[:-1] == ord("<")) & (data[1:] == ord("|")))
            marks = np.flatnonzero((data == 0xCC) | (data == 0xCD))
            whole = _outside(offsets, np.append(special, marks))
            data = np.where(whole, LOWER[data], data)
            if finer:
                kind = KINDS[data]
                border[1:] |= CUTS.ravel()[6 * kind[:-1] + kind[1:]] & whole[1:]
        at, words, first = distinct_spans(data, offsets, border)
        if len(generations[0]) > REMEMBERED:
            # What the next texts use again moves over from the old generation, the rest goes with it.
            generations[:] = {}, generations[0]
        known, old = generations
        missing = [w for w in words if w not in known]
        known.update((w, old[w]) for w in missing if w in old)
        new = [w for w in missing if w not in known]
        plain, rest = [], []
        for w in new:
            if not w.strip():
                known[w] = b""
            else:
                (plain if w.isalpha() and w.islower() else rest).append(w)
        # Neighbours in the alphabet are alike, which suits the library's tables.
        plain.sort()
        known.update(zip(plain, _coded(quick, mark, plain), strict=True))
        known.update(zip(rest, _coded(tokenizer, mark, rest), strict=True))
        ids, length = gathered([known[w] for w in words], at)
        ends = np.append(0, np.cumsum(length))[first]
        out += [np.append(ids[a:b], np.uint32(end)) for a, b in zip(ends[:-1], ends[1:])]
    return out


def _outside(offsets: np.ndarray, places: np.ndarray) -> np.ndarray:
    """For every byte whether its text holds none of ``places``."""
    held = np.zeros(len(offsets) - 1, bool)
    held[np.searchsorted(offsets, places, "right") - 1] = True
    return np.repeat(~held, np.diff(offsets))


_CHUNK = pa.schema(
    [
        ("part", pa.int64()),
        ("number", pa.int32()),
        ("n_ids", pa.int64()),
        ("docs", pa.binary()),
        ("lengths", pa.binary()),
        ("ids", pa.binary()),
    ]
)


def _chunks(path: str, end: int, block_ids: int):
    """Documents in order -> chunks of about ``block_ids`` ids; a document is not divided."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number = None, 0
        docs: list[int] = []
        held: list[np.ndarray] = []

        def chunk() -> pa.RecordBatch:
            lengths = np.array([len(h) for h in held], "<i8")
            body = np.concatenate(held)
            kind = "<u2" if body.max() < 1 << 16 else "<u4"
            row = {
                "part": [part],
                "number": [number],
                "n_ids": [len(body)],
                "docs": [np.array(docs, "<i8").tobytes()],
                "lengths": [lengths.tobytes()],
                "ids": [kind[1:].encode() + body.astype(kind).tobytes()],
            }
            return pa.RecordBatch.from_pydict(row, _CHUNK)

        size = 0
        for batch in batches:
            for low in range(0, len(batch), 2000):
                piece = batch.slice(low, 2000)
                ids = piece.column("doc_id").fill_null(NO_ID).to_pylist()
                coded = ids_of(piece.column("text"), path, end)
                for doc, own in zip(ids, coded):
                    part = doc if part is None else part
                    docs.append(doc)
                    held.append(own)
                    size += len(own)
                    if size >= block_ids:
                        yield chunk()
                        number, size, docs, held = number + 1, 0, [], []
        if held:
            yield chunk()

    return run


def _chunk_ids(body: bytes) -> np.ndarray:
    return np.frombuffer(body, "<" + body[:2].decode(), offset=2)


def _frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    seen = np.zeros(1, np.int64)
    for batch in batches:
        for body in batch.column("ids"):
            own = np.bincount(_chunk_ids(body.as_py()), minlength=len(seen))
            own[: len(seen)] += seen
            seen = own
    at = np.flatnonzero(seen)
    yield pa.RecordBatch.from_arrays(
        [pa.array(at.astype(np.int64)), pa.array(seen[at])], ["id", "n"]
    )


def _encode(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = Frequencies(shared.value)
        for batch in batches:
            frames = [encode_block(_chunk_ids(b.as_py()), table) for b in batch.column("ids")]
            names = ["part", "number", "n_ids", "docs", "lengths"]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in names], pa.array(frames, pa.binary())],
                [*names, "frame"],
            )

    return run


def _decode(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = Frequencies(shared.value)
        for batch in batches:
            for row in batch.to_pylist():
                ids = decode_block(row["frame"], table).astype("<u4")
                lengths = np.frombuffer(row["lengths"], "<i8")
                ends = np.cumsum(lengths)
                body = memoryview(ids.tobytes())
                crcs = [
                    zlib.crc32(body[4 * (e - n) : 4 * e]) for e, n in zip(ends, lengths)
                ]
                docs = np.frombuffer(row["docs"], "<i8")
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(docs, mask=docs == NO_ID),
                        pa.array(ends - lengths + row["first"]),
                        pa.array(lengths),
                        pa.array(crcs, pa.int64()),
                    ],
                    ["doc_id", "start", "n_tokens", "ids_crc32"],
                )

    return run


def write_ids(
    docs: DataFrame, tokenizer_path: str, end: int = END_ID, block_ids: int = BLOCK_IDS
) -> tuple[DataFrame, np.ndarray]:
    """Write the ids of all documents as blocks; returns the table of blocks and the frequencies.

    Documents are ordered by doc_id (rows that repeat one by their text); each text is followed by
    the end id, and a null text has that one only. Rows without doc_id come first; the least 64-bit
    number stands for it in the file and is no doc_id of its own. The frequencies count every id of every document; the
    driver holds one number for each id of the vocabulary.
    """
    from tokenizers import Tokenizer

    spark = docs.sparkSession
    size = max(Tokenizer.from_file(tokenizer_path).get_vocab_size(), end + 1)
    ordered = docs.select("doc_id", "text").repartitionByRange("doc_id").sortWithinPartitions(
        "doc_id", "text"
    )
    chunks = written(
        ordered.mapInArrow(
            _chunks(tokenizer_path, end, block_ids),
            "part long, number int, n_ids long, docs binary, lengths binary, ids binary",
        ),
        "ids",
    )
    rows = (
        chunks.select("ids").mapInArrow(_frequencies, "id long, n long")
        .groupBy("id").agg(F.sum("n").alias("n")).toArrow()
    )
    counts = np.zeros(size, np.int64)
    counts[rows["id"].to_numpy()] = rows["n"].to_numpy()
    freq = scaled(counts)
    blocks = chunks.mapInArrow(
        _encode(spark.sparkContext.broadcast(freq)),
        "part long, number int, n_ids long, docs binary, lengths binary, frame binary",
    )
    return written(blocks, "blocks"), freq


def read_ids(blocks: DataFrame, freq: np.ndarray) -> DataFrame:
    """Per document, from the blocks: doc_id, start, n_tokens, ids_crc32."""
    # Parts are ranges of doc_id, one for each partition written; blocks are numbered inside.
    parts = blocks.groupBy("part").agg(F.sum("n_ids").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    inside = (
        Window.partitionBy("part").orderBy("number").rowsBetween(Window.unboundedPreceding, -1)
    )
    # Offsets are found on the numbers alone; frames are not shuffled for them.
    offsets = blocks.select(
        "part", "number", F.coalesce(F.sum("n_ids").over(inside), F.lit(0)).alias("inside")
    ).join(parts, "part").select("part", "number", (F.col("base") + F.col("inside")).alias("first"))
    return (
        blocks.join(offsets, ["part", "number"])
        .select("first", "docs", "lengths", "frame")
        .mapInArrow(
            _decode(blocks.sparkSession.sparkContext.broadcast(freq)),
            "doc_id long, start long, n_tokens long, ids_crc32 long",
        )
    )


def op8_token_blocks(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = public_tokenizers.path("word_bpe_49k.json")
    return read_ids(*write_ids(documents(spark, sf_dir), path))


# No SQL states a tokenizer; tests compare with the library's ids and read damaged blocks.
QUERIES = {"op8_token_blocks": op8_token_blocks}
ORACLES: dict[str, str] = {}
