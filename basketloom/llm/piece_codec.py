"""SentencePiece encoding and decoding by shared-prefix Viterbi.

A text is cut where no piece of the vocabulary reaches over the border: before marked words
(``\\u2581word``), and between letters and most punctuation. The distinct words of a task are sorted, which lays them out as a depth-first walk of their
trie: the forward table (best score and last piece for every prefix) is kept up to the prefix that a
word shares with the one before it, and only the rest is computed.

The vocabulary is a merge (BPE) model: the segmentation that SentencePiece defines for it is the one
in which any two neighbouring pieces are what merging their joined text gives. Steps of the search
are limited to such neighbours; the first and the last piece of every prefix are then unique, and
the best path is SentencePiece's own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from .shared import bodies, distinct_spans, documents, gathered

MARK = "\u2581"
# Distinct words, and pairs of pieces, in each of the two generations that a task remembers.
REMEMBERED = 150_000
# Bytes of texts whose words are looked up together.
TEXT_BYTES = 4 << 20
# Marks in the table of prefixes: a piece not yet looked at, no standing piece.
UNSEEN, PASSING = object(), object()
_loaded: dict[str, Codec] = {}


class Codec:
    """Pieces of a model file; words met so far with their ids."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.ids: dict[str, int] = {}
        self.scores: dict[str, float] = {}
        self.bytes_of: list[bytes] = []
        self.byte_ids = [0] * 256
        for i in range(model.get_piece_size()):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                value = int(piece[3:5], 16)
                self.byte_ids[value] = i
                self.bytes_of.append(bytes([value]))
            elif model.is_control(i) or model.is_unknown(i):
                self.bytes_of.append(b"")
            else:
                self.ids[piece] = i
                self.scores[piece] = model.get_score(i)
                self.bytes_of.append(piece.replace(MARK, " ").encode())
        if any(MARK in p.lstrip(MARK) for p in self.ids):
            raise ValueError("a piece reaches over the start of a word")
        # Bytes that stand next to each other in some piece (a blank for the mark). A text parts for
        # certain where no piece has the two bytes side by side; characters are never divided.
        self.joins = np.zeros((256, 256), bool)
        self.joins[:, 0x80:0xC0] = True
        for piece in self.ids:
            body = np.frombuffer(piece.replace(MARK, " ").encode(), np.uint8)
            self.joins[body[:-1], body[1:]] = True
        self.words: dict[bytes, bytes] = {}
        self.old_words: dict[bytes, bytes] = {}
        self.pairs: dict[tuple[str, str], bool] = {}
        self.old_pairs: dict[tuple[str, str], bool] = {}
        # Prefixes of pieces: score of a piece that merging its characters gives back, or a mark.
        self.prefixes = {p[:n]: PASSING for p in self.ids for n in range(1, len(p))}
        self.prefixes.update(dict.fromkeys(self.ids, UNSEEN))

    def merged(self, text: str) -> list[str]:
        """Pieces of a short text by merging: highest score first, then leftmost."""
        parts = list(text)
        while len(parts) > 1:
            joined = [a + b for a, b in zip(parts, parts[1:])]
            known = [(-self.scores[j], i) for i, j in enumerate(joined) if j in self.scores]
            if not known:
                break
            at = min(known)[1]
            parts[at : at + 2] = [joined[at]]
        return parts

    def follows(self, last: str, piece: str) -> bool:
        """Whether merging the joined text of two pieces gives the two back."""
        key = last, piece
        known = self.old_pairs.get(key)
        if known is None:
            known = self.merged(last + piece) == [last, piece]
        if len(self.pairs) > REMEMBERED:
            self.pairs, self.old_pairs = {}, self.pairs
        self.pairs[key] = known
        return known

    def standing(self, piece: str) -> object:
        """Score of a piece that merging its characters gives back, else ``PASSING``."""
        whole = self.merged(piece) == [piece]
        score = self.prefixes[piece] = self.scores[piece] if whole else PASSING
        return score

    def learn(self, words: list[str]) -> None:
        """Segment sorted distinct words; the forward table is reused along shared prefixes.

        A prefix has one last piece that fits: once it is found, shorter ones are not tried, and
        where no longer piece fits it is the last character.
        """
        known_prefix, known_pair = self.prefixes.get, self.pairs.get
        last: list[str] = [""]
        total: list[float] = [0.0]
        # Starts from which a prefix of a piece reaches the end of the word so far.
        open_at: list[list[int]] = [[]]
        before = ""
        for word in words:
            shared = 0
            for a, b in zip(word, before):
                if a != b:
                    break
                shared += 1
            del last[shared + 1 :], total[shared + 1 :], open_at[shared + 1 :]
            for end in range(shared + 1, len(word) + 1):
                best, best_score = "", 0.0
                still: list[int] = []
                for start in open_at[-1]:
                    piece = word[start:end]
                    score = known_prefix(piece)
                    if score is None:
                        continue
                    still.append(start)
                    if best or score is PASSING:
                        continue
                    if score is UNSEEN:
                        score = self.standing(piece)
                        if score is PASSING:
                            continue
                    if start:
                        fits = known_pair((last[start], piece))
                        if fits is None:
                            fits = self.follows(last[start], piece)
                            known_pair = self.pairs.get
                        if not fits:
                            continue
                    best, best_score = piece, total[start] + score
                single = word[end - 1]
                if known_prefix(single) is not None:
                    still.append(end - 1)
                if not best:
                    # A character always stands, as bytes where it is no piece.
                    best, best_score = single, total[end - 1] + self.scores.get(single, 0.0)
                total.append(best_score)
                last.append(best)
                open_at.append(still)
            found: list[int] = []
            end = len(word)
            while end:
                piece = last[end]
                known = self.ids.get(piece)
                if known is None:
                    found += [self.byte_ids[b] for b in reversed(piece.encode())]
                else:
                    found.append(known)
                end -= len(piece)
            self.words[word.replace(MARK, " ").encode()] = np.array(found[::-1], np.int32).tobytes()
            before = word

    def encode(self, texts: pa.Array | list[str | None]) -> list[np.ndarray]:
        """Ids of every text as 32-bit integers; none for a null or empty text."""
        column = texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string())
        # A text begins with a mark; marks are blanks until their words are learnt.
        text = pc.replace_substring(column.cast(pa.large_string()).fill_null(""), MARK, " ")
        blank, none = (pa.scalar(x, pa.large_string()) for x in (" ", ""))
        text = pc.if_else(pc.equal(text, none), none, pc.binary_join_element_wise(blank, text, none))
        out = []
        for _, data, offsets in bodies(text, TEXT_BYTES):
            border = np.zeros(len(data), bool)
            border[1:] = ~self.joins.ravel()[256 * data[:-1].astype(np.int32) + data[1:]]
            at, cut, first = distinct_spans(data, offsets, border)
            if len(self.words) > REMEMBERED:
                # What the next texts use again moves over from the old generation.
                self.words, self.old_words = {}, self.words
            words, old = self.words, self.old_words
            missing = [w for w in cut if w not in words]
            words.update((w, old[w]) for w in missing if w in old)
            self.learn(sorted(w.decode().replace(" ", MARK) for w in missing if w not in old))
            ids, length = gathered([words[w] for w in cut], at)
            ends = np.append(0, np.cumsum(length))[first]
            out += [ids[a:b].view(np.int32) for a, b in zip(ends[:-1], ends[1:])]
        return out

    def decode(self, ids: list[int]) -> str:
        table = self.bytes_of
        body = b"".join([table[i] for i in ids])
        return body[1:].decode(errors="replace") if body[:1] == b" " else body.decode(errors="replace")


def codec(path: str) -> Codec:
    """The codec of a model file, kept for the next task of this worker."""
    if path not in _loaded:
        _loaded[path] = Codec(path)
    return _loaded[path]


def _encode(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(path)
        for batch in batches:
            for low in range(0, len(batch), 2000):
                part = batch.slice(low, 2000)
                coded = c.encode(part.column("text"))
                flat = np.concatenate(coded)
                ends = np.cumsum([0, *map(len, coded)]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"),
                        pa.array(np.diff(ends).astype(np.int64)),
                        pa.ListArray.from_arrays(pa.array(ends), pa.array(flat)),
                    ],
                    ["doc_id", "n_tokens", "ids"],
                )

    return run


def _decode(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(path)
        for batch in batches:
            for low in range(0, len(batch), 200):
                part = batch.slice(low, 200)
                texts = [c.decode(ids.values.to_pylist()) if ids.is_valid else "" for ids in part.column("ids")]
                yield part.append_column("decoded", pa.array(texts, pa.string()))

    return run


def encode(docs: DataFrame, model_path: str) -> DataFrame:
    """Per row: doc_id, n_tokens, ids.

    A null or empty text has no ids; characters outside the vocabulary become byte pieces; repeated
    rows are encoded alike; other columns are ignored. Words of any length are searched whole.
    """
    return docs.select("doc_id", "text").mapInArrow(
        _encode(model_path), "doc_id long, n_tokens long, ids array<int>"
    )


def decode(encoded: DataFrame, model_path: str) -> DataFrame:
    """``encoded`` (doc_id, n_tokens, ids) with the text its ids stand for; null ids give ''.

    The text is the input of the encoding, but for U+2581, which comes back as a blank.
    """
    schema = StructType([*encoded.schema.fields, StructField("decoded", StringType())])
    return encoded.mapInArrow(_decode(model_path), schema)


def default_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def op4_sentencepiece(spark, sf_dir: str) -> DataFrame:
    """Ids of every document, and the digest of the text decoded from them."""
    path = default_model()
    coded = decode(encode(documents(spark, sf_dir), path), path)
    return coded.select("doc_id", "n_tokens", "ids", F.sha2("decoded", 256).alias("decoded_sha256"))


# No SQL states the search; tests hold it against the library's own encoder and a round trip.
QUERIES = {"op4_sentencepiece": op4_sentencepiece}
ORACLES: dict[str, str] = {}
