"""Each operator against a direct version on small tables with awkward rows."""

from __future__ import annotations

import math
import zlib

import duckdb
import numpy as np
import pytest

pytest.importorskip("basketloom.llm")

import corpus_pipeline
from basketloom.llm import (
    decontamination,
    language_id,
    merkle,
    ngram_jaccard,
    piece_codec,
    quotes,
    substring_dedup,
    suffix_tree_lm,
    token_blocks,
    wrapper,
)

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, n_words string"


def lines(words, seed):
    rng = np.random.default_rng(seed)
    return " ".join(rng.choice(words, 90))


VOCABULARY = [f"w{i}" for i in range(400)]


@pytest.fixture(scope="module")
def texts():
    """Nulls, empty and blank texts, ties, copies, near copies, shared passages, a long text."""
    base = lines(VOCABULARY, 1)
    near = base.replace(base.split()[40], "changed", 1)
    shared = lines(VOCABULARY, 2)
    return [
        (1, base), (2, base), (2, base), (3, near), (4, None), (5, ""), (6, " \t\n"),
        (7, "one"), (8, "ONE"), (9, lines(VOCABULARY, 3) + " " + shared),
        (10, shared + "\n" + lines(VOCABULARY, 4)), (10, "other text under the same id"),
        (11, "a b " * 300), (12, "Ünï çödé 漢字 🙂 " + lines(VOCABULARY, 5) * 30),
        (None, lines(VOCABULARY, 6)), (13, "x\x0by\x0cz w"), (14, "tail\n\nof > lines\n"),
    ]


@pytest.fixture(scope="module")
def docs(spark, texts):
    rows = [(i, t, "en", None, None if t is None else len(t), "clash") for i, t in texts]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def split(text):
    return (text or "").encode().split()


def test_substring_dedup(docs, texts, empty):
    first = {}
    for i, t in texts:
        for k in range(len(split(t)) - 49):
            key = tuple(split(t)[k : k + 50])
            if i is not None:
                first[key] = min(first.get(key, i), i)
    expected = []
    for i, t in texts:
        words = split(t)
        keep = [True] * len(words)
        for k in range(len(words) - 49):
            if i is not None and first[tuple(words[k : k + 50])] < i:
                keep[k : k + 50] = [False] * 50
        kept = b" ".join(w for w, x in zip(words, keep) if x)
        expected.append((i, len(words), len(words) - sum(keep), kept.decode()))
    for hot in (1, 2048):  # every minimiser cut into single windows, and none
        got = substring_dedup.remove_repeats(docs, hot=hot).drop("row_key").collect()
        assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, expected))
    assert substring_dedup.remove_repeats(empty).count() == 0


def test_first_seen_survives_equal_hashes(monkeypatch):
    packed = [b"a b c", b"b c d", b"x b c"]
    expected = substring_dedup.first_seen(packed, np.array([5, 3, 9]), 2)[1].tolist()
    monkeypatch.setattr(substring_dedup, "span_hashes", lambda v, s, e: np.zeros(len(s), np.uint64))
    assert substring_dedup.first_seen(packed, np.array([5, 3, 9]), 2)[1].tolist() == expected
    assert expected == [5, 3, 3, 3, 9, 3]


def components(texts, width=5):
    sets = []
    for _, t in texts:
        w = (t or "").encode().lower().split()
        sets.append({tuple(w[k : k + width]) for k in range(max(1, len(w) - width + 1))} if w else set())
    label = list(range(len(texts)))
    for _ in texts:
        for a in range(len(texts)):
            for b in range(len(texts)):
                if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                    label[a] = label[b] = min(label[a], label[b])
    out = []
    for k, (i, _) in enumerate(texts):
        ids = [texts[j][0] for j in range(len(texts)) if label[j] == label[k] and texts[j][0] is not None]
        out.append((i, len(sets[k]), min(ids, default=None)))
    return out


def test_ngram_jaccard(docs, texts, empty):
    got = ngram_jaccard.join_similar(docs).drop("row_key", "group").collect()
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, components(texts)))
    assert ngram_jaccard.join_similar(empty).count() == 0
    kept = sorted(r.doc_id for r in ngram_jaccard.keep_one(docs).collect() if r.doc_id)
    assert kept == [1, 4, 5, 6, 7, 9, 10, 10, 11, 12, 13, 14]


def test_ngram_jaccard_chain_without_hub(spark):
    """a ~ b ~ c, a and c apart; many copies of a common passage that must not link."""
    words = [f"t{i}" for i in range(104)]
    rows = [(k, " ".join(words[k : k + 64])) for k in (0, 6, 12)]
    common = " ".join(words[70:90])
    rows += [(100 + k, common + " " + lines(VOCABULARY, 50 + k)) for k in range(40)]
    got = {
        r.doc_id: r.component_id
        for r in ngram_jaccard.join_similar(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    }
    assert got == {i: c for i, _, c in components(rows)}
    assert got[12] == 0


def test_ngram_jaccard_pairs_of_a_large_group(spark, monkeypatch):
    """Variants of a text that are not similar met once for each two of them and each shingle they share."""
    kept, write = {}, ngram_jaccard.written

    def noted(df, name):
        kept[name] = write(df, name)
        return kept[name]

    monkeypatch.setattr(ngram_jaccard, "written", noted)
    base = [f"b{i}" for i in range(150)]
    rows = []
    for k in range(120):
        rng = np.random.default_rng(k)
        text = list(base)
        for i in rng.choice(150, 7, replace=False):
            text[i] = f"x{k}_{i}"
        rows.append((k, " ".join(text)))
    rows += [(200, rows[5][1] + " more"), (201, rows[9][1] + " more")]
    got = ngram_jaccard.join_similar(spark.createDataFrame(rows, "doc_id long, text string"))
    got = [tuple(r) for r in got.drop("row_key", "group").collect()]
    assert sorted(got) == sorted(map(tuple, components(rows)))
    sketched = kept["prefixes"].select("class", *ngram_jaccard.SKETCH)
    pairs = ngram_jaccard.meetings(kept["placed"], sketched, 80)
    met = pairs.count()
    monkeypatch.setattr(ngram_jaccard, "CROWDED", 1 << 30)
    assert met * 10 < ngram_jaccard.meetings(kept["placed"], sketched, 80).count()


def test_ngram_jaccard_sketches_differ_in_no_more_bits_than_the_sets():
    rng = np.random.default_rng(2)
    for n, more in ((1, 0), (40, 3), (900, 70)):
        x = rng.integers(0, 1 << 63, n).astype(np.uint64)
        y = np.append(x[min(n - 1, more) :], rng.integers(0, 1 << 63, more).astype(np.uint64))
        owner = np.repeat([0, 1], [len(x), len(y)])
        a, b = ngram_jaccard.sketches(np.append(x, y), owner, 3)[:2]
        differ = sum(int(v).bit_count() for v in (a ^ b).view(np.uint64))
        assert differ <= len(np.setxor1d(x, y)) and (differ > 0) == (more > 0)


def test_decontamination(spark, docs, texts, empty):
    items = [(1, " ".join(texts[0][1].split()[5:25]).upper()), (1, "ONE"), (2, None), (3, "!!"), (4, "absent words here")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    con = duckdb.connect()
    con.execute("create table documents (doc_id bigint, text varchar)")
    con.execute("create table benchmark (item_id bigint, text varchar)")
    con.executemany("insert into documents values (?, ?)", [list(x) for x in texts])
    con.executemany("insert into benchmark values (?, ?)", [list(x) for x in items])
    expected = con.execute(
        "select doc_id, n_words, n_hit, n_items, contaminated from (" + decontamination.ORACLES["op6_decontamination"] + ")"
    ).fetchall()
    for block in (3, 200_000):  # many blocks of windows, and one
        found = decontamination.mark_leaks(docs, bench, block=block).select(
            "doc_id", "n_words", "n_hit", "n_items", "contaminated"
        )
        got = sorted(map(repr, map(tuple, found.collect())))
        assert got == sorted(map(repr, expected))
    assert decontamination.mark_leaks(empty, bench).count() == 0
    assert not any(r.contaminated for r in decontamination.mark_leaks(docs, bench.limit(0)).collect())


def test_decontamination_cuts_texts_once(docs, capsys):
    # Words were cut again for their rarity, for their places and for their number.
    words, _, _ = decontamination.find_leaks(docs, docs.selectExpr("doc_id AS item_id", "text").limit(3))
    words.explain()
    assert "split(" not in capsys.readouterr().out


def test_language_id(spark, docs, empty):
    rows = [(i, " ".join(np.random.default_rng(i).choice(w, 60)), lang) for i in range(120)
            for lang, w in (("aa", ["tha", "thin", "shon"]), ("bb", ["que", "cion", "ñado"]))]
    table = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language_id.train(table.where("doc_id < 100"))
    probe = table.where("doc_id >= 100").unionByName(
        spark.createDataFrame([(900, None, None), (901, "123 !!", None), (902, "zzxqj kkvvw " * 9, None)], table.schema)
    )
    got = language_id.identify(probe, model).select("doc_id", "lang", "language.*").collect()
    assert all(r.lang_pred == r.lang and not r.rejected for r in got if r.lang)
    assert all(0 <= r.score <= 1 for r in got)
    assert {r.doc_id for r in got if r.lang_pred == "und"} == {900, 901}
    assert {r.doc_id for r in got if r.rejected} == {900, 901, 902}
    assert language_id.train(empty) is None
    assert {r.language.lang_pred for r in language_id.identify(docs, None).collect()} == {"und"}
    p = [np.exp(model.score([w])).sum() for w in ("tha", "que")]
    assert all(0 < x <= 2 for x in p)


def test_suffix_tree_lm(spark, docs, texts, empty):
    from pyspark.sql import functions as F

    got = suffix_tree_lm.score_texts(docs, F.coalesce(F.col("doc_id") < 12, F.lit(False))).collect()
    from collections import Counter

    seen = Counter(t for i, x in texts if i is not None and i < 12 for t in suffix_tree_lm.tokens(x))
    n, v = sum(seen.values()), len(seen)
    expected = Counter()
    for i, x in texts:
        own = suffix_tree_lm.tokens(x)
        base = sum(math.log10((seen[t] + 0.5) / (n + 0.5 * (v + 1))) for t in own)
        expected[i, len(own), sum(seen[t] > 0 for t in own), round(base, 6)] += 1
    assert Counter((r.doc_id, r.n_tokens, r.n_known, round(r.base_score, 6)) for r in got) == expected
    assert all(r.train_tokens == n and r.score < 0 for r in got)
    assert suffix_tree_lm.score_texts(empty, F.lit(True)).count() == 0


def test_suffix_tree_is_a_distribution():
    counts = {b"": {97: 6, 98: 3, 32: 5}, b"a": {97: 1, 98: 30}, b" ": {97: 9}, b"b": {32: 4}}
    tree = suffix_tree_lm.SuffixTree(counts, 0.0, 1.0)
    assert np.allclose((10.0 ** tree.log.astype(float)).sum(axis=1), 1, atol=1e-4)
    text = np.frombuffer(b"ab ab b" * 300, np.uint8)
    state, slow = 0, []
    for c in text:
        slow.append(tree.log[state, c])
        state = tree.step[state, c]
    assert np.allclose(tree.walk(text, 4)[4:], slow[4:])


def test_piece_codec(spark, docs, texts):
    import sentencepiece

    path = piece_codec.default_model()
    library = sentencepiece.SentencePieceProcessor(model_file=path)
    got = piece_codec.decode(piece_codec.encode(docs, path), path).collect()
    expected = sorted((repr(i), library.encode(t or ""), t or "") for i, t in texts)
    assert sorted((repr(r.doc_id), r.ids, r.decoded) for r in got) == expected


def test_merkle(spark, docs, texts, empty):
    con = duckdb.connect()
    con.execute("create table documents (doc_id bigint, text varchar)")
    unique = {i: t for i, t in texts if i is not None}
    con.executemany("insert into documents values (?, ?)", [[i, t] for i, t in unique.items()])
    frame = spark.createDataFrame(list(unique.items()), "doc_id long, text string")
    expected = dict(con.execute(
        "select doc_id, nxt from (select doc_id, coalesce(text,'') t, coalesce(lead(coalesce(text,'')) over (order by doc_id desc),"
        " first_value(coalesce(text,'')) over (order by doc_id desc)) nxt from documents)").fetchall())
    got = {r.doc_id: r.next_text for r in merkle.with_next(frame, block_rows=3).collect()}
    assert got == expected
    assert merkle.with_next(docs).count() == len(texts)
    far = [(-1, "a"), (-2, "b"), (-3, "c"), (2**62, "d"), (2**62 + 1, "e"), (2**62 + 2, "f")]
    rows = merkle.with_next(spark.createDataFrame(far, "doc_id long, text string"), 2).collect()
    order = sorted(far, reverse=True)
    follows = {i: order[(k + 1) % len(order)][1] for k, (i, _) in enumerate(order)}
    assert {r.doc_id: r.next_text for r in rows} == follows
    bare = [(None, "x"), (None, "y"), (None, None), (5, "z")]
    rows = merkle.with_next(spark.createDataFrame(bare, "doc_id long, text string"), 2).collect()
    assert sorted((r.text, r.next_text is not None) for r in rows) == [("", True), ("x", True), ("y", True), ("z", True)]
    assert merkle.with_next(empty).count() == 0


def test_merkle_locates_edits(spark):
    from pyspark.sql import functions as F

    a = "\n".join(f"line {i} with some words" for i in range(40))
    b = a.replace("line 17 with", "line seventeen with")
    row = spark.createDataFrame([(a, b)], "a string, b string").select(
        merkle.fingerprint(F.col("a")).alias("a"), merkle.fingerprint(F.col("b")).alias("b")
    )
    got = row.select(
        merkle.differing_paragraphs(F.col("a"), F.col("b")).alias("d"),
        merkle.differing_paragraphs(F.col("a"), F.col("a")).alias("n"),
    ).first()
    assert got.d == [17] and got.n == []


def test_token_blocks(spark, docs, texts):
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    library = Tokenizer.from_file(path)
    more = docs.limit(1).selectExpr("CAST(NULL AS long) AS doc_id", "CAST(NULL AS string) AS text")
    given = docs.select("doc_id", "text").union(more)
    got = token_blocks.read_ids(*token_blocks.write_ids(given, path, block_ids=500)).collect()
    # Rows without doc_id come first; a null text before the others of an id.
    rows = [*texts, (None, None)]
    ordered = sorted(((i, t or "") for i, t in rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    start, expected = 0, []
    for i, t in ordered:
        ids = np.array([*library.encode(t, add_special_tokens=False).ids, 2], "<u4")
        expected.append((i, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, expected))


@pytest.mark.parametrize("n", [0, 1, 1023, 1024, 1025, 300_000])
def test_block_round_trip(n):
    ids = np.minimum(np.random.default_rng(n).zipf(1.3, n), 49_999).astype(np.uint32)
    table = token_blocks.Frequencies(token_blocks.scaled(np.bincount(ids, minlength=50_000)))
    frame = token_blocks.encode_block(ids, table)
    assert (token_blocks.decode_block(frame, table) == ids).all()
    if n > 200_000:  # from one checkpoint to the next
        part = token_blocks.decode_block(frame, table, 1, 2)
        assert (part == ids[128 * 1024 : 256 * 1024]).all()
        damaged = bytearray(frame)
        damaged[-5] ^= 1
        with pytest.raises(ValueError):
            token_blocks.decode_block(bytes(damaged), table)


def test_wrapper(spark):
    def page(k):
        body = "".join(f"<p>Text {k} {j} &amp; more<br>here" for j in range(4))
        return (
            f"<html><head><title>T{k}</title><script>x='</p>'</script></head><body><nav><a>n{k}</a></nav>"
            f"<div class='page'><div class='side-bar sidebar'>s{k}</div><div class='text'><h1>T{k}</h1>{body}"
            f"<div class='legend'>Always the same</div></div></div><div class=comments>c{k}</div><footer>f{k}</footer>"
        )

    rows = [(k, "http://a.example/x", page(k)) for k in range(6)]
    rows += [(90, "http://b.example/", None), (91, None, "<p>alone"), (0, "http://a.example/x", page(0))]
    got = wrapper.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    text = {r.page_id: r.text for r in got}
    for k in range(6):
        assert text[k] == f"T{k} " + " ".join(f"Text {k} {j} & more here" for j in range(4))
    assert (text[90], text[91], len(got)) == ("", "alone", len(rows))


def test_quotes(spark, empty):
    rows = [
        (1, 0, "Hello there\nsecond line"), (1, 1, "Answer\nOn Monday x wrote:\n> hello   there\n> second line"),
        (1, 2, "> Answer\n>> Hello there\nback"), (1, 3, "> never said\nx"), (2, 0, None), (2, 0, "kept"), (None, 1, "y"),
    ]
    messages, passages = quotes.link_quotes(spark.createDataFrame(rows, "conv_id long, turn long, text string"))
    got = {(r.conv_id, r.turn): (r.parent_turn, r.root_turn, r.depth, r.position, r.own_text) for r in messages.collect()}
    assert got == {
        (1, 0): (None, 0, 0, 1, "Hello there\nsecond line"), (1, 1): (0, 0, 1, 2, "Answer"),
        (1, 2): (1, 0, 2, 3, "back"), (1, 3): (None, 3, 0, 1, "x"), (2, 0): (None, 0, 0, 1, "kept"),
    }
    assert {(r.turn, r.level, r.origin_turn) for r in passages.collect()} == {
        (1, 1, 0), (2, 1, 1), (2, 2, 0), (3, 1, None)
    }


def test_quoting_archive_takes_a_turn_once(spark, empty):
    schema = "conv_id long, turn long, role string, text string, kept string"
    rows = [(1, turn, "user", f"text {turn}", "clash") for turn in range(3)] * 40 + [(1, 1, "user", "a", None)]
    got = quotes.quoting_archive(spark.createDataFrame(rows, schema)).collect()
    assert sorted((r.turn, r.text.count("\n")) for r in got) == [(0, 0), (1, 2), (2, 3)]
    assert quotes.quoting_archive(spark.createDataFrame([], schema)).count() == 0


def test_pipeline_stages_keep_their_columns(spark, docs, tmp_path):
    spark.createDataFrame([(1, "w1 absent")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    frame = docs
    for name, stage in corpus_pipeline.STAGES:
        frame = stage(spark, frame, str(tmp_path))
        if name != "sentencepiece":
            assert frame.columns == docs.columns, name
    assert {r.doc_id for r in frame.collect()} >= {1, 9, 12}


def test_token_ids_of_odd_texts_equal_the_librarys_and_words_share_calls(monkeypatch):
    import random

    import public_tokenizers
    from tokenizers import Tokenizer

    from basketloom.llm import token_blocks

    path = public_tokenizers.path("word_bpe_49k.json")
    library = Tokenizer.from_file(path)
    rng = random.Random(3)
    characters = "ab'sSt\"!<|.,0123½éÉ́ ΑΣ\n\t\x1c  🙂’٣R¼ dm"
    texts = ["".join(rng.choices(characters, k=rng.randint(0, 30))) for _ in range(2000)]
    texts += ["A <|ENDOFTEXT|> b", "x<|endoftext|>Y", "½ a½b", "it's 'stuff !'s x'T don't''s 3's", "", None]
    wanted = [library.encode(t or "", add_special_tokens=False).ids + [2] for t in texts]
    assert [list(ids) for ids in token_blocks.ids_of(texts, path, 2)] == wanted

    # Many distinct words are few texts for the library.
    tokenizer, mark = token_blocks._tokenizer(path)[0], token_blocks._tokenizer(path)[-1]
    sent = []

    class Counting:
        def encode_batch_fast(self, some, **options):
            sent.extend(some)
            return tokenizer.encode_batch_fast(some, **options)

    words = [f"w{'x' * (i % 7)}y{'z' * (i % 11)}q".encode() for i in range(77)]
    coded = list(token_blocks._coded(Counting(), mark, words))
    assert coded == [
        np.array(library.encode(w.decode(), add_special_tokens=False).ids, "<u4").tobytes() for w in words
    ]
    assert len(sent) == 1


def test_pieces_are_cut_where_no_piece_reaches_over(monkeypatch):
    import random

    import sentencepiece

    path = piece_codec.default_model()
    library = sentencepiece.SentencePieceProcessor(model_file=path)
    codec = piece_codec.Codec(path)
    learnt = []
    learn = codec.learn
    monkeypatch.setattr(codec, "learn", lambda words: learnt.extend(words) or learn(words))
    texts = ["their, their. their; their!\n", "their?\n\n their", "▁their ▁their", "", None]
    assert [list(ids) for ids in codec.encode(texts)] == [library.encode(t or "") for t in texts]
    assert [w for w in learnt if "their" in w] == ["▁their", "▁▁their"]
    rng = random.Random(2)
    characters = "ab'sStÉ\"!<|.,0123½éÉ́ ΑΣ\n\n\t🙂’٣R¼ dm  etheioun"
    texts = ["".join(rng.choices(characters, k=rng.randint(0, 30))) for _ in range(2000)]
    assert [list(ids) for ids in codec.encode(texts)] == [library.encode(t) for t in texts]


def test_equal_grams_and_words_are_looked_up_once(monkeypatch):
    import pandas as pd

    words = pd.DataFrame({"lang": ["a", "b"], "word": ["thatch", "queue"], "n": [5, 4]})
    counts = pd.concat(language_id._grams(5)([words])).groupby(["lang", "gram"], as_index=False)["n"].sum()
    model = language_id.kneser_ney(counts, 5)
    some = ["that", "thatch", "thatched", "queue", "quiet", "é"]
    alone = np.concatenate([model.score([w]) for w in some])
    asked = []
    find = language_id._find
    monkeypatch.setattr(
        language_id, "_find", lambda table, keys, missing: asked.append(len(keys)) or find(table, keys, missing)
    )
    assert np.allclose(model.score(some), alone, rtol=1e-12)
    once = sum(asked)
    asked.clear()
    model.score(some * 50)
    assert sum(asked) == once

    reader = language_id.Reader(model)
    sums, symbols = reader.read(["That, that! (that) 12 THAT.", "that", "12 !", None, "É'é-that"])
    assert symbols.tolist() == [20, 5, 0, 0, 9]
    assert np.allclose(sums, [4 * alone[0], alone[0], 0 * alone[0], 0 * alone[0], alone[0] + 2 * alone[5]])
    assert sum(b"that" in c for c in reader.rows) == 1
