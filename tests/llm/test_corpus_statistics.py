"""Divergence audit, collocations and MinHash joins against direct versions on awkward rows."""

from __future__ import annotations

import collections
import re

import duckdb
import numpy as np
import pyarrow as pa
import pytest

pytest.importorskip("basketloom.llm")

from basketloom.llm import collocations, divergence, minhash

# Columns of the same names as those the operators add.
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, part string, n long, size int"


def frame(spark, rows):
    """Rows of (doc_id, text, lang, source)."""
    return spark.createDataFrame([(*r, None, "clash", -1, -1) for r in rows], SCHEMA)


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(5)
    words = ["the", "of", "Größe", "漢字", "a_b", "x'y", "new", "york", "city", "Mayor", "e", "🙂"]
    out = []
    for i in range(60):
        picked = rng.choice(words, rng.integers(1, 90))
        text = " ".join(picked)
        for sign in ".,;:!?\n\r\x0b\x0c\t":
            text = re.sub(" ", lambda m: sign + " " if rng.random() < 0.02 else m.group(), text)
        lang = [None, "en", "de", "und", ""][int(rng.integers(0, 5))]
        source = [None, "web", "books", "news", ""][int(rng.integers(0, 5))]
        out.append((i, text, lang, source))
    common = "New York city, the Mayor of new york City. " * 12
    out += [(100 + i, common, "en", "web") for i in range(3)]
    out += [
        (3, "the of", "en", "web"), (3, "the of", "en", "web"), (None, common, "en", "books"),
        (None, common, "en", "books"), (200, None, "en", "web"), (201, "", "xx", "only"),
        (202, " \t\n", "xx", "other"), (203, "1234 ...", None, None), (204, "a " * 3000, "en", "web"),
        (205, "\x00the\x00 of\x7f", "de", "web"), (-4, "Größe " * 40, "de", "books"),
    ]
    return out


def sql_rows(sql, rows):
    documents = pa.table(  # noqa: F841  (read by DuckDB)
        {
            "doc_id": pa.array([r[0] for r in rows], pa.int64()),
            "text": pa.array([r[1] for r in rows], pa.string()),
            "lang": pa.array([r[2] for r in rows], pa.string()),
            "source": pa.array([r[3] for r in rows], pa.string()),
        }
    )
    found = duckdb.sql(sql)
    return found.columns, sorted(map(repr, found.fetchall()))


def low(text):
    return re.sub("[A-Z]", lambda m: m.group().lower(), text or "")


# --- divergence ------------------------------------------------------------------------------------


def audit(rows, least, top=10):
    counts, seen = collections.defaultdict(collections.Counter), collections.defaultdict(collections.Counter)
    for _, text, lang, source in rows:
        terms = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", low(text))
        counts[lang or "", source or ""].update(terms)
        seen[lang or ""].update(set(terms))
    out = []
    for lang in seen:
        kept = [t for t, n in seen[lang].items() if n >= least]
        sources = [s for one, s in counts if one == lang]
        whole = collections.Counter()
        for s in sources:
            whole.update(counts[lang, s])

        def share(count, lang=lang, kept=kept):
            total = sum(count[t] for t in kept)
            return {t: 1 + 10**9 * (count[t] + 2) // (total + 2 * len(kept)) for t in kept}

        def far(p, q):
            return (p - q) ** 2 // (p + q)

        shares = {s: share(counts[lang, s]) for s in sources}
        base = share(whole)
        for s in sources:
            p = shares[s]
            parts = {
                "pair": [(o, sum(far(p[t], shares[o][t]) for t in kept)) for o in sources if o != s],
                "term": [(t, far(p[t], base[t])) for t in kept if counts[lang, s][t] and p[t] > base[t]],
            }
            for part, items in parts.items():
                items.sort(key=lambda x: (-x[1], x[0].encode()))
                for rank, (item, value) in enumerate(items[: top if part == "term" else None], 1):
                    out.append((lang, s, part, item, value, rank))
    return sorted(map(repr, out))


@pytest.mark.parametrize("least", [10, 2, 1000])
def test_divergence(spark, rows, least, monkeypatch):
    got = divergence.audit(frame(spark, rows), least_documents=least)
    assert got.columns == ["lang", "source", "part", "item", "value", "rank"]
    assert sorted(repr(tuple(r)) for r in got.collect()) == audit(rows, least)


def test_divergence_in_tiles_and_shards(spark, rows, monkeypatch):
    monkeypatch.setattr(divergence, "SHARD_ROWS", 20)
    wide = [(i, t, "en", f"{s}{k % 7}") for k, (i, t, _, s) in enumerate(rows)]
    expected = audit(wide, 3)
    # Workers see the module as it is on disk: sources are tiled by the plan and by the task alike.
    got = divergence.audit(frame(spark, wide), least_documents=3)
    assert sorted(repr(tuple(r)) for r in got.collect()) == expected


def test_more_sources_than_a_tile(spark):
    wide = [(i, f"common word{i % 5} " * (1 + i % 3), "en", f"s{i}") for i in range(divergence.TILE + 9)]
    got = divergence.audit(frame(spark, wide), least_documents=2).where("source = 's3'")
    expected = [r for r in audit(wide, 2) if r.startswith("('en', 's3',")]
    assert sorted(repr(tuple(r)) for r in got.collect()) == expected


def test_divergence_sql_and_empty_table(spark, rows):
    columns, found = sql_rows(divergence.ORACLES["op11_divergence"], rows)
    assert (columns, found) == (["lang", "source", "part", "item", "value", "rank"], audit(rows, 10))
    assert divergence.audit(frame(spark, [])).count() == 0


def test_partial_counts_are_bounded(rows, monkeypatch):
    batch = pa.RecordBatch.from_pydict(
        {"lang": [r[2] for r in rows], "source": [r[3] for r in rows], "text": [r[1] for r in rows]},
        schema=pa.schema([(c, pa.string()) for c in ("lang", "source", "text")]),
    )
    def total(batches):
        sums = collections.Counter()
        for b in batches:
            for r in b.to_pylist():
                sums[r["lang"], r["source"], r["term"]] += r["n"]
        return sums
    whole = total(divergence._count(iter([batch])))
    monkeypatch.setattr(divergence, "HELD_ROWS", 8)
    monkeypatch.setattr(divergence, "SLICE_BYTES", 200)
    parts = list(divergence._count(iter([batch.slice(0, 30), batch.slice(30)])))
    assert len(parts) > 5 and total(parts) == whole


def test_shares_are_exact_beyond_64_bits():
    count = np.array([10**14, 0, 3], np.int64)
    found = divergence._shares(count, np.array([4 * 10**14]), 1000)
    assert found.tolist() == [1 + 10**9 * (int(c) + 2) // (4 * 10**14 + 2000) for c in count]


# --- collocations ----------------------------------------------------------------------------------


def phrases(rows, least, kept=2000):
    f, n = collections.defaultdict(collections.Counter), collections.Counter()
    for _, text, lang, _ in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low(text)):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for size in range(1, 5):
                f[lang].update(tuple(words[i : i + size]) for i in range(len(words) - size + 1))
    out = []
    for lang, counts in f.items():
        often = {p: a for p, a in counts.items() if len(p) > 1 and a >= least}
        best = []
        for p, a in often.items():
            around = [
                b for q, b in often.items()
                if len(q) > len(p) and any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1))
            ]
            if any(100 * b >= 80 * a for b in around):
                continue
            cut = min(
                (2000000 * a // (counts[p[:k]] + counts[p[k:]]), k, counts[p[:k]], counts[p[k:]])
                for k in range(1, len(p))
            )
            best.append((" ".join(p), a, cut[2], cut[3], n[lang], cut[0]))
        best.sort(key=lambda x: (-x[5], -x[1], x[0].encode()))
        out += [(lang, rank, *x) for rank, x in enumerate(best[:kept], 1)]
    return sorted(map(repr, out))


COLUMNS = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]


@pytest.mark.parametrize(("least", "kept"), [(30, 2000), (3, 2000), (1, 7)])
def test_collocations(spark, rows, least, kept):
    got = collocations.collocations(frame(spark, rows), least, kept)
    assert got.columns == COLUMNS
    assert sorted(repr(tuple(r)) for r in got.collect()) == phrases(rows, least, kept)


def test_collocations_in_many_parts(spark, rows, monkeypatch):
    monkeypatch.setattr(collocations, "PART_BYTES", 700)
    monkeypatch.setattr(collocations, "SHARD_BYTES", 1500)
    monkeypatch.setattr(collocations, "SHARE_ROWS", 5)
    got = collocations.collocations(frame(spark, rows).repartition(5), 3)
    assert sorted(repr(tuple(r)) for r in got.collect()) == phrases(rows, 3)


def test_collocations_sql_and_empty_table(spark, rows):
    assert sql_rows(collocations.ORACLES["op12_collocations"], rows) == (COLUMNS, phrases(rows, 30))
    assert collocations.collocations(frame(spark, [])).count() == 0
    assert collocations.collocations(frame(spark, [(1, None, None, None), (2, "", "en", "a")])).count() == 0


def test_chunks_overlap_by_the_run_that_cuts(rows):
    texts = [low(r[1]).encode() for r in rows]
    limits = np.append(0, np.cumsum([len(t) for t in texts]))
    owner, found = collocations.chunks_of(np.frombuffer(b"".join(texts), np.uint8), limits)
    for i, text in enumerate(texts):
        mine = [c for o, c in zip(owner, found, strict=True) if o == i]
        words = [w for p in re.split(rb"[.,;:!?\x0A-\x0D]", text) for w in re.findall(rb"[^\x20\x09]+", p)]
        joined: list[bytes] = []
        for chunk in mine:
            own = chunk.split()
            if joined:
                assert joined[-collocations.OVERLAP :] == own[: collocations.OVERLAP]
                del joined[-collocations.OVERLAP :]
            joined += own
        assert joined == words
        assert [c.endswith(b"\n") for c in mine] == [False] * (len(mine) - 1) + [True] * bool(mine)
    # A passage gives the same inner chunks wherever it stands.
    rng = np.random.default_rng(1)
    passage = " ".join(rng.choice([f"w{i}" for i in range(300)], 400))
    two = [("x " * 9 + passage).encode(), ("y z " * 7 + passage + " end").encode()]
    limits = np.append(0, np.cumsum([len(t) for t in two]))
    owner, found = collocations.chunks_of(np.frombuffer(b"".join(two), np.uint8), limits)
    shared = {c for o, c in zip(owner, found, strict=True) if o == 0}
    shared &= {c for o, c in zip(owner, found, strict=True) if o == 1}
    assert len(shared) >= 3


# --- minhash ---------------------------------------------------------------------------------------


def shingle_sets(rows):
    sets = []
    for _, text, *_ in rows:
        w = re.findall(rb"[^\x20\x09-\x0D]+", low(text).encode())
        sets.append({tuple(w[k : k + 2]) for k in range(max(1, len(w) - 1))} if w else set())
    return sets


def near(rows, percent=80):
    sets = shingle_sets(rows)
    label = list(range(len(rows)))

    def top(x):
        while label[x] != x:
            x = label[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if sets[a] and sets[b] and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                label[top(a)] = top(b)
    out = []
    for k, row in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if top(j) == top(k) and rows[j][0] is not None]
        least = min(ids, default=None)
        out.append((row[0], len(sets[k]), least, row[0] == least))
    return sorted(map(repr, out))


def varied(rng, base, share, vocabulary):
    words = base.split()
    for i in range(len(words)):
        if rng.random() < share:
            words[i] = str(rng.choice(vocabulary))
    return " ".join(words)


def test_minhash(spark, rows):
    rng = np.random.default_rng(9)
    vocabulary = [f"w{i}" for i in range(500)]
    bases = [" ".join(rng.choice(vocabulary, n)) for n in (12, 60, 300)]
    more = [
        (1000 + 40 * b + i, varied(rng, base, share, vocabulary), "en", "web")
        for b, base in enumerate(bases)
        for i, share in enumerate(np.linspace(0, 0.3, 40))
    ]
    # Sets of 4 and 5 shingles with 4 in common: exactly 80 percent.
    more += [(2000, "p q r s t", "en", "web"), (2001, "p q r s t u", "en", "web"), (2002, "P Q r s", "en", None)]
    table = rows + more + more[:5]
    got = minhash.near_duplicates(frame(spark, table))
    assert got.columns == ["doc_id", "n_shingles", "component_id", "kept"]
    assert sorted(repr(tuple(r)) for r in got.collect()) == near(table)


def test_minhash_second_pass(spark, rows):
    """Chains without a common centre, and a bucket with several components in several tiles."""
    words = [f"c{i}" for i in range(400)]
    chain = [(i, " ".join(words[4 * i : 4 * i + 100]), "en", "web") for i in range(40)]
    got = minhash.near_duplicates(frame(spark, chain))
    assert sorted(repr(tuple(r)) for r in got.collect()) == near(chain)


def test_minhash_tiles_join_what_is_similar():
    rng = np.random.default_rng(2)
    base = rng.integers(0, 1 << 62, 200, np.int64)
    sets = []
    for i in range(30):
        kept = base.copy()
        changed = rng.choice(200, int(rng.integers(0, 45)), replace=False)
        kept[changed] = rng.integers(0, 1 << 62, len(changed), np.int64)
        sets.append(np.sort(kept.view(np.uint64)).view(np.int64))
    values = np.concatenate(sets).view(np.uint64)
    table = minhash.minima(values, np.arange(0, 6001, 200))
    heads = (minhash.mix(table) >> np.uint64(56)).astype(np.uint8)
    names = [bytes([i]) * 16 for i in range(30)]
    root = [names[i] if i != 29 else names[3] for i in range(30)]

    def links(left, right):
        tile = pa.table({
            "class": pa.array(names, pa.binary()), "root": pa.array(root, pa.binary()),
            "head": pa.array([h.tobytes() for h in heads], pa.binary()),
            "shingles": pa.array([s.tolist() for s in sets], pa.list_(pa.int64())),
            "left": left, "right": right,
        })
        found = minhash._joining(80)((), tile)
        return list(zip(found["a"].to_pylist(), found["b"].to_pylist(), strict=True))

    def similar(i, j):
        both = len(np.intersect1d(sets[i], sets[j]))
        return 100 * both >= 80 * (400 - both)

    def parts(pairs):
        label = {n: n for n in names}
        label[names[29]] = names[3]
        changed = True
        while changed:
            changed = False
            for a, b in pairs:
                least = min(label[a], label[b])
                changed |= label[a] != label[b]
                label[a] = label[b] = least
            for n in names:  # rows of one component move together
                if label[n] != label[label[n]]:
                    label[n], changed = label[label[n]], True
            least = min(label[names[3]], label[names[29]])
            changed |= label[names[3]] != label[names[29]]
            label[names[3]] = label[names[29]] = least
        return label

    everything = [True] * 30
    got = links(everything, everything)
    direct = [(names[i], names[j]) for i in range(30) for j in range(i) if similar(i, j)]
    assert parts(got) == parts(direct) and len(got) < 30 < len(direct)
    assert all(similar(a[0], b[0]) for a, b in got)
    first = [i < 15 for i in range(30)]
    across = [(a, b) for a, b in direct if (a[0] < 15) != (b[0] < 15)]
    assert parts(links(first, [not x for x in first])) == parts(across)


def test_minhash_estimates_similarity():
    rng = np.random.default_rng(3)
    common = rng.integers(0, 1 << 63, 800, np.uint64)
    own = [rng.integers(0, 1 << 63, 100, np.uint64) for _ in range(2)]
    values = np.concatenate([common, own[0], common, own[1]])
    table = minhash.minima(values, np.array([0, 900, 1800]))
    agreeing = (table[0] == table[1]).mean()
    assert abs(agreeing - 0.8) < 0.1
    assert (table[0] == (values[:900, None] * minhash.FACTORS + minhash.OFFSETS).min(axis=0)).all()
    assert (1 - 0.8**minhash.ROWS) ** minhash.BANDS < 1e-9


def test_minhash_empty_table_and_low_thresholds(spark):
    assert minhash.near_duplicates(frame(spark, [])).count() == 0
    alone = [(1, None, None, None), (2, "", "en", "a"), (None, " ", "en", "a"), (None, None, "en", "a")]
    got = minhash.near_duplicates(frame(spark, alone))
    assert sorted(repr(tuple(r)) for r in got.collect()) == near(alone)
    with pytest.raises(ValueError, match="80 percent"):
        minhash.near_duplicates(frame(spark, alone), percent=70)


def test_a_text_of_megabytes(spark):
    rng = np.random.default_rng(4)
    long = " ".join(rng.choice([f"v{i}" for i in range(3000)], 400_000))
    table = [(1, long, "en", "web"), (2, long, "en", "web"), (3, "short text", "en", "web")]
    got = {r.doc_id: r.component_id for r in minhash.near_duplicates(frame(spark, table)).collect()}
    assert got == {1: 1, 2: 1, 3: 3}
    assert divergence.audit(frame(spark, table), least_documents=2).count() == 0
    assert collocations.collocations(frame(spark, table), least=30).where("a < 30").count() == 0
