"""Merkle manifest, toxicity and collocations against plain versions."""

import collections
import hashlib
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from coinloft.llm import manifest, phrases, subword, toxicity
from coinloft.llm.queries import ship

SF = "/root/testdata/sf0.001"
LOWER = {i: i + 32 for i in range(65, 91)}


@pytest.fixture(scope="module", autouse=True)
def code(spark):
    ship(spark)


# --- manifest ----------------------------------------------------------------


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def encoded(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def climbed(level):
    """(root, per node: [(siblings before, siblings after)] up to the root)."""
    ways = [[] for _ in level]
    at = list(range(len(level)))
    while len(level) > 1:
        for k, i in enumerate(at):
            run = level[i // 16 * 16 : i // 16 * 16 + 16]
            ways[k].append((run[: i % 16], run[i % 16 + 1 :]))
        at = [i // 16 for i in at]
        level = [H(*level[i : i + 16]) for i in range(0, len(level), 16)]
    return level[0], ways


def manifest_by_hand(rows):
    """The result rows of (doc_id, source, lang, n_chars, text), as a sorted list."""
    def leaf(r, text):
        return H(*map(encoded, (*r[:4], text)))

    by = collections.defaultdict(list)
    for r in rows:
        by[r[1]].append(r)
    sources = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    trees = []
    for s in sources:
        own = sorted(by[s], key=lambda r: (r[0] is not None, r[0] or 0, leaf(r, r[4])))
        trees.append((own, *climbed([leaf(r, r[4]) for r in own])))
    root, above = climbed([t[1] for t in trees])
    out = []
    for (own, subroot, ways), top in zip(trees, above, strict=True):
        for r, way in zip(own, ways, strict=True):
            text = r[4]
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0 and text is not None:
                text = text.translate(LOWER)
            h = leaf(r, text)
            for before, after in way + top:
                h = H(*before, h, *after)
            proof = H(*[x for before, after in way + top for x in before + after])
            out.append((r[0], leaf(r, r[4]), subroot, root, proof, h, h == root))
    return sorted(out, key=repr)


DDL = "doc_id long, source string, lang string, n_chars long, text string, pos string, tree int"


def manifest_of(spark, rows):
    return sorted(map(tuple, manifest.verified(spark.createDataFrame([(*r, "x", 1) for r in rows], DDL)).collect()), key=repr)


def test_manifest_equals_a_plain_merkle_tree(spark):
    """Sources of 1, 16, 17 and 300 rows, more than 16 sources, nulls in every column, repeated ids and rows, odd source names."""
    rows = [(i, "s%d" % (i % 19), None if i % 7 == 0 else "en", i, f"Text NUMBER {i} é") for i in range(60)]
    rows += [(1000 + i, "big", "en", i, f"Big {i}") for i in range(300)] + [(2000 + i, "A", None, None, "Ab") for i in range(16)]
    rows += [(3000 + i, "ä", "en", 1, None if i % 2 else "") for i in range(17)] + [(4000, "", "x", 0, "Q"), (5, None, None, None, None)]
    rows += [(None, None, None, None, None), (None, "big", "en", 3, "No Id"), (1000, "big", "en", 9, "same id"), rows[70], rows[70], (-5, "^", "en", 1, "M")]
    want = manifest_by_hand(rows)
    assert manifest_of(spark, rows) == want
    assert {r[6] for r in want} == {True, False}


@pytest.mark.parametrize("rows", [
    [(1, "a", "en", 1, "One")], [(20, None, None, None, "One"), (21, None, None, None, None)],
    [(i, "a", "en", 1, "One") for i in range(17)], [(i, f"s{i}", "en", 1, "One") for i in range(17)], []])
def test_small_manifests(spark, rows):
    assert manifest_of(spark, rows) == (manifest_by_hand(rows) if rows else [])


def test_hot_nodes_are_found_in_copies(spark, monkeypatch):
    monkeypatch.setattr(manifest, "CLIMBERS", 3)  # every upper node in several copies
    rows = [(i, "hot" if i % 3 else f"s{i % 40}", "en", i, f"T{i}") for i in range(900)]
    assert manifest_of(spark, rows) == manifest_by_hand(rows)


def test_climbing_rows_carry_no_digests(spark, monkeypatch):
    """What climbs is a key and a place, whatever the depth; digests are stored as 32 bytes, an altered one only where it differs."""
    stored, store = {}, manifest.cut_lineage

    def kept(df, purpose):
        stored[purpose] = store(df, purpose)
        return stored[purpose]

    monkeypatch.setattr(manifest, "cut_lineage", kept)
    rows = [(i, "a", "en", 1, "UP" if i % 2 else "low") for i in range(100)]
    manifest_of(spark, rows)
    assert set(stored["climbed"].columns) == {"run", "step", "up", "place"}
    leaves = stored["leaves"].collect()
    assert {len(r.leaf) for r in leaves} == {32}
    assert sorted(r.doc_id for r in leaves if r.altered) == [i for i in range(100) if i % 2 and zlib.crc32(str(i).encode()) % 5 == 0]


# --- toxicity ------------------------------------------------------------------


def test_pairs_tell_what_single_words_cannot(spark):
    """Either word alone is toxic here and both together are not: no sum of weights can tell, a pair term can."""
    rng = np.random.default_rng(3)
    vocabulary = [f"w{i}" for i in range(40)]
    rows = []
    for i in range(1500):
        k = int(rng.integers(4))
        words = [*rng.choice(vocabulary, 6), *(["insult"] if k & 1 else []), *(["group"] if k & 2 else [])]
        rng.shuffle(words)
        rows.append((i, " ".join(words), int(k in (1, 2))))
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(r[0], r[2]) for r in rows], "doc_id long, toxic int")
    truth = {r[0]: r[2] for r in rows}

    def accuracy(machine):
        held = [r for r in toxicity.score(docs.withColumn("held", toxicity.held_out()), machine).collect() if r.held]
        return np.mean([(r.score >= 0.5) == truth[r.doc_id] for r in held])

    machine = toxicity.fit(docs, labels)
    examples = subword.sample_features(docs, labels.where(~toxicity.held_out()).withColumnRenamed("toxic", "label"), "doc_id", toxicity.TERMS, toxicity.MAX_ROWS)
    linear = toxicity.train([(y, ids, x) for y, ids, x in examples], factor_rate=0.0)
    linear.factors[:] = 0
    assert accuracy(machine) > 0.9 > 0.7 > accuracy(linear)


def test_scores_follow_the_formula_pair_by_pair(monkeypatch):
    rng = np.random.default_rng(1)
    size = 1 << toxicity.TERMS.bits
    m = toxicity.Machine(0.3, rng.random(size, np.float32) * (rng.random(size) < 0.7), rng.standard_normal(size, np.float32),
                         rng.standard_normal((size, toxicity.FACTORS), np.float32), 1.5, -0.2)
    texts = ["one two three two", "", None, "Ünï code words, and-more words", "x" * 30 + " y", "!!"] + [" ".join(f"t{i}" for i in range(k)) for k in (1, 2, 9000)]
    got, _ = toxicity.values(pa.array(texts, pa.string()), m)
    monkeypatch.setattr(subword.X, "PIECE", 8192)  # the long text comes in pieces
    in_pieces, _ = toxicity.values(pa.array([texts[-1]]), m)
    for t, score in zip(texts, got, strict=True):
        raw = (t or "").encode()
        bucket, _ = subword.buckets(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]), toxicity.TERMS)
        ids, x = toxicity.inputs(np.unique(bucket).astype(np.int64), m.rarity)
        z = m.bias + float(x @ m.weights[ids])
        z += sum(float(m.factors[ids[i]] @ m.factors[ids[j]]) * x[i] * x[j] for i in range(len(ids)) for j in range(i)) if len(ids) < 200 else 0
        if len(ids) < 200:
            assert score == pytest.approx(1 / (1 + np.exp(-(m.slope * z + m.shift))), abs=1e-5)
    assert in_pieces[0] == pytest.approx(got[-1], abs=1e-9)


def test_toxicity_reaches_held_out_accuracy_and_bears_odd_rows(spark):
    more = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{more}/documents.parquet"), spark.read.parquet(f"{more}/labels.parquet")
    out = toxicity.toxicity(docs, labels).collect()
    truth = {r.doc_id: r.toxic for r in labels.collect()}
    held = [(r.score, truth[r.doc_id], r.predicted) for r in out if r.held_out and r.doc_id in truth]
    pos, neg = [s for s, y, _ in held if y], [s for s, y, _ in held if not y]
    assert np.mean([a > b for a in pos for b in neg]) > 0.8 and np.mean([p == y for _, y, p in held]) > 0.88
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) and r.predicted == (r.score >= 0.7) for r in out)
    few = spark.createDataFrame([(1, "a b", 0.5), (1, "a b", 0.5), (None, None, None), (3, "", 1.0), (4, "z " * 50000, 1.0)], "doc_id long, text string, score double")
    marks = spark.createDataFrame([(1, 1), (1, None), (None, 1), (3, 0)], "doc_id long, toxic int")
    assert toxicity.toxicity(few, marks).count() == 5 and toxicity.toxicity(few.limit(0), marks).count() == 0
    assert {r.score < 1e-9 for r in toxicity.toxicity(few, marks.limit(0)).collect()} == {True}


# --- collocations --------------------------------------------------------------------


def collocations_by_hand(rows, least, top):
    f, total, out = collections.Counter(), collections.Counter(), []
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\x0a-\x0d]", (text or "").translate(LOWER)):
            ws = [w for w in re.split("[\x20\x09]+", piece) if w]
            total[lang] += len(ws)
            for n in range(1, 5):
                for i in range(len(ws) - n + 1):
                    f[lang, tuple(ws[i : i + n])] += 1
    cand = {k: a for k, a in f.items() if len(k[1]) >= 2 and a >= least}
    for lang in {k[0] for k in cand}:
        found = []
        for (l_, ws), a in cand.items():
            if l_ != lang or any(m == lang and len(b) > len(ws) and 100 * c >= 80 * a and any(b[i : i + len(ws)] == ws for i in range(len(b))) for (m, b), c in cand.items()):
                continue
            score, k = min((2000000 * a // (f[lang, ws[:k]] + f[lang, ws[k:]]), k) for k in range(1, len(ws)))
            found.append((-score, -a, " ".join(ws).encode(), f[lang, ws[:k]], f[lang, ws[k:]]))
        for rank, (s, a, p, l, r) in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, p.decode(), -a, l, r, total[lang], -s))
    return sorted(out)


def test_collocations_equal_plain_counts(spark):
    """Overlaps, breaks, blanks of both kinds, null texts and languages, repeated rows, ties and columns named like results."""
    rng = np.random.default_rng(2)
    vocabulary = ["The", "the", "of", "a", "a", "a", "new", "york", "New", "york", "city", "é", "\u00a0x", "don't"]
    texts = [("".join(str(rng.choice(vocabulary)) + str(rng.choice([" ", " ", "  ", "\t", ", ", ".", "\n"])) for _ in range(int(rng.integers(0, 90)))),
              [None, "en", "de"][int(rng.integers(3))]) for _ in range(60)]
    texts += [(None, "en"), ("", None), ("   ", "en"), ("solo", "xx"), texts[0], texts[0], ("a a a a a a a a", "en")]
    docs = spark.createDataFrame([(*t, "x", 1) for t in texts], "text string, lang string, phrase string, n int")
    for least, top in ((5, 2000), (12, 3)):
        assert sorted(map(tuple, phrases.collocations(docs, least, top).collect())) == collocations_by_hand(texts, least, top)
    assert phrases.collocations(docs.limit(0)).count() == 0


def test_a_full_filter_changes_nothing(spark, monkeypatch):
    """With almost every bit set the filter lets rare windows through; the result stays."""
    docs = spark.createDataFrame([("a b c d e f g a b c a b", "en"), ("a b c x y z a b", "en")], "text string, lang string")
    want = phrases.collocations(docs, 2).collect()
    monkeypatch.setattr(phrases, "frequent_filter", lambda d, least: np.full(phrases.FILTER_BITS // 8, 255, np.uint8))
    assert want and phrases.collocations(docs, 2).collect() == want


def test_rollup_gets_each_window_once(spark, monkeypatch):
    """ROLLUP writes every row five times, so windows of all tasks are summed before it."""
    plans, store = {}, phrases.cut_lineage

    def stored(df, purpose):
        plans[purpose] = df._jdf.queryExecution().optimizedPlan().toString()
        return store(df, purpose)

    monkeypatch.setattr(phrases, "cut_lineage", stored)
    phrases.phrase_counts(spark.createDataFrame([("a b c d", "en")] * 3, "text string, lang string"), 2)
    above, below = plans["phrase-counts"].split("Expand", 1)
    assert "Aggregate" in above and "Aggregate" in below


def test_the_filter_grows_with_its_keys(spark, monkeypatch):
    monkeypatch.setattr(phrases, "FILTER_BITS", 1 << 16)
    words = [f"w{i}" for i in range(6000)]
    held = phrases.frequent_filter(spark.createDataFrame([(" ".join(words), "en")], "text string, lang string"), 1)
    others = np.random.default_rng(1).integers(0, 1 << 48, 20000).astype(np.uint64)
    assert phrases._held(held, others).mean() < 0.05
    text = " ".join(words)
    own, pair, triple = phrases._keys(phrases._Words(np.frombuffer(text.encode(), np.uint8), np.array([0, len(text)])), phrases._lang_hashes(["en"]))
    assert phrases._held(held, np.concatenate([own, pair[:-1], triple[:-2]])).all()


@settings(max_examples=30, deadline=None)
@given(st.lists(st.sampled_from(["a", "Bc", "ddd", " ", " ", "\t", ".", ",", "\n", "é"]), max_size=300))
def test_long_texts_keep_every_window_over_their_passes(parts):
    text = "".join(parts)

    def windows(limit):
        before, phrases.CHUNK = phrases.CHUNK, limit
        try:
            class All:
                value = np.full(phrases.FILTER_BITS // 8, 255, np.uint8)

            batch = pa.RecordBatch.from_arrays([pa.array([text]), pa.array(["en"])], ["text", "lang"])
            count = collections.Counter()
            for out in phrases._windows(All)(iter([batch])):
                for r in out.to_pylist():
                    count[tuple(r[c] for c in phrases.COLUMNS)] += r["n"]
            return count
        finally:
            phrases.CHUNK = before

    assert windows(8) == windows(1 << 20)
