"""Kernels against plain Python."""

import re
import tracemalloc

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from coinloft.llm import chats, near, neighbours, secrets
from coinloft.llm import subword as S
from coinloft.llm import text as X

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
TEXTS = st.lists(st.one_of(st.none(), st.text(alphabet="aB z9é-\n|", max_size=40)), min_size=1, max_size=6)


def lower(t):
    return (t or "").translate({i: i + 32 for i in range(65, 91)})


@settings(deadline=None, max_examples=60)
@given(TEXTS)
def test_words_and_shingles_agree_with_a_regular_expression(texts):
    (first, end, data, offsets), = list(X.chunks(pa.array(texts, pa.string())))
    hashes, rows = X.words(data, offsets)
    plain = [WORD.findall(lower(t)) for t in texts]
    assert np.bincount(rows, minlength=len(texts)).tolist() == [len(w) for w in plain]
    names = {}
    for h, w in zip(hashes.tolist(), [w for ws in plain for w in ws]):
        assert names.setdefault(h, w) == w
    assert len(set(names.values())) == len(names)
    found, at = X.shingles(hashes, rows, len(texts))
    expected = [max(1, len(w) - 4) if w else 0 for w in plain]
    assert np.bincount(at, minlength=len(texts)).tolist() == expected
    keys = [tuple(k) for k in X.sequence_keys(hashes, rows, len(texts)).tolist()]
    for i, a in enumerate(plain):
        for j, b in enumerate(plain):
            assert (keys[i] == keys[j]) == (a == b)


def test_chunks_keep_every_row_and_long_texts_whole():
    texts = pa.chunked_array([pa.array(["a" * 10, None, ""]), pa.array(["b" * 3000, "c"])])
    got = [(f, e, len(d)) for f, e, d, _ in X.chunks(texts, 100)]
    assert [g[0] for g in got][0] == 0 and got[-1][1] == 5 and sum(g[2] for g in got) == 3011


@settings(deadline=None, max_examples=60)
@given(st.lists(st.tuples(st.integers(0, 2**17 - 1), st.integers(1, 2**31 - 1)), min_size=1, max_size=50, unique_by=lambda x: x[0]))
def test_packed_features_are_read_back(pairs):
    ids, counts = np.array(sorted(pairs), np.int64).T
    got_ids, got_counts = S.unpack(S.pack(ids.astype(np.int32), counts))
    assert got_ids.tolist() == ids.tolist() and got_counts.tolist() == counts.tolist()


def test_prob_minhash_estimates_the_probability_jaccard():
    rng = np.random.default_rng(1)
    a, b = np.arange(1, 101, dtype=np.uint64), np.arange(31, 131, dtype=np.uint64)
    wa, wb = rng.integers(1, 5, 100).astype(float), rng.integers(1, 5, 100).astype(float)
    sig = near.prob_minhash(np.concatenate([a, b]), np.repeat([0, 1], 100), np.concatenate([wa, wb]), 3, 4000)
    x, y = dict(zip(a.tolist(), wa)), dict(zip(b.tolist(), wb))
    every = set(x) | set(y)
    exact = sum(1 / sum(max(x.get(j, 0) / x[i], y.get(j, 0) / y[i]) for j in every) for i in x if i in y)
    assert abs((sig[0] == sig[1]).mean() - exact) < 0.04
    assert (sig[2] == 0).all()  # a row without elements


def test_hilbert_visits_every_cell_by_single_steps():
    for dims, bits in ((2, 3), (3, 2), (4, 2)):
        cells = np.stack(np.meshgrid(*[np.arange(1 << bits)] * dims, indexing="ij"), -1).reshape(-1, dims)
        key = neighbours.hilbert(cells, bits)
        assert sorted(key.tolist()) == list(range(len(cells)))
        assert (np.abs(np.diff(cells[np.argsort(key)], axis=0)).sum(1) == 1).all()


@settings(deadline=None, max_examples=80)
@given(st.binary(min_size=1, max_size=60).map(lambda b: bytes(b"0123456789abcdefXYZ+"[c % 20] for c in b)))
def test_entropy_by_counts_equals_entropy_afresh(candidate):
    marked = set()
    for members, level in secrets.CLASSES.values():
        for i in range(len(candidate) - secrets.WINDOW + 1):
            w = candidate[i : i + secrets.WINDOW]
            if any(c not in members for c in w):
                continue
            p = np.unique(np.frombuffer(w, np.uint8), return_counts=True)[1] / len(w)
            mixed = re.search(rb"[0-9]", w) and re.search(rb"[A-Za-z]", w)
            if mixed and -(p * np.log2(p)).sum() >= level - 1e-9:
                marked |= set(range(i, i + secrets.WINDOW))
    got = {i for a, b in secrets.entropy_spans(candidate) for i in range(a, b)}
    assert got == marked


def test_entropy_spans_of_a_long_run_need_little_memory():
    rng = np.random.default_rng(3)
    run = bytes(np.frombuffer(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/", np.uint8)[rng.integers(0, 64, 200_000)])
    tracemalloc.start()
    spans = secrets.entropy_spans(run)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert sum(e - b for b, e in spans) > 0.9 * len(run) and all(x[1] < y[0] for x, y in zip(spans, spans[1:], strict=False))
    assert peak < 12 * len(run)


def test_random_tokens_of_usual_alphabets_get_a_span():
    rng = np.random.default_rng(17)
    low, up, digits = b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789"
    # missed: 1 % by entropy, and what has no digit, 3.3 % of 20 characters of base64
    for members, least in ((digits + b"abcdef", 0.98), (low + digits, 0.97), (up + digits, 0.97), (up + b"234567", 0.96), (low + up + digits + b"+/", 0.94)):
        tokens = [bytes(members[i] for i in rng.integers(0, len(members), secrets.WINDOW)) for _ in range(1000)]
        assert sum(secrets.entropy_spans(t) == [(0, secrets.WINDOW)] for t in tokens) >= least * len(tokens)


def test_what_stands_beside_an_allowed_string_is_scanned():
    def spans(run):
        return [(b, e) for b, kind, e in secrets.row_spans(run, [], [(0, len(run))], secrets.ALLOWED) if kind == 3]

    listed, key = secrets.ALLOWED[0], b"q7RtZ1mXw9Kc4VbN0sLpY3hGd8Jf"
    n, k = len(listed), len(key)
    assert spans(key) == [(0, k)] and spans(listed) == spans(listed * 2) == spans(listed + b"/short1") == []
    assert spans(listed + key) == [(n, n + k)] and spans(key + listed) == [(0, k)]
    assert spans(key + listed + key + secrets.ALLOWED[1]) == [(0, k), (k + n, k + n + k)]


@settings(deadline=None, max_examples=80)
@given(st.text(alphabet="&<[>;lt#91 \nax/|", max_size=40), st.sampled_from(["user", "assistant", "a\nb<"]))
def test_template_is_reversible_and_hides_control_strings(text, role):
    piece = chats.template([(role, text)])
    assert chats.read_back(piece) == (role, text)
    assert "<" not in chats.escape(text) and "[" not in chats.escape(text)
    out, lo, hi, rewritten = chats.locate(chats.template, [("user", "x")], (role, text), chats.template([("user", "x")]))
    assert chats.unescape(out[lo:hi]) == text and not rewritten


def test_a_template_that_rewrites_history_is_detected():
    def render(turns):  # only the last turn keeps its text
        return "".join(f"<{r}>{t if i == len(turns) - 1 else '-'}\n" for i, (r, t) in enumerate(turns))

    base = render([("user", "hello")])
    assert chats.locate(render, [("user", "hello")], ("assistant", "x"), base)[3]
