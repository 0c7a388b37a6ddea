"""Toxicity: a factorization machine over hashed terms.

The score of a text is sigmoid(b + sum w_i x_i + sum over pairs i < j of <v_i, v_j> x_i x_j), with one weight and one
short factor vector per hash bucket. The pair term lets two terms that are harmless alone (an insult, a group's name)
raise the score together, which a sum of weights cannot. It costs one pass over the terms of a text, as
sum over pairs <v_i, v_j> x_i x_j = (|sum v_i x_i|^2 - sum |v_i x_i|^2) / 2.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from coinloft.llm import subword as S

TERMS = S.Features(bits=18, grams=(5,), words=True, raw=False)  # words, and runs of five bytes inside them
MAX_ROWS = 3000  # labelled texts a model is fitted on
FACTORS = 8
LEAST_TEXTS = 3  # sampled texts that must hold a term for it to be learned
THRESHOLD = 0.7


def held_out(key: str = "doc_id") -> Column:
    """Rows whose key's CRC leaves 1 on division by 3 are never learned from; a null key is held out."""
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % 3 == 1, F.lit(True))


@dataclass
class Machine:
    """``rarity`` is a learned term's log inverse share of sampled texts and 0 for any other; a text's x are the rarities of its
    distinct terms, scaled to unit length."""

    bias: float
    rarity: np.ndarray
    weights: np.ndarray
    factors: np.ndarray  # (buckets, FACTORS)
    slope: float = 1.0
    shift: float = 0.0


def _sigmoid(z):
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def inputs(ids: np.ndarray, rarity: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The learned ones of these distinct buckets, and their x."""
    ids = ids[rarity[ids] > 0]
    x = rarity[ids]
    return ids, (x / max(float(np.sqrt((x * x).sum())), 1e-9)).astype(np.float32)


def raw_score(ids: np.ndarray, m: Machine) -> float:
    """The machine's value of one text with these distinct buckets, pair by pair as its formula has it, but in one pass."""
    ids, x = inputs(ids, m.rarity)
    v = m.factors[ids] * x[:, None]
    total = v.sum(0)
    return float(m.bias + x @ m.weights[ids] + (total @ total - (v * v).sum()) / 2)


def train(examples: list[tuple[str, np.ndarray, np.ndarray]], positive: str = "1", epochs: int = 8, rate: float = 1.0,
          shrink: float = 5e-3, decay: float = 1e-5, factor_rate: float = 0.1, seed: int = 1, held: int = 5) -> Machine:
    """Stochastic gradient descent on the log loss, one text a step, the steps of a bucket falling with its gradients so far.

    Each step moves the weights it touches towards 0 by ``shrink`` times their step size, so that most terms keep none. Every
    ``held``-th text is kept apart and fits the slope and shift that turn values into probabilities. With one
    label only every text gets it; without any example the score is 0.
    """
    labels = {x[0] for x in examples}
    rng = np.random.default_rng(seed)
    size = 1 << TERMS.bits
    m = Machine(0.0, np.zeros(size, np.float32), np.zeros(size, np.float32), np.zeros((size, FACTORS), np.float32))
    if len(labels) < 2:
        m.bias = 40.0 if positive in labels else -40.0
        return m
    apart = len(examples) >= 50
    texts = [e for i, e in enumerate(examples) if i % held or not apart]
    seen = np.zeros(size, np.int32)
    for _, ids, _ in texts:
        seen[ids] += 1
    m.rarity = np.where(seen >= min(LEAST_TEXTS, len(texts)), np.log((len(texts) + 1) / np.maximum(seen, 1)), 0).astype(np.float32)
    m.factors = (rng.standard_normal((size, FACTORS)) * 0.02).astype(np.float32) * (m.rarity > 0)[:, None]
    fit = [(float(label == positive), *inputs(ids, m.rarity)) for label, ids, _ in texts]
    share = sum(y for y, _, _ in fit) / len(fit)
    m.bias = float(np.log(max(share, 1e-3) / max(1 - share, 1e-3)))
    used_w, used_v, used_b = np.full(size, 1e-2, np.float32), np.full(size, 1e-2, np.float32), 1.0
    for _ in range(max(epochs, -(-S.LEAST_STEPS // len(fit)))):
        for i in rng.permutation(len(fit)):
            y, ids, x = fit[i]
            w, v = m.weights[ids], m.factors[ids]
            vx = v * x[:, None]
            total = vx.sum(0)
            g = float(_sigmoid(m.bias + x @ w + (total @ total - (vx * vx).sum()) / 2)) - y
            used_b += g * g
            m.bias -= rate * g / used_b**0.5
            back = g * x + decay * w
            used_w[ids] += back * back
            step = rate / np.sqrt(used_w[ids])
            w = w - step * back
            m.weights[ids] = np.sign(w) * np.maximum(np.abs(w) - step * shrink, 0)
            back = g * x[:, None] * (total - vx) + decay * v
            used_v[ids] += (back * back).mean(1)
            m.factors[ids] = v - factor_rate * rate / np.sqrt(used_v[ids])[:, None] * back
    check = [e for i, e in enumerate(examples) if i % held == 0] if apart else []
    if len({e[0] for e in check}) == 2:
        z = np.array([raw_score(ids, m) for _, ids, _ in check])
        m.slope, m.shift = _calibrated(z, np.array([e[0] == positive for e in check], float))
    return m


def _calibrated(z: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and shift of least log loss, the targets drawn in by one example of each kind, by Newton steps."""
    n1, n0 = y.sum(), len(y) - y.sum()
    t = np.where(y > 0, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    scale = max(float(np.abs(z).mean()), 1e-9)
    a = np.stack([z / scale, np.ones_like(z)], 1)
    theta = np.array([1.0, 0.0])
    for _ in range(50):
        p = _sigmoid(a @ theta)
        h = (a * (p * (1 - p))[:, None]).T @ a + 1e-3 * np.eye(2)
        step = np.linalg.solve(h, a.T @ (p - t) + 1e-3 * (theta - [1.0, 0.0]))
        theta = theta - np.clip(step, -1, 1)
        if np.abs(step).max() < 1e-9:
            break
    return max(float(theta[0]) / scale, 1e-6), float(theta[1])


def fit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", label: str = "toxic", max_rows: int = MAX_ROWS) -> Machine:
    """Learn ``label`` from the texts outside the held-out fold; null labels and null texts are left out.

    A document labelled twice is two examples. Only the text is an input.
    """
    known = labels.where(~held_out(key)).select(key, F.col(label).alias("label"))
    return train(S.sample_features(docs, known, key, TERMS, max_rows))


def distinct_terms(texts: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, buckets, their rows), ordered by row; every bucket once a text. Long texts come piece by piece."""
    mask = np.zeros(1 << TERMS.bits, bool)  # buckets of a text that comes in several pieces
    open_row = -1

    def close() -> tuple[int, int, np.ndarray, np.ndarray]:
        ids = np.flatnonzero(mask)
        mask[ids] = False
        return open_row, open_row + 1, ids, np.zeros(len(ids), np.int64)

    for first, _, data, offsets in S._pieces(texts):
        bucket, row = S.buckets(data, offsets, TERMS)
        if len(first) == 1:
            if open_row not in (-1, int(first[0])):
                yield close()
            open_row = int(first[0])
            mask[bucket] = True
            continue
        if open_row >= 0:
            yield close()
            open_row = -1
        key = np.unique(row.astype(np.uint64) << np.uint64(32) | bucket)
        yield int(first[0]), int(first[-1]) + 1, (key & np.uint64(0xFFFFFFFF)).astype(np.int64), (key >> np.uint64(32)).astype(np.int64)
    if open_row >= 0:
        yield close()


def values(texts: pa.Array, m: Machine) -> tuple[np.ndarray, np.ndarray]:
    """(probability, learned terms) per text, over whole texts; a text without a learned term gets the bias alone."""
    z, count = np.full(len(texts), m.bias), np.zeros(len(texts), np.int64)
    for first, end, ids, rows in distinct_terms(texts):
        known = m.rarity[ids] > 0
        ids, rows = ids[known], rows[known]
        n = np.bincount(rows, minlength=end - first)
        full = np.flatnonzero(n)
        if not len(full):
            continue
        begin = np.searchsorted(rows, full)
        x = m.rarity[ids].astype(np.float64)
        x /= np.sqrt(np.bincount(rows, x * x))[rows]
        value = np.add.reduceat(x * m.weights[ids], begin)
        for k in range(FACTORS):
            v = x * m.factors[ids, k]
            value += (np.add.reduceat(v, begin) ** 2 - np.add.reduceat(v * v, begin)) / 2
        z[first + full] += value
        count[first + full] = n[full]
    return _sigmoid(m.slope * z + m.shift), count


def _scorer(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            p, count = values(batch.column("text"), shared.value)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(p, pa.float64()), pa.array(count)], [*batch.schema.names, "score", "n_terms"])

    return run


def score(docs: DataFrame, machine: Machine) -> DataFrame:
    """``docs`` with ``score`` (0 to 1, higher: more toxic) and ``n_terms``, one row per input row, in one pass.

    A null, empty or wordless text gets the score of the bias alone, like one without a learned term. Columns named score or n_terms are replaced.
    """
    docs = docs.drop("score", "n_terms")
    schema = T.StructType([*docs.schema.fields, T.StructField("score", T.DoubleType()), T.StructField("n_terms", T.LongType())])
    shared = docs.sparkSession.sparkContext.broadcast(machine)  # 2^18 buckets of ten numbers, whatever the input's size
    return docs.mapInArrow(_scorer(shared), schema)


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted, n_terms per document; repeated rows are scored each, an empty table gives none."""
    out = score(docs.select("doc_id", "text"), fit(docs, labels))
    return out.select(
        "doc_id", held_out().alias("held_out"), "score", F.when(F.col("score") >= THRESHOLD, 1).otherwise(0).alias("predicted"),
        "n_terms",
    )
