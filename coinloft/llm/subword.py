"""Supervised subword embeddings: hashed word and character n-gram vectors, averaged per text, under a softmax.

Training runs on the driver in numpy over a bounded sample (``max_rows`` texts), whose hashed features the executors
extract. As the average and the softmax weights are linear, the trained model folds into one table of class
scores per hash bucket; scoring adds table entries over the whole text and needs neither the vectors nor a second model.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from coinloft.llm import text as X

_U = np.uint32
LEAST_STEPS = 4000  # a small sample is passed over more often


@dataclass
class Features:
    """Which hashed features a text has. ``grams`` are lengths in bytes; ``raw`` keeps blanks and punctuation in them."""

    bits: int = 17
    grams: tuple[int, ...] = (3, 4)
    words: bool = True
    repeats: bool = False  # a mark wherever a word follows itself
    raw: bool = True


def _gram_buckets(data: np.ndarray, offsets: np.ndarray, f: Features) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Buckets at every byte position, and where the n-gram lies whole in its row."""
    folded = X.LOWER[data] if f.raw else X.FOLD[data]
    table = (X.seeds(256, 23) >> np.uint64(32)).astype(_U)[folded]
    crossing = np.zeros(len(data) + 1, np.int32)
    np.add.at(crossing, offsets[1:-1], 1)
    row = np.cumsum(crossing[: len(data)])
    for n in f.grams:
        size = len(data) - n + 1
        if size <= 0:
            continue
        value = np.full(size, 0x9E3779B9 * n & 0xFFFFFFFF, _U)
        for k in range(n):
            value = (value ^ table[k : k + size]) * _U(0x85EBCA6B)
            value ^= value >> _U(15)
        whole = row[:size] == row[n - 1 :]
        if not f.raw:
            for k in range(n):
                whole &= folded[k : k + size] != 0
        yield value >> _U(32 - f.bits), whole


def buckets(data: np.ndarray, offsets: np.ndarray, f: Features) -> tuple[np.ndarray, np.ndarray]:
    """(bucket, row) of every feature occurrence."""
    out, at = [], []
    for value, whole in _gram_buckets(data, offsets, f):
        keep = np.flatnonzero(whole)
        out.append(value[keep])
        at.append(np.searchsorted(offsets, keep, "right") - 1)
    if f.words:
        hashes, rows = X.words(data, offsets)
        out.append((hashes >> np.uint64(64 - f.bits)).astype(_U))
        at.append(rows)
        if f.repeats and len(hashes) > 1:
            same = np.flatnonzero((hashes[1:] == hashes[:-1]) & (rows[1:] == rows[:-1]))
            out.append(np.zeros(len(same), _U))
            at.append(rows[same])
    return np.concatenate(out) if out else np.zeros(0, _U), np.concatenate(at) if at else np.zeros(0, np.int64)


def pack(ids: np.ndarray, counts: np.ndarray) -> bytes:
    """Ascending ids as gaps, then their counts, byte place by byte place: about an eighth of the plain numbers."""
    numbers = np.concatenate([np.diff(ids, prepend=0), counts]).astype("<u4")
    return zlib.compress(numbers.view(np.uint8).reshape(-1, 4).T.tobytes())


def unpack(packed: bytes) -> tuple[np.ndarray, np.ndarray]:
    numbers = np.ascontiguousarray(np.frombuffer(zlib.decompress(packed), np.uint8).reshape(4, -1).T).view("<u4").ravel()
    gaps, counts = numbers[: len(numbers) // 2], numbers[len(numbers) // 2 :]
    return np.cumsum(gaps, dtype=np.int32), counts


def _extract(f: Features):
    """Distinct buckets and their counts per text, packed; null for a text without any."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, end, data, offsets in X.chunks(batch.column("text")):
                bucket, row = buckets(data, offsets, f)
                key, count = np.unique(row.astype(np.uint64) << np.uint64(32) | bucket, return_counts=True)
                cut = np.searchsorted(key >> np.uint64(32), np.arange(end - first + 1))
                ids = (key & np.uint64(0xFFFFFFFF)).astype(np.int32)
                packed = [pack(ids[a:b], count[a:b]) if b > a else None for a, b in zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True)]
                rest = batch.slice(first, end - first)
                yield pa.RecordBatch.from_arrays([rest.column("key"), rest.column("label"), pa.array(packed, pa.binary())], ["key", "label", "packed"])

    return run


def sample_features(docs: DataFrame, known: DataFrame, key: str, f: Features, max_rows: int) -> list[tuple[str, np.ndarray, np.ndarray]]:
    """(label, buckets, shares) of at most ``max_rows`` texts: those of ``known(key, label)`` with the smallest key hash.

    The choice moves keys only; then the chosen ones, whose number is bounded, are broadcast to the texts. Null labels
    and texts are left out. Repeated rows of ``docs`` are examples each.
    """
    labelled = known.select(F.col(key).alias("k"), F.col("label").cast("string").alias("label")).where("label is not null").distinct()
    present = labelled.join(docs.select(F.col(key).alias("k")), "k", "left_semi")
    chosen = F.broadcast(present.orderBy(F.xxhash64("k", F.lit(17)), "k", "label").limit(max_rows))
    texts = docs.select(F.col(key).alias("k"), "text").where(F.col("text").isNotNull()).join(chosen, "k")
    chosen = texts.select(F.col("k").cast("string").alias("key"), "label", "text")
    rows = chosen.repartition(16, "key").mapInArrow(_extract(f), "key string, label string, packed binary").toArrow()
    # a text of k features sends about k bytes; the count of texts is bounded, so is the model's input
    order = np.lexsort((np.asarray(rows["label"].to_pylist()), np.asarray(rows["key"].to_pylist()))) if rows.num_rows else []
    labels, packed = rows["label"].to_pylist(), rows["packed"]
    out = []
    for i in map(int, order):
        if packed[i].is_valid:
            ids, counts = unpack(packed[i].as_py())
            share = counts.astype(np.float32)
            out.append((labels[i], ids, share / share.sum()))
    return out


@dataclass
class Model:
    """Class scores per bucket. A text's logits are ``bias`` plus the mean of its buckets' rows over ``temperature``."""

    features: Features
    labels: list[str]
    table: np.ndarray
    bias: np.ndarray
    temperature: float = 1.0
    reject_below: float = 0.0
    notes: dict = field(default_factory=dict)


def train(
    examples: list[tuple[str, np.ndarray, np.ndarray]], f: Features, dim: int = 12, epochs: int = 6, rate: float = 0.5,
    seed: int = 1, held: int = 5,
) -> Model:
    """Stochastic gradient descent, one text a step, the rate falling to zero; every ``held``-th text calibrates.

    The held texts choose the temperature (least log loss). With one class, that class is always predicted; with no
    example at all the model has no label and scores are empty.
    """
    labels = sorted({x[0] for x in examples})
    k = len(labels)
    rng = np.random.default_rng(seed)
    vectors = ((rng.random((1 << f.bits, dim), np.float32) - 0.5) / dim).astype(np.float32)
    weights, bias = np.zeros((dim, max(k, 1)), np.float32), np.zeros(max(k, 1), np.float32)
    position = {x: i for i, x in enumerate(labels)}
    fit = [e for i, e in enumerate(examples) if i % held or len(examples) < 50]
    check = [e for i, e in enumerate(examples) if i % held == 0]
    epochs = max(epochs, -(-LEAST_STEPS // max(len(fit), 1)))
    steps, done = epochs * len(fit), 0
    for _ in range(epochs if k > 1 else 0):
        for i in rng.permutation(len(fit)):
            label, ids, share = fit[i]
            now = rate * (1 - done / steps)
            done += 1
            own = vectors[ids]
            hidden = share @ own
            p = _softmax(hidden @ weights + bias)
            p[position[label]] -= 1
            back = weights @ p
            weights -= now * np.outer(hidden, p)
            bias -= now * p
            # a bucket's step follows its share, scaled so that long texts still move their buckets
            vectors[ids] = own - now * np.outer(share * (len(ids) ** 0.5), back)
    model = Model(f, labels, (vectors @ weights).astype(np.float32), bias)
    if k > 1 and check:
        logits = np.stack([share @ model.table[ids] + bias for _, ids, share in check]).astype(np.float64)
        truth = np.array([position[x[0]] for x in check])
        grid = np.geomspace(0.25, 8, 41)
        loss = [-np.log(np.maximum(_softmax(logits / t)[np.arange(len(truth)), truth], 1e-12)).mean() for t in grid]
        model.temperature = float(grid[int(np.argmin(loss))])
        p = _softmax(logits / model.temperature)
        model.notes = {"held": len(truth), "accuracy": float((p.argmax(1) == truth).mean()), "top": p.max(1), "right": p.argmax(1) == truth}
    return model


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(-1, keepdims=True))
    return e / e.sum(-1, keepdims=True)


def score(texts: pa.Array, model: Model) -> tuple[np.ndarray, np.ndarray]:
    """(class probabilities, features counted) per text, over whole texts; a text without features gets the bias alone."""
    n, k = len(texts), len(model.labels)
    total, count = np.zeros((n, k)), np.zeros(n)
    f = model.features
    for first, end, data, offsets in _pieces(texts):
        starts = offsets[:-1]
        full = np.flatnonzero(offsets[1:] > starts)
        if not len(full):
            continue
        for value, whole in _gram_buckets(data, offsets, f):
            begin = starts[full]
            ok = begin < len(value)
            begin, rows = begin[ok], first[full[ok]]
            if not len(begin):
                continue
            np.add.at(count, rows, np.add.reduceat(whole, begin, dtype=np.int64))
            for c in range(k):
                np.add.at(total[:, c], rows, np.add.reduceat(model.table[:, c][value] * whole, begin, dtype=np.float64))
        if f.words:
            hashes, at = X.words(data, offsets)
            bucket, rows = (hashes >> np.uint64(64 - f.bits)).astype(np.int64), first[at]
            if f.repeats and len(hashes) > 1:
                same = np.flatnonzero((hashes[1:] == hashes[:-1]) & (at[1:] == at[:-1]))
                bucket, rows = np.concatenate([bucket, np.zeros(len(same), np.int64)]), np.concatenate([rows, rows[same]])
            count += np.bincount(rows, minlength=n)
            for c in range(k):
                total[:, c] += np.bincount(rows, model.table[bucket, c], minlength=n)
    logits = total / np.maximum(count, 1)[:, None] + model.bias[:k]
    return _softmax(logits / model.temperature) if k else np.zeros((n, 0)), count


def _pieces(texts: pa.Array):
    """Chunks whose rows carry their row number; a text over PIECE bytes comes in several rows, cut after a blank."""
    for first, end, data, offsets in X.chunks(texts):
        if len(data) <= X.PIECE:
            yield np.arange(first, end), end, data, offsets
            continue
        begin = 0
        while begin < len(data):
            stop = min(begin + X.PIECE, len(data))
            if stop < len(data):
                blank = np.flatnonzero(data[stop - 4096 : stop] == 32)
                stop = stop - 4096 + int(blank[-1]) + 1 if len(blank) else stop
            yield np.array([first]), end, data[begin:stop], np.array([0, stop - begin])
            begin = stop
