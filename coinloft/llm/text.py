"""Array kernels over the UTF-8 bytes of many texts at once: words, word hashes and word shingles.

A word is a run of bytes that are digits, letters a-z after lower-casing A-Z, or above 0x7F. All hashes are fixed
functions of the bytes, so a task that runs again on another executor gives the same values.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

SHINGLE = 5  # words
CHUNK = 1 << 18  # bytes of text per array pass
PIECE = 1 << 22  # a longer text is read in pieces of this size where a sum over its parts is all that is wanted

_U = np.uint64
_MULTIPLIER = _U(0x9E3779B97F4A7C15)
_INVERSE = _U(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


def row_prints(key: str = "doc_id", text: str = "text") -> tuple[Column, Column]:
    """128 bits that tell a document, a key with a text, from any other; never null, also where key or text is."""
    marked = [F.col(key).isNull(), F.col(key), F.col(text).isNull(), F.col(text)]
    return F.xxhash64(F.lit(1), *marked), F.xxhash64(F.lit(2), *marked)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection on 64-bit words that spreads every input bit over all output bits."""
    x = x ^ (x >> _U(30))
    x = x * _U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> _U(27))
    x = x * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def seeds(count: int, seed: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return mix(np.arange(1, count + 1, dtype=np.uint64) * _MULTIPLIER + _U(seed))


def _fold() -> np.ndarray:
    """Byte to lower case, and to 0 where it is no part of a word."""
    table = np.zeros(256, np.uint8)
    for b in range(256):
        c = b + 32 if 65 <= b <= 90 else b
        if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128:
            table[b] = c
    return table


FOLD = _fold()
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
_BYTE = seeds(256, 7)
_powers: dict[str, np.ndarray] = {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers["up"]) < n:
        size = max(n, CHUNK + 1)
        for name, base in (("up", _MULTIPLIER), ("down", _INVERSE)):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _powers[name] = np.cumprod(steps)
    return _powers["up"][:n], _powers["down"][:n]


def chunks(texts: pa.Array | pa.ChunkedArray, limit: int = CHUNK) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets of rows in the bytes), about ``limit`` bytes each; null reads as empty."""
    for part, base in _parts(texts):
        offsets, data = part
        first = 0
        while first < len(offsets) - 1:
            end = int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1
            end = min(max(end, first + 1), len(offsets) - 1)
            yield base + first, base + end, data[offsets[first] : offsets[end]], offsets[first : end + 1] - offsets[first]
            first = end


def _parts(texts):
    base = 0
    for part in texts.chunks if isinstance(texts, pa.ChunkedArray) else [texts]:
        part = part.cast(pa.large_string())
        if part.null_count:
            part = part.fill_null("")
        if len(part):
            _, off, data = part.buffers()
            offsets = np.frombuffer(off, np.int64)[part.offset : part.offset + len(part) + 1]
            yield (offsets, np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)), base
        base += len(part)


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hash of every word, and the row (0 .. n-1) it stands in."""
    folded = FOLD[data]
    inside = folded != 0
    before = np.empty_like(inside)
    after = np.empty_like(inside)
    if len(inside):
        before[0], after[-1] = False, False
        before[1:], after[:-1] = inside[:-1], inside[1:]
        starts_of_rows = offsets[:-1][offsets[:-1] < len(data)]
        before[starts_of_rows] = False
        after[starts_of_rows[starts_of_rows > 0] - 1] = False
    start = np.flatnonzero(inside & ~before)
    end = np.flatnonzero(inside & ~after) + 1
    with np.errstate(over="ignore"):
        up, down = _power(len(data) + 1)
        total = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(_BYTE[folded] * up[: len(data)], out=total[1:])
        hashes = mix((total[end] - total[start]) * down[start] + (end - start).astype(np.uint64))
    return hashes, np.searchsorted(offsets, start, "right") - 1


def shingles(hashes: np.ndarray, rows: np.ndarray, n_rows: int, width: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hash of every run of ``width`` words, and its row. A row with fewer words is one shingle; with none, none."""
    if not len(hashes):
        return hashes, rows
    factors = seeds(width, 11) | _U(1)
    count = np.bincount(rows, minlength=n_rows)
    with np.errstate(over="ignore"):
        whole = len(hashes) - width + 1
        out, at = np.zeros(0, np.uint64), np.zeros(0, rows.dtype)
        if whole > 0:
            keep = np.flatnonzero(rows[:whole] == rows[width - 1 :])
            out = sum((hashes[keep + k] * factors[k] for k in range(width)), np.zeros(len(keep), np.uint64))
            at = rows[keep]
        short = np.flatnonzero((count > 0) & (count < width))
        if len(short):
            first = np.searchsorted(rows, short)
            total = np.full(len(short), 1, np.uint64)
            for k in range(width - 1):
                has = count[short] > k
                total += np.where(has, hashes[np.minimum(first + k, len(hashes) - 1)], _U(0)) * factors[k]
            out, at = np.concatenate([out, total]), np.concatenate([at, short])
        return mix(out), at


def sequence_keys(hashes: np.ndarray, rows: np.ndarray, n_rows: int) -> np.ndarray:
    """Two 64-bit keys per row of its whole word sequence; rows without words get zeros."""
    out = np.zeros((n_rows, 2), np.uint64)
    if not len(hashes):
        return out
    present, first, count = np.unique(rows, return_index=True, return_counts=True)
    up, down = _power(len(hashes) + 1)
    with np.errstate(over="ignore"):
        for k, seed in enumerate((3, 5)):
            total = np.zeros(len(hashes) + 1, np.uint64)
            np.cumsum(mix(hashes + _U(seed)) * up[: len(hashes)], out=total[1:])
            out[present, k] = mix((total[first + count] - total[first]) * down[first] + count.astype(np.uint64) + _U(seed))
    return out
