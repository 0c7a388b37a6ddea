"""Phrase collocations by top-order marginalisation: one count of the longest windows, shorter phrases by ROLLUP.

Every word starts one window of four lead columns, padded where its piece of text ends. Only these windows are counted; the
occurrences of every shorter phrase are sums over the windows that begin with it, which Spark's ROLLUP forms. ROLLUP writes a
row up to five times, so it gets each window once, with its count over the whole table.

Counts of phrases under the threshold are never needed, as a candidate's parts occur at least as often as it does. So the
windows are sieved first: one pass counts hashed words and pairs exactly, a second one hashed triples of frequent pairs, and
a filter sized by their number takes the frequent ones. A window is padded from its first rare pair or triple on. The filter and
hash collisions err to one side only: what they let through is counted like anything else, so results do not depend on them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from coinloft.llm import text as X
from coinloft.llm.licences import LOWER, UPPER
from coinloft.session import cut_lineage

ORDER = 4  # words of the longest phrase
LEAST = 30  # occurrences of a candidate
HELD_IN = 80  # per cent of its occurrences within one longer candidate that drop a phrase
SCALE = 2_000_000
TOP = 2000  # phrases reported per language
KEY_BITS = 48  # of a hash
KEY_SHARE = 16  # bits of the filter for each frequent word and pair, so that few rare ones pass
FILTER_BITS = 1 << 26  # 8 MB, the least size of the filter
MOST_BITS = 1 << 29  # 64 MB, its largest size; a fuller filter lets more windows through and changes no result
CHUNK = 1 << 20  # bytes of text per array pass
_U = np.uint64

_KIND = np.zeros(256, np.uint8)  # 0 in a word, 1 between words, 2 between pieces
_KIND[[0x20, 0x09]] = 1
_KIND[list(b".,;:!?\n\x0b\x0c\r")] = 2


def _passes(texts: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray, int]]:
    """(first row, bytes, offsets of rows, byte at which windows no longer begin), about CHUNK bytes each.

    A text longer than that comes in several passes. A pass ends after a word and holds the next words too, up to three of the same
    piece, so that every window is whole in the pass where it begins.
    """
    for first, _, data, offsets in X.chunks(texts, CHUNK):
        if len(data) <= 2 * CHUNK:
            yield first, data, offsets, len(data)
            continue
        begin = 0
        while begin < len(data):
            cut = _after_words(data, min(begin + CHUNK, len(data)), 1)
            stop = _after_words(data, cut, ORDER)
            yield first, data[begin:stop], np.array([0, stop - begin]), cut - begin
            begin = cut


def _after_words(data: np.ndarray, at: int, words: int) -> int:
    """The end of the ``words``-th word that ends after ``at``, or of the data."""
    size = 1 << 12
    while True:
        part = _KIND[data[at : at + size]] > 0
        ends = np.flatnonzero(part[1:] & ~part[:-1]) + 1
        if len(ends) >= words:
            return at + int(ends[words - 1])
        if at + size >= len(data):
            return len(data)
        size *= 4


class _Words:
    """The words of some texts: code of each in ``names``, row, byte it starts at, and whether the next one follows in its piece."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        data = X.LOWER[data]
        kind = _KIND[data]
        inside = kind == 0
        edge = np.zeros(len(data) + 1, bool)  # a row begins here
        edge[offsets] = True
        start = np.flatnonzero(inside & (edge[:-1] | ~np.concatenate([[False], inside[:-1]])))
        end = np.flatnonzero(inside & (edge[1:] | ~np.concatenate([inside[1:], [False]]))) + 1
        self.start, self.row = start, np.searchsorted(offsets, start, "right") - 1
        breaks = np.cumsum(kind == 2, dtype=np.int32)
        self.follows = np.zeros(len(start), bool)  # by the word after it
        self.follows[:-1] = (self.row[1:] == self.row[:-1]) & (breaks[start[1:]] == breaks[end[:-1] - 1])
        body = data[inside]
        cut = np.zeros(len(start) + 1, np.int64)
        np.cumsum(end - start, out=cut[1:])
        every = pa.LargeStringArray.from_buffers(len(start), pa.py_buffer(cut), pa.py_buffer(body.tobytes()))
        coded = every.dictionary_encode()
        self.code = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        self.names = coded.dictionary

    def hashes(self) -> np.ndarray:
        """A 64-bit hash of each name."""
        _, off, body = self.names.buffers()
        offsets = np.frombuffer(off, np.int64)[: len(self.names) + 1]
        body = np.frombuffer(body, np.uint8) if body is not None and len(self.names) else np.zeros(0, np.uint8)
        up, down = X._power(len(body) + 1)
        with np.errstate(over="ignore"):
            total = np.zeros(len(body) + 1, _U)
            np.cumsum(X._BYTE[body] * up[: len(body)], out=total[1:])
            return X.mix((total[offsets[1:]] - total[offsets[:-1]]) * down[offsets[:-1]] + (offsets[1:] - offsets[:-1]).astype(_U))


def _lang_hashes(langs: list[str]) -> np.ndarray:
    return np.array([int.from_bytes(l.encode()[:256].ljust(8, b"\0")[:8], "little") ^ (len(l) << 48) for l in langs], _U)


def _keys(w: _Words, lang: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """48-bit hashes of every word, with the next one, and with the next two (0 where none follows), the language mixed in."""
    step = _U(0x9E3779B97F4A7C15)
    with np.errstate(over="ignore"):
        own = X.mix(w.hashes()[w.code] + lang[w.row])
        pair, triple = np.zeros(len(own), _U), np.zeros(len(own), _U)
        at = np.flatnonzero(w.follows)
        pair[at] = X.mix(own[at] * step + own[at + 1])
        at = at[w.follows[at + 1]]
        triple[at] = X.mix(pair[at] * step + own[at + 2])
    return own >> _U(16), pair >> _U(16), triple >> _U(16)


def _go_on(w: _Words, pair: np.ndarray, filter_: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Words that begin a pair the filter holds, and those whose next word does too."""
    one = w.follows & _held(filter_, pair)
    return one, one & np.append(one[1:], False)


def _key_counts(shared=None):
    """Hashed words and pairs of a pass, each with its count; with a filter, the triples whose two pairs it holds instead."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lang = _lang_hashes(batch.column("lang").to_pylist())
            for first, data, offsets, until in _passes(batch.column("text")):
                w = _Words(data, offsets)
                if not len(w.code):
                    continue
                own, pair, triple = _keys(w, lang[first:])
                mine = w.start < until
                found = np.concatenate([own[mine], pair[mine & w.follows]]) if shared is None else triple[mine & _go_on(w, pair, shared.value)[1]]
                key, n = np.unique(found, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array(n.astype(np.int64))], ["key", "n"])

    return run


def _bits(key: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Two bit numbers below ``bits`` for each key: its last bits and its first ones."""
    return (key & _U(bits - 1)).astype(np.int64), (key >> _U(KEY_BITS - bits.bit_length() + 1)).astype(np.int64)


def _frequent(keys: DataFrame, least: int) -> DataFrame:
    """The keys whose counts add up to ``least`` or more, stored."""
    return cut_lineage(keys.groupBy("key").agg(F.sum("n").alias("n")).where(F.col("n") >= least).select("key"), "frequent-keys")


def _size(keys: int) -> int:
    """Bits of a filter for so many words and pairs, a power of two."""
    return min(max(FILTER_BITS, 1 << (KEY_SHARE * keys - 1).bit_length()), MOST_BITS) if keys else FILTER_BITS


def _filled(keys: DataFrame, size: int) -> np.ndarray:
    """Bytes of a filter of ``size`` bits that holds every key."""
    bit = F.explode(F.array(F.col("key").bitwiseAND(size - 1), F.shiftrightunsigned("key", KEY_BITS - size.bit_length() + 1)))
    bits = keys.select(bit.alias("bit")).select((F.col("bit") + 1).alias("bit"))  # bucket b holds the numbers (b - 1) * 32768 + 1 to b * 32768
    blocks = bits.groupBy(F.bitmap_bucket_number("bit").alias("block")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("bit")).alias("map"))
    out = np.zeros(size // 8, np.uint8)
    for r in blocks.collect():  # at most size / 32768 rows of 4 KB
        at = (r["block"] - 1) * 4096
        out[at : at + 4096] = np.frombuffer(bytes(r["map"]), np.uint8)[: len(out) - at]
    return out


def frequent_filter(docs: DataFrame, least: int) -> np.ndarray:
    """A filter that holds every word, pair and triple, hashed with its language, of ``least`` or more occurrences."""
    counts = lambda shared=None: docs.mapInArrow(_key_counts(shared), "key long, n long")
    short = _frequent(counts(), least)
    held = _filled(short, _size(short.count()))
    return held | _filled(_frequent(counts(docs.sparkSession.sparkContext.broadcast(held)), least), len(held) * 8)


def _held(filter_: np.ndarray, key: np.ndarray) -> np.ndarray:
    a, b = _bits(key, len(filter_) * 8)
    return ((filter_[a >> 3] >> (a & 7).astype(np.uint8)) & (filter_[b >> 3] >> (b & 7).astype(np.uint8)) & 1).astype(bool)


def _codes(left: np.ndarray, right: np.ndarray, width: int) -> np.ndarray:
    """Dense codes of pairs of codes, the right ones below ``width``."""
    return np.unique(left * width + right, return_inverse=True)[1].reshape(-1)


def _windows(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filter_ = shared.value
        for batch in batches:
            tags = batch.column("lang").dictionary_encode()
            tag, hashed = tags.indices.to_numpy(zero_copy_only=False).astype(np.int64), _lang_hashes(batch.column("lang").to_pylist())
            for first, data, offsets, until in _passes(batch.column("text")):
                w = _Words(data, offsets)
                if not len(w.code):
                    continue
                own, pair, triple = _keys(w, hashed[first:])
                count, width = len(own), len(w.names) + 1
                one, two = _go_on(w, pair, filter_)
                two &= _held(filter_, triple)
                lead = np.zeros((ORDER, count), np.int64)  # 0: padding
                lead[0] = np.where(_held(filter_, own), w.code + 1, 0)
                whole = lead[0] > 0
                for k in range(1, min(ORDER, count)):
                    whole[: count - k] &= one[: count - k] if k == 1 else two[k - 2 : count - 2]
                    lead[k, : count - k] = np.where(whole[: count - k], w.code[k:] + 1, 0)
                mine = w.start < until
                lead, lang = lead[:, mine], tag[first:][w.row[mine]]
                code = _codes(lang, lead[0], width)
                for k in range(1, ORDER):
                    code = _codes(code, lead[k], width)
                _, at, n = np.unique(code, return_index=True, return_counts=True)
                word = [w.names.take(pa.array(lead[k, at] - 1, mask=lead[k, at] == 0)) for k in range(ORDER)]
                yield pa.RecordBatch.from_arrays(
                    [tags.dictionary.take(pa.array(lang[at])), *[x.cast(pa.string()) for x in word], pa.array(n.astype(np.int64))],
                    ["lang", *COLUMNS, "n"])

    return run


COLUMNS = [f"w{k + 1}" for k in range(ORDER)]


def phrase_counts(docs: DataFrame, least: int = LEAST) -> tuple[DataFrame, DataFrame]:
    """((lang, phrase, words, f) of every phrase of 1 to ORDER words with f >= least, (lang, n) words in all)."""
    spark: SparkSession = docs.sparkSession
    docs = docs.select("text", F.coalesce("lang", F.lit("und")).alias("lang"))
    shared = spark.sparkContext.broadcast(frequent_filter(docs, least))
    windows = docs.mapInArrow(_windows(shared), ", ".join(["lang string", *[f"{c} string" for c in COLUMNS], "n long"]))
    windows = windows.groupBy("lang", *COLUMNS).agg(F.sum("n").alias("n"))
    level = F.grouping_id()  # 15, 7, 3, 1, 0: windows summed over all but the first 0 to 4 words
    summed = windows.rollup("lang", *COLUMNS).agg(F.sum("n").alias("f"), level.alias("over")).where(f"over < {1 << ORDER}")
    words = F.lit(ORDER) - F.bit_count("over")
    last = F.when(words == 0, F.lit("")).otherwise(F.element_at(F.array(*COLUMNS), F.greatest(words, F.lit(1))))
    # a window padded within the prefix is no occurrence of a phrase of that many words
    summed = summed.where((words == 0) | last.isNotNull() & (F.col("f") >= least))
    summed = summed.select("lang", F.concat_ws(" ", *COLUMNS).alias("phrase"), words.alias("words"), "f")
    summed = cut_lineage(summed, "phrase-counts")
    return summed.where("words > 0"), summed.where("words = 0").select("lang", F.col("f").alias("n"))


def collocations(docs: DataFrame, least: int = LEAST, top: int = TOP) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the best phrases of two to four words per language.

    Null texts are empty, a null language is ``und``; repeated rows count each; a language without a candidate, and an empty table,
    give no row. Columns other than text and lang are ignored.
    """
    f, total = phrase_counts(docs, least)
    words = F.split("phrase", " ")
    candidate = f.where("words >= 2").select("lang", "phrase", "words", F.col("f").alias("a"))
    cut = F.explode(F.expr("transform(sequence(1, words - 1), k -> struct(k, array_join(slice(split(phrase, ' '), 1, k), ' ') as head, array_join(slice(split(phrase, ' '), k + 1, words), ' ') as tail))"))
    cuts = candidate.select("lang", "phrase", "a", cut.alias("c")).select("lang", "phrase", "a", "c.k", "c.head", "c.tail")
    head = f.select("lang", F.col("phrase").alias("head"), F.col("f").alias("l"))
    tail = f.select("lang", F.col("phrase").alias("tail"), F.col("f").alias("r"))
    cuts = cuts.join(head, ["lang", "head"]).join(tail, ["lang", "tail"])
    wide = lambda c: F.col(c).cast("decimal(20,0)")
    cuts = cuts.withColumns({"num": wide("a") * F.lit(SCALE), "den": wide("l") + wide("r")}).withColumn("score", F.expr("num div den"))
    scored = cuts.groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("b"))

    parts = F.explode(F.expr("flatten(transform(sequence(2, words - 1), m -> transform(sequence(1, words - m + 1), i -> array_join(slice(split(phrase, ' '), i, m), ' '))))"))
    within = candidate.where("words > 2").select("lang", "a", parts.alias("phrase")).groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    kept = scored.join(within, ["lang", "phrase"], "left").where(F.col("longer").isNull() | (wide("longer") * 100 < wide("a") * HELD_IN))
    best = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    kept = kept.select("lang", "phrase", "a", "b.l", "b.r", "b.score").withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= top)
    return kept.join(total, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def twin(least: int = LEAST, top: int = TOP) -> str:
    """The same rows in SQL, from all phrases of one to four words at every place."""
    lists = "list_filter(string_split_regex(p, '[\\x20\\x09]+'), lambda x: x <> '')"
    return f"""
    WITH t AS (SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[.,;:!?\\x0A-\\x0D]')) AS p FROM documents),
    w AS (SELECT lang, {lists} AS ws FROM t),
    g AS (SELECT lang, ws, unnest(range(1, len(ws) + 1)) AS i FROM w),
    h AS (SELECT lang, k AS words, array_to_string(ws[i : i + k - 1], ' ') AS phrase FROM g, range(1, {ORDER + 1}) ks(k) WHERE i + k - 1 <= len(ws)),
    f AS (SELECT lang, phrase, words, count(*) AS f FROM h GROUP BY ALL),
    n AS (SELECT lang, sum(f) AS n FROM f WHERE words = 1 GROUP BY lang),
    c AS (SELECT lang, phrase, words, f AS a, string_split(phrase, ' ') AS ws FROM f WHERE words >= 2 AND f >= {least}),
    cut AS (SELECT c.lang, c.phrase, c.words, c.a, k, x.f AS l, y.f AS r, (CAST({SCALE} AS HUGEINT) * a) // (x.f + y.f) AS score
        FROM (SELECT *, unnest(range(1, words)) AS k FROM c) c
        JOIN f x ON x.lang = c.lang AND x.phrase = array_to_string(c.ws[1 : k], ' ')
        JOIN f y ON y.lang = c.lang AND y.phrase = array_to_string(c.ws[k + 1 :], ' ')),
    low AS (SELECT * FROM cut QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
    kept AS (SELECT * FROM low WHERE NOT EXISTS (SELECT 1 FROM c b WHERE b.lang = low.lang AND b.words > low.words AND 100 * b.a >= {HELD_IN} * low.a
        AND (b.ws[1 : low.words] = string_split(low.phrase, ' ') OR b.ws[2 : low.words + 1] = string_split(low.phrase, ' ') OR b.ws[3 : low.words + 2] = string_split(low.phrase, ' ')))),
    best AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
    SELECT lang, CAST(rank AS BIGINT) AS rank, phrase, CAST(a AS BIGINT) AS a, CAST(l AS BIGINT) AS l, CAST(r AS BIGINT) AS r,
      CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score FROM best JOIN n USING (lang) WHERE rank <= {top}"""
