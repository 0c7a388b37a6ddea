"""Benchmark decontamination: SimHash of item-sized windows, multi-index Hamming blocks, exact weighted-shingle check."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from coinloft.llm.licences import words
from coinloft.llm.text import row_prints
from coinloft.session import cut_lineage

SHINGLE = 5
SIMILARITY = 0.8
BITS = 64
RADIUS = 18  # bits; two texts at similarity 0.8 differ in 9.6 on average, with a deviation of 2.9
BLOCKS = RADIUS + 1  # two fingerprints within the radius agree in one of so many blocks
BROADCAST_ROWS = 1 << 19  # item shingles up to which their index (16 bytes a row) goes to every task


def _shingles(ws: str, width: str) -> str:
    """Hashes of all runs of ``width`` words, the width mixed in."""
    return f"if(size({ws}) < {width}, cast(array() as array<bigint>), transform(sequence(1, size({ws}) - {width} + 1), i -> xxhash64(slice({ws}, i, {width}))))"


def _fingerprint(sh: str) -> Column:
    """SimHash: bit i is set where most shingles, each counted as often as it occurs, have it set."""
    most = f"if(2 * size(filter({sh}, x -> getbit(x, i) = 1)) > size({sh}), shiftleft(1L, i), 0L)"
    return F.expr(f"aggregate(sequence(0, {BITS - 1}), 0L, (acc, i) -> acc | {most})")


def _tagged(sh: str) -> Column:
    """The shingles as a set in which the k-th copy of a shingle is an element of its own."""
    return F.expr(f"transform(array_sort({sh}), (x, i) -> xxhash64(x, i + 1 - array_position(array_sort({sh}), x)))")


def _blocks(fingerprint: str) -> Column:
    edges = [BITS * b // BLOCKS for b in range(BLOCKS + 1)]
    parts = [f"struct({b} as block, shiftrightunsigned({fingerprint}, {lo}) & {(1 << (hi - lo)) - 1}L as bits)" for b, (lo, hi) in enumerate(zip(edges, edges[1:], strict=False))]
    return F.explode(F.expr(f"array({', '.join(parts)})"))


def items(benchmark: DataFrame) -> DataFrame:
    """item_id, len, width, sh per benchmark item with a word; shorter items than a shingle are one shingle."""
    t = benchmark.select("item_id", words(F.col("text")).alias("w")).where("size(w) > 0")
    t = t.withColumn("len", F.size("w")).withColumn("width", F.least(F.lit(SHINGLE), "len"))
    return t.withColumn("sh", F.expr(_shingles("w", "width"))).select("item_id", "len", "width", "sh").distinct()


def _starts(need: str) -> str:
    """Places, ascending, from which ``n`` shingles hold at least ``need`` of those at the ascending places ``p``.

    These are p[i + need - 1] - n + 1 to p[i] for some i; what stands at or before p[i - 1] came with an earlier i.
    """
    span = f"struct(greatest(p[i + {need} - 1] - n + 1, get(p, i - 1) + 1) as lo, p[i] as hi)"
    spans = f"filter(transform(sequence(0, size(p) - {need}), i -> {span}), r -> r.lo <= r.hi)"
    return f"if(size(p) < {need}, cast(array() as array<int>), flatten(transform({spans}, r -> sequence(r.lo, r.hi))))"


def windows(docs: DataFrame, item: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """p1, p2, len, width, start, sh: windows of ``docs`` (p1, p2, text), as long as an item, at every place of a document where one may reach ``similarity``.

    Of an item's n shingles and a window's m, similarity s needs s (n + m) / (1 + s) in common: for a whole window, m = n;
    for one cut at an end of the text, m < n, it is more than s n. So a window is formed wherever so many of its shingles
    stand in items of its length, in whatever order. All documents are read whole; the index of the benchmark's shingles is
    broadcast if it is small by count, and joined by shuffle otherwise.
    """
    index = item.select("width", "len", F.explode("sh").alias("h")).select("h", "width", "len").distinct()
    widths = sorted(r.width for r in index.select("width").distinct().collect())  # 1 to 5
    index = cut_lineage(index, "item-shingles")
    index = F.broadcast(index) if index.count() <= BROADCAST_ROWS else index
    w = docs.select("p1", "p2", words(F.col("text")).alias("w"))
    hits = None
    for width in widths:
        at = w.select("p1", "p2", F.posexplode(F.expr(_shingles("w", str(width)))).alias("pos", "h"))
        found = at.join(index.where(F.col("width") == width), "h").select("p1", "p2", "pos", "len", "width")
        hits = found if hits is None else hits.union(found)
    if hits is None:
        return w.select("p1", "p2", *[F.lit(0).alias(c) for c in ("start", "len", "width")], F.expr("cast(array() as array<bigint>)").alias("sh")).limit(0)
    least = lambda share: F.greatest(F.lit(1), F.ceil(F.lit(share) * F.col("n") - 1e-9).cast("int"))
    placed = hits.groupBy("p1", "p2", "len", "width").agg(F.array_sort(F.collect_set("pos")).alias("p")).withColumn("n", F.expr("len - width + 1"))
    placed = placed.withColumns({"cut_need": least(similarity), "whole_need": least(2 * similarity / (1 + similarity))}).where("size(p) >= cut_need")
    placed = placed.select("p1", "p2", F.struct("len", "width", F.expr(_starts("whole_need")).alias("whole"), F.expr(_starts("cut_need")).alias("cut")).alias("win"))
    wanted = cut_lineage(placed.groupBy("p1", "p2").agg(F.collect_list("win").alias("wins")), "windows")
    inside = docs.select("p1", "p2", "text").join(wanted, ["p1", "p2"]).select("p1", "p2", "wins", words(F.col("text")).alias("w"))
    whole = "filter(g.whole, s -> s >= 0 and s + g.len <= size(w))"
    cut = "filter(g.cut, s -> (s < 0 or s + g.len > size(w)) and s < size(w) and s + g.len > 0)"
    starts = f"flatten(transform(wins, g -> transform(concat({whole}, {cut}), s -> struct(s as start, g.len as len, g.width as width))))"
    own = "slice(w, greatest(win.start, 0) + 1, least(win.start + win.len, size(w)) - greatest(win.start, 0))"
    each = inside.select("p1", "p2", F.explode(F.expr(f"transform({starts}, win -> struct(win.start as start, win.len as len, win.width as width, {own} as w))")).alias("v"))
    return each.select("p1", "p2", "v.start", "v.len", "v.width", F.expr(_shingles("v.w", "v.width")).alias("sh")).where("size(sh) > 0")


def _found(docs: DataFrame, benchmark: DataFrame, similarity: float) -> DataFrame:
    """p1, p2, item_id, start, hamming, similarity of the best window per document of ``docs`` (p1, p2, text) and item."""
    item = cut_lineage(items(benchmark.where("item_id is not null")), "items")
    item_f = cut_lineage(item.select("item_id", "len", _tagged("sh").alias("item_set"), _fingerprint("sh").alias("item_f")), "item-prints")
    win = windows(docs, item, similarity).select("p1", "p2", "start", "len", _tagged("sh").alias("win_set"), _fingerprint("sh").alias("win_f"))
    key = ["p1", "p2", "start", "len", "win_f"]
    win = cut_lineage(win.dropDuplicates(key), "window-prints")
    left = win.select(*key, _blocks("win_f").alias("k")).select(*key, "k.block", "k.bits")
    right = item_f.select("item_id", "len", "item_f", _blocks("item_f").alias("k")).select("item_id", "len", "item_f", "k.block", "k.bits")
    near = left.join(right, ["len", "block", "bits"]).withColumn("hamming", F.bit_count(F.col("win_f").bitwiseXOR(F.col("item_f"))).cast("long"))
    near = near.where(F.col("hamming") <= RADIUS).select(*key, "item_id", "item_f", "hamming").distinct()
    pair = near.join(win, key).join(item_f, ["item_id", "len", "item_f"])
    both = F.size(F.array_intersect("win_set", "item_set"))
    pair = pair.withColumn("similarity", both / (F.size("win_set") + F.size("item_set") - both).cast("double")).where(F.col("similarity") >= similarity)
    best = F.min(F.struct((-F.col("similarity")).alias("s"), "start", "hamming")).alias("b")
    return pair.groupBy("p1", "p2", "item_id").agg(best).select(
        "p1", "p2", "item_id", F.col("b.start").cast("long").alias("start"), "b.hamming", (-F.col("b.s")).alias("similarity"))


def leaks(docs: DataFrame, benchmark: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """doc_id, item_id, start, hamming, similarity: one row per document and item of which it holds a passage.

    ``similarity`` is the Jaccard similarity of the five-word shingles of item and window, each weighted by how often
    it occurs; the best window counts, the earliest of equals (``start`` in words, from 0; below 0 where a window
    begins before the text). A document is a doc_id (it may be null) with a text: rows that share both count once, texts that share a
    doc_id only have a row each. Items and documents without words match nothing, items without an id are left out.
    Empty tables give an empty table.
    """
    p1, p2 = row_prints()
    keyed = docs.select("doc_id", p1.alias("p1"), p2.alias("p2"), "text")
    found = cut_lineage(_found(keyed.drop("doc_id"), benchmark, similarity), "leaks")
    ids = keyed.select("p1", "p2", "doc_id").join(found.select("p1", "p2").distinct(), ["p1", "p2"], "left_semi").distinct()
    return ids.join(found, ["p1", "p2"]).drop("p1", "p2")


def without_leaks(docs: DataFrame, benchmark: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """The rows of ``docs``, with their columns, that hold no passage of the benchmark, with or without a doc_id."""
    names = docs.columns
    p1, p2 = row_prints()
    inner = docs.select(*[F.col(f"`{c}`").alias(f"c_{i}") for i, c in enumerate(names)], p1.alias("p1"), p2.alias("p2"))
    gone = _found(inner.select("p1", "p2", F.col(f"c_{names.index('text')}").alias("text")), benchmark, similarity).select("p1", "p2").distinct()
    return inner.join(gone, ["p1", "p2"], "left_anti").select(*[F.col(f"c_{i}").alias(c) for i, c in enumerate(names)])
