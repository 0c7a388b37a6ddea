"""Approximate nearest neighbours over several shifted Hilbert orderings of projected vectors."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from coinloft.session import cut_lineage

K = 10
CURVES, DIMS, CELL_BITS = 16, 4, 8
SAMPLE = 4096  # vectors that set the projections' location and spread
PROBES = 64  # queries whose true neighbours set the window
TARGET = 0.96  # share of them that the windows must hold
BLOCK = 2048  # ranks
QUERIES_AT_ONCE = 4096


def hilbert(cells: np.ndarray, bits: int) -> np.ndarray:
    """Position along the Hilbert curve of integer points (n, dims) with ``bits`` bits per coordinate.

    From the highest bit down, the lower bits of the coordinates are reflected or exchanged as the quadrant asks, then a
    Gray code over all coordinates is read off bit by bit.
    """
    x = cells.astype(np.int64).T.copy()
    dims = len(x)
    for b in range(bits - 1, 0, -1):
        low = (1 << b) - 1
        for d in range(dims):
            up = (x[d] >> b) & 1 == 1
            swap = (x[0] ^ x[d]) & low
            x[0] = np.where(up, x[0] ^ low, x[0] ^ swap)
            if d:
                x[d] = np.where(up, x[d], x[d] ^ swap)
    for d in range(1, dims):
        x[d] ^= x[d - 1]
    flip = np.zeros(x.shape[1], np.int64)
    for b in range(bits - 1, 0, -1):
        flip ^= np.where((x[-1] >> b) & 1 == 1, (1 << b) - 1, 0)
    x ^= flip
    key = np.zeros(x.shape[1], np.int64)
    for b in range(bits - 1, -1, -1):
        for d in range(dims):
            key = key << 1 | (x[d] >> b) & 1
    return key


def points(vectors: DataFrame, id_col: str, vec_col: str, every: int, k: int) -> DataFrame:
    """pid, vec, ids, asked: one row per distinct vector. ``ids`` are its k + 1 least ids (no others can be in a
    result), ``pid`` the least, ``asked`` whether a query has this vector."""
    v, ident = F.col(vec_col), F.col(id_col)
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    usable = vectors.where(ident.isNotNull() & v.isNotNull() & finite & F.exists(v, lambda x: x != 0)).select(ident.cast("long").alias("id"), v.alias("vec"))
    lengths = usable.groupBy(F.size("vec").alias("n")).agg(F.count("*").alias("rows")).orderBy(F.desc("rows"), "n").limit(1).collect()
    usable = usable.where(F.size("vec") == (lengths[0].n if lengths else 0)).distinct()
    least = usable.withColumn("place", F.row_number().over(W.partitionBy("vec").orderBy("id"))).where(f"place <= {k + 1}")
    ids = least.groupBy("vec").agg(F.sort_array(F.collect_list("id")).alias("ids"))
    asked = usable.groupBy("vec").agg(F.max(F.col("id") % every == 0).alias("asked"))
    return ids.join(asked, "vec").select(F.col("ids")[0].alias("pid"), "vec", "ids", "asked")


def _matrix(column) -> np.ndarray:
    lists = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return np.asarray(lists.flatten(), np.float64).reshape(len(lists), -1)


def _fit(pts: DataFrame, curves: int, seed: int) -> dict:
    """Projections (random orthogonal directions), with mean and spread along them over at most SAMPLE vectors, and shifts."""
    sample = _matrix(pts.orderBy(F.xxhash64("pid", F.lit(seed)), "pid").limit(SAMPLE).select("vec").toArrow()["vec"])
    rng = np.random.default_rng(seed)
    n = sample.shape[1]
    dims = min(DIMS, n)
    axes = [np.linalg.qr(rng.standard_normal((n, n)))[0][:, :dims] for _ in range(curves)]
    along = [sample @ a for a in axes]
    return {"axes": axes, "mean": [y.mean(0) for y in along], "spread": [np.maximum(y.std(0), 1e-12) for y in along], "shift": rng.random((curves, dims)) / 2}


def _keys(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _matrix(batch.column("vec"))
            out = []
            for axes, mean, spread, shift in zip(m["axes"], m["mean"], m["spread"], m["shift"], strict=True):
                level = 0.25 * (1 + np.tanh(0.8 * (x @ axes - mean) / spread)) + shift  # 0 to 1, about even over the sample
                out.append(hilbert(np.clip(level * (1 << CELL_BITS), 0, (1 << CELL_BITS) - 1).astype(np.int64), CELL_BITS))
            keys = np.stack(out, 1)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(keys) + 1) * keys.shape[1], pa.int32()), pa.array(keys.ravel()))
            yield pa.RecordBatch.from_arrays([batch.column("pid"), lists], ["pid", "keys"])

    return run


def ranks(pts: DataFrame, curves: int = CURVES, seed: int = 5) -> DataFrame:
    """curve, pid, rank: every point's place on each curve. Places are counted in ranges of the key, never over a whole curve in one task."""
    shared = pts.sparkSession.sparkContext.broadcast(_fit(pts, curves, seed))
    keyed = pts.select("pid", "vec").mapInArrow(_keys(shared), "pid long, keys array<long>")
    keyed = cut_lineage(keyed.select("pid", F.posexplode("keys").alias("curve", "key")), "curve-keys")
    n = keyed.count() // max(curves, 1)
    bits = int(np.clip(np.ceil(np.log2(max(n, 2)) / 2), 4, 20))
    dims_bits = DIMS * CELL_BITS
    ranged = keyed.withColumn("part", F.shiftright("key", max(dims_bits - bits, 0)))
    parts = ranged.groupBy("curve", "part").agg(F.count("*").alias("n"))
    parts = parts.withColumn("before", F.sum("n").over(W.partitionBy("curve").orderBy("part")) - F.col("n"))
    place = F.row_number().over(W.partitionBy("curve", "part").orderBy("key", "pid"))
    return cut_lineage(ranged.withColumn("place", place).join(parts, ["curve", "part"]).select("curve", "pid", (F.col("before") + F.col("place") - 1).alias("rank")), "ranks")


def _true_neighbours(shared, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, q = shared.value
        for batch in batches:
            x, pid = _matrix(batch.column("vec")), np.asarray(batch.column("pid"), np.int64)
            if not len(x):
                continue
            d = np.sqrt(np.maximum((q**2).sum(1)[:, None] + (x**2).sum(1)[None] - 2 * q @ x.T, 0))
            d[pid[None, :] == ids[:, None]] = np.inf
            near = np.argsort(d, axis=1, kind="stable")[:, :k]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(ids, near.shape[1])), pa.array(pid[near].ravel()), pa.array(np.take_along_axis(d, near, 1).ravel())], ["q", "pid", "d"])

    return run


def window(pts: DataFrame, ranked: DataFrame, k: int = K, target: float = TARGET) -> int:
    """The least number of places to either side that holds ``target`` of the true neighbours of PROBES queries.

    The probes meet all points, in blocks, so this is also the recall that the windows reach against brute force. Where
    the vectors have no structure the windows become long; the result stays right and the cost shows it.
    """
    probes = pts.where("asked").orderBy(F.xxhash64("pid", F.lit(3)), "pid").limit(PROBES).select("pid", "vec").toArrow()
    if not probes.num_rows:
        return 4 * k
    shared = pts.sparkSession.sparkContext.broadcast((np.asarray(probes["pid"], np.int64), _matrix(probes["vec"])))
    near = pts.select("pid", "vec").mapInArrow(_true_neighbours(shared, k), "q long, pid long, d double").where("d < double('infinity')")
    near = near.withColumn("place", F.row_number().over(W.partitionBy("q").orderBy("d", "pid"))).where(f"place <= {k}").select("q", "pid")
    mine = ranked.select("curve", F.col("pid").alias("q"), F.col("rank").alias("at"))
    gap = near.join(ranked, "pid").join(mine, ["curve", "q"]).groupBy("q", "pid").agg(F.min(F.abs(F.col("rank") - F.col("at"))).alias("gap"))
    gaps = np.sort([r.gap for r in gap.select("gap").collect()])  # PROBES x k numbers
    return max(4 * k, int(gaps[min(len(gaps) - 1, int(np.ceil(target * len(gaps))))]) + 1 if len(gaps) else 0)


def _rerank(k: int, width: int):
    def run(table: pa.Table) -> pa.Table:
        asks = np.asarray(table["ask"].to_numpy(zero_copy_only=False), bool)
        x, pid, rank = _matrix(table["vec"]), np.asarray(table["pid"], np.int64), np.asarray(table["rank"], np.int64)
        rows, queries = np.flatnonzero(~asks), np.flatnonzero(asks)
        out_q, out_r, out_d = [], [], []
        if len(rows):
            square = (x[rows] ** 2).sum(1)
            for q in queries:
                near = np.flatnonzero(np.abs(rank[rows] - rank[q]) <= width)
                if not len(near):
                    continue
                rough = square[near] - 2 * x[rows[near]] @ x[q]
                if len(near) > k + 1:  # with a margin, so that rounding drops no tie
                    edge = np.partition(rough, k)[k]
                    near = near[rough <= edge + 1e-9 * max(1.0, abs(edge))]
                out_q.append(np.full(len(near), pid[q]))
                out_r.append(rows[near])
                out_d.append(np.sqrt(((x[rows[near]] - x[q]) ** 2).sum(1)))
        r = np.concatenate(out_r) if out_r else np.zeros(0, np.int64)
        return pa.table({
            "q": pa.array(np.concatenate(out_q) if out_q else r, pa.int64()), "pid": pa.array(pid[r], pa.int64()),
            "score": pa.array(np.concatenate(out_d) if out_d else np.zeros(0), pa.float64()), "ids": table["ids"].combine_chunks().take(pa.array(r)),
        })

    return run


def nearest(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", every: int = 100, k: int = K, curves: int = CURVES, target: float = TARGET) -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` nearest found of every row whose id is divisible by ``every``.

    ``score`` is the Euclidean distance of the original vectors in double precision; equal distances are ordered by id; a
    row is no neighbour of its own id. Equal vectors are one point on the curves, so a large group of copies is no large
    bucket; its k + 1 least ids stand for it, which loses nothing. Vectors that are null, zero, hold null or non-finite
    components, have no id, or another length than most, take no part. Repeated rows count once. With fewer than k other
    vectors all are returned; without queries or vectors the result is empty.

    Each curve's points are cut into blocks of BLOCK places; a query visits the blocks its window touches. The window's
    width is measured (see ``window``); the results of all curves are merged and ranked.
    """
    pts = cut_lineage(points(vectors, id_col, vec_col, every, k), "points")
    n, asked = pts.count(), pts.where("asked").count()
    out = "query_id long, rank int, vec_id long, score double"
    if not asked:
        return vectors.sparkSession.createDataFrame([], out)
    ranked = ranks(pts, curves)
    width = window(pts, ranked, k, target)
    parts = max(1, -(-asked * (BLOCK + 2 * width) // (n * QUERIES_AT_ONCE)))  # so many tasks share a block's queries
    held = ranked.join(pts, "pid")
    block = F.expr(f"rank div {BLOCK}")
    rows = held.select("curve", block.alias("block"), F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("part"), F.lit(False).alias("ask"), "rank", "pid", "vec", "ids")
    reach = F.expr(f"sequence(greatest(rank - {width}, 0L) div {BLOCK}, least(rank + {width}, {n - 1}L) div {BLOCK})")
    asks = held.where("asked").select("curve", F.explode(reach).alias("block"), (F.abs(F.xxhash64("pid")) % parts).cast("int").alias("part"), F.lit(True).alias("ask"), "rank", "pid", "vec", "ids")
    found = rows.union(asks).groupBy("curve", "block", "part").applyInArrow(_rerank(k, width), "q long, pid long, score double, ids array<long>")
    best = found.groupBy("q", "pid").agg(F.min("score").alias("score"), F.first("ids").alias("ids")).select("q", "score", F.explode("ids").alias("vec_id"))
    best = best.withColumn("place", F.row_number().over(W.partitionBy("q").orderBy("score", "vec_id"))).where(f"place <= {k + 1}")
    # queries of equal vectors share one list; each leaves itself out
    v, ident = F.col(vec_col), F.col(id_col).cast("long")
    queries = vectors.where(ident % every == 0).select(ident.alias("query_id"), v.alias("vec")).distinct().join(pts.select("vec", F.col("pid").alias("q")), "vec").select("query_id", "q").distinct()
    each = queries.join(best, "q").where("vec_id <> query_id")
    place = F.row_number().over(W.partitionBy("query_id").orderBy("score", "vec_id"))
    return each.withColumn("rank", place).where(f"rank <= {k}").select("query_id", "rank", "vec_id", "score")
