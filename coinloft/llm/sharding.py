"""Sharding by sampled splitters: size-weighted key samples, quantile boundaries, ranges, overfull ones divided again."""

from __future__ import annotations

import heapq
import itertools

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from coinloft.session import cut_lineage

SHARDS = 40
PER_SHARD = 16  # ranges for each shard, at least
RANGE_BYTES = 1 << 30  # and so many that a range holds about this much
MOST_RANGES = 1 << 14
SAMPLES = 24  # keys drawn for each range
OVERFULL = 4  # times the mean: such a range is divided
PER_RANGE = 8  # a group of equal texts above this part of a range is placed by itself
KEY = ["key_c", "key_t", "key_d"]
COLUMNS = ("size", "text_crc32", *KEY)
LEAST = -(1 << 63)


def sized(docs: DataFrame) -> DataFrame:
    """``docs`` with size, text_crc32 and the sort key (CRC of the text, its 64-bit hash, doc_id): equal texts are neighbours."""
    crc = F.crc32(F.col("text").cast("binary"))
    return docs.withColumns({
        "size": F.coalesce(F.octet_length("text"), F.lit(0)).cast("long") + 16, "text_crc32": crc,
        "key_c": F.coalesce(crc, F.lit(-1)), "key_t": F.xxhash64("text"), "key_d": F.coalesce(F.col("doc_id").cast("long"), F.lit(LEAST)),
    })


def _sample(rows: DataFrame, want: float, total: int, seed: int) -> DataFrame:
    """Keys drawn with a probability in proportion to size; the draw is a hash of the key, so reruns agree."""
    chance = F.shiftrightunsigned(F.xxhash64(*KEY, F.lit(seed)), 11) * F.lit(2.0**-53)
    return rows.where(chance < F.col("size") * F.lit(want / total)).select(*KEY).distinct()


def _quantiles(sample: DataFrame, pieces: int) -> list[tuple[int, ...]]:
    """Every k-th key of the ordered sample, ``pieces`` - 1 in all at most. The sample's size is set by parameters."""
    order = W.partitionBy(F.lit(0)).orderBy(*KEY)
    n = F.count("*").over(W.partitionBy(F.lit(0)))
    step = F.floor((F.row_number().over(order) - 1) * pieces / n)
    marks = sample.withColumn("step", step).groupBy("step").agg(F.min(F.struct(*KEY)).alias("k")).where("step > 0")
    return sorted(tuple(r.k) for r in marks.collect())


def _range_of(splitters: list[tuple[int, ...]], fan: int = 32) -> Column:
    """Number of splitters at or below the row's key, found in two or three steps of up to about ``fan`` comparisons."""
    key = f"struct({', '.join(KEY)})"

    def lit(k):
        return f"struct({', '.join(f'{x}L' if x > LEAST else f'CAST({LEAST} AS BIGINT)' for x in k)})"

    def search(part: list[tuple[int, ...]], base: int) -> str:
        if len(part) <= fan:
            inner = f"size(filter(array({', '.join(map(lit, part))}), b -> b <= {key}))" if part else "0"
            return f"({base} + {inner})"
        step = -(-len(part) // fan)
        cuts = list(range(step, len(part), step))
        at = [0, *cuts, len(part)]
        whens = " ".join(f"WHEN {key} < {lit(part[c])} THEN {search(part[a:c], base + a)}" for a, c in zip(at, cuts, strict=False))
        return f"(CASE {whens} ELSE {search(part[cuts[-1]:], base + cuts[-1])} END)"

    return F.expr(search(splitters, 0))


def splitters(rows: DataFrame, total: int, ranges: int, rounds: int = 4) -> tuple[list[tuple[int, ...]], DataFrame]:
    """Boundaries for about ``ranges`` ranges of equal bytes, and the exact sum of ``line`` in each range.

    A range of more than OVERFULL times the mean gets more samples and boundaries of its own, until none is left but
    those that one key fills.
    """
    marks = _quantiles(_sample(rows, ranges * SAMPLES, total, 1), ranges)
    for n in range(rounds):
        filled = rows.groupBy(_range_of(marks).alias("range")).agg(
            F.sum("size").alias("bytes"), F.sum("line").alias("line"), F.min(F.struct(*KEY)).alias("lo"), F.max(F.struct(*KEY)).alias("hi"))
        filled = cut_lineage(filled, "ranges")
        full = filled.where((F.col("bytes") > OVERFULL * total / ranges) & (F.col("lo") < F.col("hi"))).select("range", "bytes").collect()
        if not full:
            break
        # sum of full / total is at most 1, so this sample too is bounded by the number of ranges
        inside = rows.where(_range_of(marks).isin([r.range for r in full]))
        extra = _quantiles(_sample(inside, ranges * SAMPLES * 8 * (n + 1), total, n + 2), 2 * sum(-(-r.bytes * ranges // total) for r in full))
        more = sorted({*marks, *extra})
        if more == marks:
            break
        marks = more
    else:
        filled = cut_lineage(rows.groupBy(_range_of(marks).alias("range")).agg(F.sum("size").alias("bytes"), F.sum("line").alias("line")), "ranges")
    return marks, filled.select("range", "line")


def _placed_groups(slim: DataFrame, total: int, ranges: int, shards: int) -> tuple[list[tuple[int, int, int | None]], list[int]]:
    """(key_c, key_t, shard) of each group of equal texts above a PER_RANGE-th of a range, and the bytes so placed per shard.

    There are at most ranges * PER_RANGE such groups. The largest goes first, each to the shard that holds least. A
    group larger than an equal share has no shard: it is cut where the line of small groups is cut.
    """
    groups = slim.groupBy("key_c", "key_t").agg(F.sum("size").alias("bytes")).where(F.col("bytes") * F.lit(ranges * PER_RANGE) > total)
    load, out = [0] * shards, []
    heap = [(0, i) for i in range(shards)]
    for r in sorted(groups.collect(), key=lambda r: (-r.bytes, r.key_c, r.key_t)):
        if r.bytes * shards > total:
            out.append((r.key_c, r.key_t, None))
            continue
        least, i = heap[0]
        heapq.heapreplace(heap, (least + r.bytes, i))
        load[i] += r.bytes
        out.append((r.key_c, r.key_t, i))
    return out, load


def _room(load: list[int], rest: int) -> tuple[list[int], int]:
    """What each shard takes of ``rest`` bytes, all filled to one level (fuller ones take nothing), times the returned factor."""
    held = 0
    for k, x in enumerate(sorted(load)):
        if k and rest + held <= k * x:
            break
        held += x
    else:
        k = len(load)
    return [max(0, rest + held - k * x) for x in load], k


def assign(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """``docs`` (doc_id, text or the columns of ``sized``, others) with shard and slot added; one row per input row.

    Equal texts share a shard, unless together they are larger than an equal share. Groups above a small part of a range
    are placed whole (``_placed_groups``). All others stand in a line by (CRC, hash of the text), which is cut
    where it fills all shards to one level; a group lies in the shard that holds its middle. So shards differ by about
    such a small part, as long as the line suffices to level them. Larger groups are cut between rows in order of doc_id.
    ``slot`` counts the shard's rows from 0. Running sums are formed within a range only, and
    ranges are of bounded size. Null texts weigh 16 bytes and are one group, a null doc_id sorts first. Repeated rows are
    neighbours. An empty table gives no row. Columns named like the added ones are replaced.
    """
    rows = docs if {*COLUMNS} <= {*docs.columns} else sized(docs.drop("shard", "slot"))
    slim = cut_lineage(rows.select("size", *KEY), "keys")
    total = slim.agg(F.sum("size")).first()[0]
    if not total:
        return rows.withColumns({"shard": F.lit(0), "slot": F.lit(0).cast("long")}).drop(*KEY)
    ranges = min(MOST_RANGES, max(shards * PER_SHARD, total // RANGE_BYTES))
    groups, load = _placed_groups(slim, total, ranges, shards)
    groups = F.broadcast(rows.sparkSession.createDataFrame(groups, "key_c long, key_t long, whole int").withColumn("alone", F.lit(True)))

    def in_line(x: DataFrame) -> DataFrame:
        """A group in the line has one key, so it lies in one range; the rows of placed and cut groups keep theirs."""
        x = x.join(groups, ["key_c", "key_t"], "left")
        return x.withColumns({
            "key_d": F.when(F.col("alone"), F.col("key_d")).otherwise(F.lit(0).cast("long")),
            "line": F.when(F.col("whole").isNull(), F.col("size")).otherwise(F.lit(0).cast("long"))})

    marks, filled = splitters(in_line(slim), total, ranges)
    upto = W.partitionBy(F.lit(0)).orderBy("range").rowsBetween(W.unboundedPreceding, -1)  # one row per range
    starts = filled.select(F.col("range").alias("r"), F.coalesce(F.sum("line").over(upto), F.lit(0)).alias("line_before"))
    inside = W.partitionBy("range").orderBy(*KEY)
    placed = in_line(rows).withColumn("range", _range_of(marks)).withColumns({
        "upto_row": F.sum("line").over(inside.rowsBetween(W.unboundedPreceding, 0)),
        "upto_group": F.sum("line").over(inside.rangeBetween(W.unboundedPreceding, 0)),
        "group": F.sum("line").over(W.partitionBy("range", *KEY))})
    placed = placed.join(starts, placed["range"] == starts["r"])
    # the middle of the row (of a cut group) or of the whole group, times two
    middle = F.when(F.col("alone"), 2 * F.col("upto_row") - F.col("line")).otherwise(2 * F.col("upto_group") - F.col("group")) + 2 * F.col("line_before")
    room, factor = _room(load, total - sum(load))
    ends = [f"{2 * x}L" for x in itertools.accumulate(room[:-1])]
    cut = F.size(F.filter(F.expr(f"array({', '.join(ends)})" if ends else "cast(array() as array<bigint>)"), lambda e: e <= middle * factor))
    placed = placed.withColumn("shard", F.coalesce(F.col("whole"), cut).cast("int"))
    placed = placed.withColumn("place", F.row_number().over(W.partitionBy("range", "shard").orderBy(*KEY)))
    placed = cut_lineage(placed.drop("r", "line", "line_before", "upto_row", "upto_group", "group", "whole", "alone", *KEY), "placed")
    counts = placed.groupBy("shard", "range").agg(F.count("*").alias("n"))
    before = F.coalesce(F.sum("n").over(W.partitionBy("shard").orderBy("range").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    counts = counts.select("shard", "range", before.alias("rows_before"))  # a few rows a range
    return placed.join(counts, ["shard", "range"]).withColumn("slot", F.col("rows_before") + F.col("place") - 1).drop("place", "range", "rows_before")


def sharded(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard per row; the texts themselves are not moved."""
    slim = sized(docs.select("doc_id", "text")).drop("text")
    return assign(slim, shards).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def in_shards(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """The rows and columns of ``docs`` with size, text_crc32, shard and slot: the texts move once, by range.

    Columns of these four names are replaced; any other name may occur.
    """
    added = ("size", "text_crc32", "shard", "slot")
    names = [c for c in docs.columns if c not in added]
    inner = docs.select(*[F.col(f"`{c}`").alias(c if c in ("doc_id", "text") else f"c_{i}") for i, c in enumerate(names)])
    return assign(inner, shards).select(*[F.col(c if c in ("doc_id", "text") else f"c_{i}").alias(c) for i, c in enumerate(names)], *added)
