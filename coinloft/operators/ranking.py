"""Exact ranks and percentiles over whole tables without a one-task sort.

Values are counted first, then the counts are accumulated in three nested
ranges of their cents: range of 10^10, of 10^5, single values. Every window
group holds at most about 10^5 distinct values, whatever the number of rows,
and ties (however many) are one counted value.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

COARSE, FINE = 10_000_000_000, 100_000


def _before(partition: Sequence[str], order: Column, value: str) -> Column:
    frame = Window.partitionBy(*partition).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(F.sum(value).over(frame), F.lit(0))


def value_positions(
    df: DataFrame, keys: Sequence[str], value: str, descending: bool = False, places: int = 2
) -> DataFrame:
    """Per key and distinct value: ``n`` rows with it and ``before`` rows ordered ahead of it.

    ``places`` is the number of decimals of the value.
    """
    keys = list(keys)
    units = F.col("value").cast("decimal(38,6)") * F.lit(10**places)
    counted = (
        df.where(F.col(value).isNotNull())
        .groupBy(*keys, F.col(value).alias("value"))
        .agg(F.count("*").alias("n"))
        .withColumn("_mid", F.floor(units / FINE).cast("bigint"))
        .withColumn("_top", F.floor(F.col("_mid") / (COARSE // FINE)).cast("bigint"))
    )
    way = (lambda c: F.col(c).desc()) if descending else (lambda c: F.col(c).asc())
    mids = counted.groupBy(*keys, "_top", "_mid").agg(F.sum("n").alias("mid_n"))
    tops = mids.groupBy(*keys, "_top").agg(F.sum("mid_n").alias("top_n"))
    tops = tops.select(*keys, "_top", _before(keys, way("_top"), "top_n").alias("top_before"))
    mids = mids.select(
        *keys, "_top", "_mid", _before([*keys, "_top"], way("_mid"), "mid_n").alias("mid_before")
    )
    offsets = _join(mids, tops, [*keys, "_top"]).select(
        *keys, "_mid", (F.col("mid_before") + F.col("top_before")).alias("offset")
    )
    inner = counted.withColumn("inner_before", _before([*keys, "_mid"], way("value"), "n"))
    return _join(inner, offsets, [*keys, "_mid"]).select(
        *keys, "value", "n", (F.col("inner_before") + F.col("offset")).alias("before")
    )


def _join(left: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
    """Equi join that also matches NULL group keys."""
    r = right.select(*[F.col(c).alias(f"_r_{c}") if c in on else F.col(c) for c in right.columns])
    test = None
    for c in on:
        same = left[c].eqNullSafe(r[f"_r_{c}"])
        test = same if test is None else test & same
    return left.join(r, test).drop(*[f"_r_{c}" for c in on])


def global_rank(df: DataFrame, key: str, metrics: Mapping[str, str]) -> DataFrame:
    """Add rank columns: highest value first, ties share a rank, NULLs share the last one.

    ``metrics``: output column -> ranked column. ``key`` is unique in ``df``. All
    metrics are ranked in one pass over (metric, value) rows.
    """
    pair = F.explode(
        F.array(*[
            F.struct(F.lit(name).alias("metric"), F.col(source).cast("decimal(30,5)").alias("value"))
            for name, source in metrics.items()
        ])
    )
    long = df.select(key, pair.alias("p")).select(key, "p.metric", "p.value")
    ahead = value_positions(long, ["metric"], "value", descending=True, places=5).drop("n")
    known = long.groupBy("metric").agg(F.count("value").alias("known"))
    rank = F.coalesce("before", "known") + 1
    ranks = (
        long.join(ahead, ["metric", "value"], "left").join(known, "metric").groupBy(key)
        .agg(*[F.max(F.when(F.col("metric") == name, rank)).alias(name) for name in metrics])
    )
    return df.join(ranks, key)


def exact_percentiles(
    df: DataFrame, keys: Sequence[str], value: str, points: Mapping[str, float], places: int = 2
) -> DataFrame:
    """Exact percentiles with linear interpolation, as doubles, one row per key."""
    keys = list(keys)
    found = value_positions(df, keys, value, places=places)
    known = df.where(F.col(value).isNotNull())
    if keys:
        placed = _join(found, known.groupBy(*keys).agg(F.count("*").alias("total")), keys)
    else:
        placed = found.withColumn("total", known.agg(F.count("*")).scalar())
    columns = []
    for name, p in points.items():
        position = F.lit(float(p)) * (F.col("total") - 1)
        low, high = F.floor(position), F.ceil(position)
        covers = lambda at: (F.col("before") <= at) & (at < F.col("before") + F.col("n"))
        lo = F.max(F.when(covers(low), F.col("value").cast("double")))
        hi = F.max(F.when(covers(high), F.col("value").cast("double")))
        share = F.max(position - low)
        columns.append((lo + (hi - lo) * share).alias(name))
    return placed.groupBy(*keys).agg(*columns)
