"""Aggregate patterns over any frame."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import clean
from .joins import at_least_one, match_counts, one_row
from .ranking import exact_percentiles


def agg_basic(df: DataFrame, keys: Sequence[str], column: str) -> DataFrame:
    c = F.col(column)
    return df.groupBy(*keys).agg(
        F.count("*").alias("row_count"),
        F.sum(c).alias("total"),
        clean.exact_ratio(F.sum(c), F.count(c)).alias("average"),
        F.min(c).alias("lowest"),
        F.max(c).alias("highest"),
    )


def agg_conditional(df: DataFrame, keys: Sequence[str], metrics: Mapping[str, tuple[Column, Column | None]]) -> DataFrame:
    """Per metric: rows that satisfy the condition, or the sum of a value over them."""
    return df.groupBy(*keys).agg(*[
        (F.count_if(test) if value is None else F.coalesce(F.sum(F.when(test, value)), F.lit(0))).alias(name)
        for name, (test, value) in metrics.items()
    ])


def agg_distinct(df: DataFrame, keys: Sequence[str], columns: Sequence[str], approx: bool = False) -> DataFrame:
    count = F.approx_count_distinct if approx else F.count_distinct
    return df.groupBy(*keys).agg(*[count(c).alias(f"distinct_{c}") for c in columns])


def agg_distinct_conditional(df: DataFrame, keys: Sequence[str], metrics: Mapping[str, tuple[str, Column]]) -> DataFrame:
    return df.groupBy(*keys).agg(*[F.count_distinct(F.when(test, F.col(c))).alias(n) for n, (c, test) in metrics.items()])


def agg_ratio(df: DataFrame, keys: Sequence[str], name: str, part: Column, whole: Column) -> DataFrame:
    return df.groupBy(*keys).agg(clean.percent(part, whole).alias(name))


def agg_by_expression(df: DataFrame, name: str, expression: Column, *aggregates: Column) -> DataFrame:
    return df.groupBy(expression.alias(name)).agg(*aggregates)


def agg_bool_any(df: DataFrame, keys: Sequence[str], flag: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.bool_or(flag).alias(f"any_{flag}"))


def agg_stddev(df: DataFrame, keys: Sequence[str], column: str, places: int = 2) -> DataFrame:
    """Sample standard deviation."""
    return df.groupBy(*keys).agg(F.count(column).alias("n"), F.round(F.stddev(column), places).alias("deviation"))


def agg_percentile(df: DataFrame, keys: Sequence[str], column: str, points: Mapping[str, float]) -> DataFrame:
    """Exact and distributed: no task holds the values of a group."""
    return exact_percentiles(df, keys, column, points)


def outliers_iqr(df: DataFrame, column: str, k: float = 1.5) -> DataFrame:
    """Quartiles, fences and the number of values outside them."""
    q = exact_percentiles(df, [], column, {"q1": 0.25, "median": 0.5, "q3": 0.75})
    fences = q.withColumn("low_fence", F.col("q1") - k * (F.col("q3") - F.col("q1"))).withColumn(
        "high_fence", F.col("q3") + k * (F.col("q3") - F.col("q1"))
    )
    counted = df.where(F.col(column).isNotNull()).groupBy(F.col(column).cast("double").alias("v")).agg(F.count("*").alias("n"))
    outside = (F.col("v") < F.col("f.low_fence")) | (F.col("v") > F.col("f.high_fence"))
    return counted.withColumn("f", one_row(fences)).groupBy("f").agg(
        F.sum("n").alias("total_records"), F.coalesce(F.sum(F.when(outside, F.col("n"))), F.lit(0)).alias("outlier_count")
    ).select("f.*", "total_records", "outlier_count")


def agg_windowed_recent(
    df: DataFrame, keys: Sequence[str], day: str, as_of: dt.date, value: str, days: int = 30
) -> DataFrame:
    """Counts and sums over the rolling window that ends on the report day, keys without recent rows kept."""
    recent = F.col(day) >= F.lit(as_of - dt.timedelta(days=days))
    return df.groupBy(*keys).agg(
        F.count("*").alias("row_count"),
        F.count_if(recent).alias("recent_count"),
        F.coalesce(F.sum(F.when(recent, F.col(value))), F.lit(0)).alias("recent_total"),
    )


def fanout_join_agg(
    base: DataFrame, keys: Sequence[str], branches: Mapping[str, tuple[DataFrame, str, str]], fanout_safe: bool = False
) -> DataFrame:
    """Totals after left joining several one-to-many frames to ``base``.

    ``branches``: name -> (frame, join key, summed column). Each branch yields
    ``<name>_rows`` (its matched rows) and ``<name>_total``. As the joins would,
    every total counts once per combination with the other branches' rows; the
    product of match counts gives that without building the combinations. With
    ``fanout_safe`` every row counts once.
    """
    out = base
    for name, (frame, on, column) in branches.items():
        sums = match_counts(frame.select(on, column), on, s=F.sum(column))
        out = out.join(sums.withColumnsRenamed({"n": f"_{name}_n", "s": f"_{name}_s"}), on, "left")
    columns = []
    for name in branches:
        others = F.lit(1)
        for other in branches:
            if other != name and not fanout_safe:
                others = others * at_least_one(f"_{other}_n")
        columns.append(F.coalesce(F.sum(F.col(f"_{name}_n") * others), F.lit(0)).alias(f"{name}_rows"))
        columns.append(F.sum(F.col(f"_{name}_s") * others).alias(f"{name}_total"))
    return out.groupBy(*keys).agg(*columns)


def top_k(df: DataFrame, order: Sequence[Column | str], k: int) -> DataFrame:
    """Each task keeps its own k rows. The order must end in a unique column."""
    return df.orderBy(*order).limit(k)


def order_multi(df: DataFrame, order: Sequence[tuple[str, str]]) -> DataFrame:
    return df.orderBy(*[F.col(c).desc() if way == "desc" else F.col(c).asc() for c, way in order])
