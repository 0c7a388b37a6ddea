"""Latest-record selection and duplicate reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def dedup_latest(df: DataFrame, keys: Sequence[str], newest_first: Sequence[str | Column]) -> DataFrame:
    """Keep the first row per key. The order must end in a unique column.

    Spark limits each key to one row per task before the shuffle (the
    rank filter is pushed into a map-side group limit), so copies of a hot key
    never meet in one task.
    """
    order = [c if isinstance(c, Column) else F.col(c).desc() for c in newest_first]
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).where(F.col("_rank") == 1).drop("_rank")


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys held by more than one row, with their row count."""
    return df.groupBy(*keys).agg(F.count("*").alias("row_count")).where(F.col("row_count") > 1)
