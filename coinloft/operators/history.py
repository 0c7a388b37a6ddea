"""Slowly changing dimensions, change feeds and incremental loads."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import tables
from .dedup import dedup_latest

SCD = ["effective_date", "end_date", "is_current"]


def _fingerprint(columns: Sequence[str]) -> Column:
    """Exact comparison value of the tracked columns (NULL is a value of its own)."""
    return F.struct(*[F.col(c) for c in columns])


def scd2_merge(current: DataFrame, incoming: DataFrame, key: str, tracked: Sequence[str], as_of: dt.date) -> DataFrame:
    """Close versions whose tracked columns changed and open new ones.

    ``current`` carries effective_date, end_date and is_current. Keys missing
    from ``incoming`` stay open. History rows pass through without a join.
    """
    columns = [key, *tracked]
    history = current.where(~F.col("is_current")).select(*columns, *SCD)
    old = current.where("is_current").select(F.col(key), _fingerprint(tracked).alias("old"), "effective_date")
    new = incoming.select(F.col(key), _fingerprint(tracked).alias("new"))
    both = old.join(new, key, "full")
    day = F.lit(as_of)
    is_old, is_new = F.col("old").isNotNull(), F.col("new").isNotNull()
    changed = is_old & is_new & ~F.col("old").eqNullSafe(F.col("new"))

    def version(row, start, end, open_):
        return F.struct(row.alias("row"), start.alias("effective_date"), end.alias("end_date"), open_.alias("is_current"))

    none = F.lit(None).cast("date")
    kept = F.when(is_old & ~changed, version(F.col("old"), F.col("effective_date"), none, F.lit(True)))
    closed = F.when(changed, version(F.col("old"), F.col("effective_date"), day, F.lit(False)))
    opened = F.when(is_new & (changed | ~is_old), version(F.col("new"), day, none, F.lit(True)))
    versions = both.select(key, F.explode(F.filter(F.array(kept, closed, opened), lambda v: v.isNotNull())).alias("v"))
    rows = versions.select(key, *[F.col(f"v.row.{c}").alias(c) for c in tracked], *[f"v.{c}" for c in SCD])
    return history.unionByName(rows)


class VersionTable:
    """A dimension's versions under ``path``: closed ones are appended run by run, the open ones are replaced by each run.

    A run writes the folders ``run=<load time>/is_current=<flag>`` in one pass and counts once its row in ``runs`` is
    there: one that broke off is done again, one that is repeated changes nothing. Only open versions are read and
    joined; a closed one is never read again by a merge. The open folders of the last two runs are kept.
    """

    def __init__(self, spark: SparkSession, path: str, key: str, tracked: Mapping[str, T.DataType], key_type: T.DataType):
        self.spark, self.key, self.tracked = spark, key, list(tracked)
        self.versions, self.runs = f"{path}/versions", f"{path}/runs"
        fields = [(key, key_type), *tracked.items(), ("effective_date", T.DateType()), ("end_date", T.DateType()),
                  ("run", T.LongType()), ("is_current", T.BooleanType())]
        self.schema = T.StructType([T.StructField(n, t) for n, t in fields])

    def _last(self) -> int | None:
        if not tables.exists(self.spark, self.runs):
            return None
        return self.spark.read.schema("run long").parquet(self.runs).agg(F.max("run")).first()[0]

    def _read(self, last: int) -> DataFrame:
        rows = self.spark.read.schema(self.schema).parquet(self.versions)
        done = self.spark.read.schema("run long").parquet(self.runs).select(F.col("run").alias("done"))  # a row per run
        rows = rows.where((~F.col("is_current") & (F.col("run") <= last)) | (F.col("is_current") & (F.col("run") == last)))
        return rows.join(done, F.col("run") == F.col("done"), "left_semi").drop("run")

    def read(self) -> DataFrame:
        """Every version, closed and open."""
        last = self._last()
        return self.spark.createDataFrame([], self.schema).drop("run") if last is None else self._read(last)

    def merge(self, incoming: DataFrame, as_of: dt.date, run_ts: dt.datetime, first_day: str | None = None) -> None:
        """Bring in a snapshot with one row per key. Versions open on ``as_of``; with ``first_day`` those of the very first run
        open on that column's day, if it has one before. Keys missing from the snapshot stay open."""
        run, last = int(run_ts.replace(tzinfo=dt.timezone.utc).timestamp() * 1_000_000), self._last()
        if last is not None and run <= last:
            if run < last:
                raise ValueError("a run with a later load time is stored already")
            return
        if last is None:
            start = F.lit(as_of) if first_day is None else F.least(F.col(first_day), F.lit(as_of))
            rows = incoming.select(self.key, *self.tracked, start.alias("effective_date"), F.lit(None).cast("date").alias("end_date"), F.lit(True).alias("is_current"))
        else:
            rows = scd2_merge(self._read(last).where("is_current"), incoming, self.key, self.tracked, as_of)
        tables.write_partition_overwrite(rows.withColumn("run", F.lit(run).cast("long")), self.versions, ["run", "is_current"])
        self.spark.range(1).select(F.lit(run).cast("long").alias("run")).coalesce(1).write.mode("append").parquet(self.runs)
        older = [r.run for r in self.spark.read.schema("run long").parquet(self.runs).distinct().collect() if r.run < (last or 0)]
        for run in older:
            tables.remove(self.spark, f"{self.versions}/run={run}/is_current=true")


def cdc_apply(
    base: DataFrame, changes: DataFrame, key: str, order: Sequence[str], op: str = "op", delete: str = "D"
) -> DataFrame:
    """Apply the latest change per key: upserts replace or add the row, deletes remove it."""
    last = dedup_latest(changes, [key], order)
    untouched = base.join(last.select(key), key, "left_anti")
    return untouched.unionByName(last.where(F.col(op) != delete).select(*base.columns))


def newer_than(df: DataFrame, column: str, high_water) -> DataFrame:
    """Rows after the last run; reaches the scan as a pushed filter."""
    return df.where(F.col(column) > F.lit(high_water))


def affected_partitions(fresh: DataFrame, partition_cols: Sequence[str]) -> Column | None:
    """A filter on exactly the partitions that hold fresh rows, in constants, so that only their folders are read.

    The driver sees one row per touched partition (a month), not the rows. None where nothing is fresh.
    """
    found = fresh.select(*partition_cols).distinct().collect()
    match = lambda c, v: F.col(c).isNull() if v is None else F.col(c) == F.lit(v)
    folders = [reduce(lambda a, b: a & b, [match(c, row[c]) for c in partition_cols]) for row in found]
    return reduce(lambda a, b: a | b, folders) if folders else None


def incremental_load(
    stored: DataFrame, path: str, build: Callable[[DataFrame], DataFrame], high_water: dt.datetime,
    partition_cols: Sequence[str], target_cols: Sequence[str], ts_col: str = "load_timestamp",
) -> bool:
    """Rebuild the partitions of the table at ``path`` that rows loaded after ``high_water`` touch; False if there are none.

    ``stored`` is partitioned by ``partition_cols``, and rows of one of its partitions come only into the like partition of
    ``build``'s table. Freshness is load time: a row that arrives late with an old date is picked up.
    """
    touched = affected_partitions(newer_than(stored, ts_col, high_water), partition_cols)
    if touched is None:
        return False
    tables.write_partition_overwrite(build(stored.where(touched)), path, target_cols)
    return True


def incremental_rebuild(full: DataFrame, fresh: DataFrame, partition_cols: Sequence[str]) -> DataFrame:
    """All rows of the partitions the fresh rows touch, as a join that stays lazy."""
    return full.join(fresh.select(*partition_cols).distinct(), list(partition_cols), "left_semi")
