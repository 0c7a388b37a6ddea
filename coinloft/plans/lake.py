"""The layers as lazy DataFrames over one stage, and the jobs that store them."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import session
from ..sources import banking
from . import gold, silver


def load_bronze(stage: DataFrame, name: str, run_ts: dt.datetime, database: str = "test") -> DataFrame:
    """Stage rows with lineage stamps; transactions also get their partition columns."""
    out = stage.withColumn("load_timestamp", F.lit(run_ts)).withColumn("source_file", F.lit(f"{database}.{name}"))
    if name == "transactions":
        out = out.withColumn("transaction_year", F.year("transaction_date")).withColumn(
            "transaction_month", F.month("transaction_date")
        )
    return out


class _Frames(dict):
    """Builds a frame on first use."""

    def __init__(self, build):
        super().__init__()
        self._build = build

    def __missing__(self, name):
        self[name] = self._build(name)
        return self[name]


class Lake:
    """``stage``, ``bronze``, ``silver`` and ``gold`` map table names to DataFrames.

    ``source`` gives the stage tables, as ``FileStage`` does over the declared files; without it, ``folder`` holds the benchmark tables.
    """

    def __init__(self, spark: SparkSession, folder: str = "", as_of=banking.AS_OF, run_ts=banking.RUN_TS, source=None):
        self.spark = session.tune(spark)
        self.as_of, self.run_ts = as_of, run_ts
        self.source = source or banking.Stage(spark, folder)
        self.stage = _Frames(self.source.table)
        self.bronze = _Frames(lambda n: load_bronze(self.stage[n], n, run_ts))
        self.silver = _Frames(lambda n: silver.BUILDERS[n](self.bronze[n], as_of, run_ts))
        self.gold = _Frames(self._gold)

    def _gold(self, name: str) -> DataFrame:
        if name == "dim_date":
            bounds = self.silver["transactions"].agg(
                F.trunc(F.min("transaction_date_only"), "year").alias("first_day"),
                F.last_day(F.add_months(F.trunc(F.max("transaction_date_only"), "year"), 11)).alias("last_day"),
            )
            return gold.dim_date(gold.calendar_days(bounds))
        return getattr(gold, name)(self.silver, self.as_of, self.run_ts)

    def raw(self, name: str) -> DataFrame:
        return self.source.source(name)
