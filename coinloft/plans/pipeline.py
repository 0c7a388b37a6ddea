"""The daily load: stage -> bronze -> silver -> gold, each layer stored under one root.

Each layer is read back from its files, so a lost executor costs a re-read and
gold tables share the stored silver rows. Row counts come from the stored
files' footers, not from running the transformation twice.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import history, profile, tables
from ..operators.dedup import dedup_latest
from ..session import tune
from . import gates, gold, silver
from .lake import load_bronze
from .load_checks import quality_specs

GOLD_TABLES = [
    "dim_client", "dim_product", "dim_branch", "dim_date", "dim_account", "fact_transactions_daily", "fact_account_balance_daily",
    "fact_loan_performance", "client_360_view", "product_performance_summary", "branch_performance_dashboard",
    "financial_kpi_summary", "data_quality_dashboard",
]


class Pipeline:
    calendar = (dt.date(2020, 1, 1), dt.date(2027, 12, 31))  # first and last day of dim_date

    def __init__(
        self, spark: SparkSession, root: str, as_of: dt.date, run_ts: dt.datetime, limits: Mapping = gates.LIMITS, environment: str = "default",
    ):
        """``limits`` and ``environment`` are those of the quality gate (``rules.THRESHOLDS``)."""
        self.spark = tune(spark)
        self.root, self.as_of, self.run_ts = root.rstrip("/"), as_of, run_ts
        self.gates = gates.Gates(self.spark, f"{self.root}/gates", run_ts, limits, environment)

    def path(self, layer: str, name: str) -> str:
        return f"{self.root}/{layer}/{name}"

    def read(self, layer: str, name: str) -> DataFrame:
        return self.spark.read.parquet(self.path(layer, name))

    def _store(self, layer: str, name: str, df: DataFrame, partition_cols: Iterable[str]) -> None:
        """Silver is refreshed whole; partitioned bronze and gold tables replace the partitions they deliver."""
        cols = list(partition_cols)
        if layer == "silver":
            tables.write_full_refresh(df, self.path(layer, name), cols)
        elif cols:
            tables.write_partition_overwrite(df, self.path(layer, name), cols)
        else:
            tables.write_full_refresh(df, self.path(layer, name))

    def bronze(self, stage: Callable[[str], DataFrame], names: Iterable[str] = tuple(silver.KEYS)) -> dict[str, int | None]:
        """Store the sources; returns the rows of each that passed while they were written."""
        passed = {}
        for name in names:
            parts = silver.PARTITIONS["transactions"] if name == "transactions" else []
            rows, count = gates.counted(load_bronze(stage(name), name, self.run_ts), name)
            self._store("bronze", name, rows, parts)
            passed[name] = count()
        return passed

    def _loaded(self, name: str) -> DataFrame:
        """This run's rows of a bronze table; months of earlier transactions may lie beside them."""
        rows = self.read("bronze", name)
        return rows.where(F.col("load_timestamp") == F.lit(self.run_ts)) if name == "transactions" else rows

    def _through_silver(self, stage: Callable[[str], DataFrame], names: Iterable[str], dedup: bool = False) -> None:
        """Bronze and silver of ``names`` with the gates before, between and after; a failed one raises ``GateFailed``."""
        names = list(names)
        self.gates.preflight(stage, [n for n in gates.REQUIRED if n in names])
        self.gates.bronze(self.bronze(stage, names), {n: self._loaded(n) for n in names}, stage)
        self.silver(names, dedup=dedup)
        self.gates.silver({n: self.read("bronze", n) for n in names}, {n: self.read("silver", n) for n in names})
        self.gates.clients(self.read("silver", "clients"))

    def silver(self, names: Iterable[str] = tuple(silver.KEYS), dedup: bool = False) -> None:
        for name in names:
            df = silver.BUILDERS[name](self.read("bronze", name), self.as_of, self.run_ts, dedup=dedup)
            self._store("silver", name, df, silver.PARTITIONS.get(name, []))

    def client_versions(self, clients: DataFrame) -> DataFrame:
        """The clients' versions, this run's snapshot merged in; of rows that share an id the newest counts."""
        tracked = {c: clients.schema[c].dataType for c in gold.CLIENT_TRACKED}
        store = history.VersionTable(self.spark, self.path("history", "clients"), "client_id", tracked, clients.schema["client_id"].dataType)
        newest = dedup_latest(clients.select("client_id", *tracked), ["client_id"], ["registration_date", *(c for c in tracked if c != "registration_date")])
        store.merge(newest, self.as_of, self.run_ts, first_day="registration_date")
        return store.read()

    def gold(self, names: Iterable[str] = tuple(GOLD_TABLES)) -> None:
        frames = {name: self.read("silver", name) for name in silver.KEYS}
        for name in names:
            if name == "data_quality_dashboard":
                df = profile.data_quality_dashboard(quality_specs(frames), self.as_of, self.run_ts)
            elif name == "dim_date":
                bounds = self.spark.range(1).select(*[F.lit(d).alias(n) for d, n in zip(self.calendar, ("first_day", "last_day"))])
                df = gold.dim_date(gold.calendar_days(bounds))
            elif name == "dim_client":
                df = gold.dim_client(frames, self.as_of, self.run_ts, self.client_versions(frames["clients"]))
            else:
                df = getattr(gold, name)(frames, self.as_of, self.run_ts)
            self._store("gold", name, df, gold.PARTITIONS.get(name, []))

    def _add_transactions(self, fresh: DataFrame) -> None:
        """New transactions join bronze, and silver and the daily fact are rebuilt for the months they fall in."""
        months = silver.PARTITIONS["transactions"]
        before = self.run_ts - dt.timedelta(microseconds=1)
        stored = self.read("bronze", "transactions")
        if history.newer_than(stored, "load_timestamp", before).isEmpty():  # a run that is repeated adds nothing
            tables.write_append(load_bronze(fresh, "transactions", self.run_ts), self.path("bronze", "transactions"), months)
        clean = lambda rows: silver.BUILDERS["transactions"](rows, self.as_of, self.run_ts)
        frames = {name: self.read("silver", name) for name in silver.KEYS}
        fact = lambda rows: gold.fact_transactions_daily({**frames, "transactions": rows}, self.as_of, self.run_ts)
        bronze = self.read("bronze", "transactions")
        if history.incremental_load(bronze, self.path("silver", "transactions"), clean, before, months, months):
            history.incremental_load(
                self.read("silver", "transactions"), self.path("gold", "fact_transactions_daily"), fact, before, months,
                gold.PARTITIONS["fact_transactions_daily"])

    def compact(self, target_mb: float = 256) -> dict[str, int]:
        """Pack the small files of all partitioned tables; the number of partitions rewritten per table."""
        parts = {("bronze", "transactions"): silver.PARTITIONS["transactions"]}
        parts |= {(layer, n): cols for layer, each in (("silver", silver.PARTITIONS), ("gold", gold.PARTITIONS)) for n, cols in each.items()}
        return {
            f"{layer}.{n}": tables.compact_in_place(self.spark, self.path(layer, n), cols, target_mb)
            for (layer, n), cols in parts.items() if cols and tables.exists(self.spark, self.path(layer, n))
        }

    def run(self, stage: Callable[[str], DataFrame], dedup: bool = False, mode: str = "full") -> DataFrame:
        """All layers, then the row count of every stored table. Gates stand between the layers (``gates.Gates``): gold is
        built only from sources that arrived whole and clients within the limits; a failed gate raises ``GateFailed``.

        ``mode="incremental"`` needs the tables of an earlier run with ``dedup=False`` and a later ``run_ts``. The stage's transactions
        are then only the new ones, of any date; the other tables come whole. Facts of months without new
        transactions keep the client and branch their accounts had.
        """
        if mode not in ("full", "incremental"):
            raise ValueError(f"mode {mode!r} is neither 'full' nor 'incremental'")
        if mode == "full":
            self._through_silver(stage, silver.KEYS, dedup)
            self.gold()
        elif dedup:
            raise ValueError("a repeated key may lie in any month: deduplicated tables need a full run")
        else:
            others = [name for name in silver.KEYS if name != "transactions"]
            self._through_silver(stage, others)
            self._add_transactions(stage("transactions"))
            self.gold([name for name in GOLD_TABLES if name != "fact_transactions_daily"])
        self.gates.gold(self.read("gold", "fact_transactions_daily"), self.read("silver", "transactions"))
        stored = {f"{layer}.{n}": self.read(layer, n) for layer, names in (
            ("bronze", silver.KEYS), ("silver", silver.KEYS), ("gold", GOLD_TABLES)) for n in names}
        return tables.union_all_report(stored)
