"""Gates of the daily load: what must hold before the next layer is built. Every outcome is stored, then a failure stops the run."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Iterable, Mapping

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from .. import rules
from ..operators import quality, tables

REQUIRED = ("clients", "products", "transactions", "accounts")  # sources that never come empty
# least row counts depend on the bank's size, so none is set unless the caller gives some
LIMITS = {**rules.THRESHOLDS, "min_rows": {}}


class GateFailed(RuntimeError):
    """A gate did not hold; ``outcomes`` are its (table, measured, status) rows."""

    def __init__(self, gate: str, outcomes: list[tuple[str, str, str]]):
        self.gate, self.outcomes = gate, outcomes
        super().__init__(f"{gate}: " + "; ".join(f"{t} ({m})" for t, m, s in outcomes if s == "FAIL"))


class Gates:
    """The gates of one run. Outcomes are appended to the table at ``path``, a failed run's as well."""

    def __init__(self, spark: SparkSession, path: str, run_ts: dt.datetime, limits: Mapping = LIMITS, environment: str = "default"):
        self.spark, self.path, self.run_ts, self.limits, self.environment = spark, path, run_ts, limits, environment

    def _settle(self, gate: str, outcomes: Iterable[tuple[str, str, bool]]) -> None:
        rows = [(t, m, "PASS" if ok else "FAIL") for t, m, ok in outcomes]
        found = self.spark.createDataFrame([(gate, *r) for r in rows], "gate string, table_name string, measured string, status string")
        tables.write_append(found.withColumn("run_timestamp", F.lit(self.run_ts)), self.path)
        if any(status == "FAIL" for *_, status in rows):
            raise GateFailed(gate, rows)

    def preflight(self, stage: Callable[[str], DataFrame], names: Iterable[str] = REQUIRED) -> None:
        """Required sources hold a row at least. Nothing is overwritten before; one row of each is read."""
        self._settle("preflight", [(n, "no rows" if (empty := stage(n).isEmpty()) else "has rows", not empty) for n in names])

    def bronze(self, delivered: Mapping[str, int | None], stored: Mapping[str, DataFrame], stage: Callable[[str], DataFrame]) -> None:
        """Bronze holds the rows that were delivered.

        ``delivered`` was counted by the pass that wrote them. A pass that lost an executor may have counted rows twice, so
        the source is counted afresh before a difference counts.
        """
        outcomes = []
        for name, held in self._counts(stored).items():
            came = delivered.get(name)
            if came != held:
                came = stage(name).count()
            outcomes.append((name, f"{came} delivered, {held} stored", came == held))
        self._settle("bronze", outcomes)

    def silver(self, bronze: Mapping[str, DataFrame], silver: Mapping[str, DataFrame]) -> None:
        """No silver table has more rows than its bronze table, and none is empty where that is not."""
        before, after = self._counts(bronze), self._counts(silver)
        self._settle("silver", [(n, f"{before[n]} bronze, {after[n]} silver", after[n] <= before[n] and (after[n] > 0 or before[n] == 0)) for n in after])

    def clients(self, rows: DataFrame) -> None:
        """Mean score, missing values, repeated keys and row count of the clients keep to the limits."""
        r = quality.dq_threshold_gate(rows, "clients", "client_id", "dq_score", list(rules.CLIENT_WEIGHTS), self.limits, self.environment).first()
        measured = f"score {r.avg_score}, nulls {r.null_rate}, duplicates {r.duplicate_rate}, rows {r.row_count}"
        self._settle("quality", [("clients", measured, r.gate_status == "PASS")])

    def gold(self, fact: DataFrame, transactions: DataFrame) -> None:
        """The daily fact counts every silver transaction once."""
        counted = fact.agg(F.sum("transaction_count")).first()[0] or 0
        held = transactions.count()
        self._settle("gold", [("fact_transactions_daily", f"{held} silver, {counted} in the fact", counted == held)])

    @staticmethod
    def _counts(frames: Mapping[str, DataFrame]) -> dict[str, int]:
        """Rows of stored tables, from their files' footers, all in one job."""
        return {r.table_name: r.record_count for r in tables.union_all_report(frames).collect()}


def counted(df: DataFrame, name: str) -> tuple[DataFrame, Callable[[], int | None]]:
    """``df`` and, for after it was written, the number of rows that passed."""
    seen = Observation(f"rows of {name}")
    return df.observe(seen, F.count(F.lit(1)).alias("passed")), lambda: seen.get.get("passed")
