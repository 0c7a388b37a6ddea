"""Reports over the audit log, and model experiments over the prediction log."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import rules
from ..functions import clean
from .ranking import exact_percentiles


def _recent(df: DataFrame, day: str, as_of: dt.date, days: int) -> DataFrame:
    return df.where(F.col(day) >= F.lit(as_of - dt.timedelta(days=days)))


def audit_filter(
    log: DataFrame, as_of: dt.date, service: str, resource: str, days: int = 7, k: int | None = 100
) -> DataFrame:
    """Newest events of one service on resources that match a LIKE pattern."""
    path = F.concat_ws(".", "database_name", "table_name")
    hits = _recent(log, "query_date", as_of, days).where((F.col("service_name") == service) & path.like(resource))
    out = hits.select("query_id", "query_time", "username", "service_name", "operation_type",
                      path.alias("resource_path"), "client_ip_address", "status", "query_text")
    return out if k is None else out.orderBy(F.desc("query_time"), F.desc("query_id")).limit(k)


def audit_denied(log: DataFrame, as_of: dt.date, days: int = 7, k: int | None = 50) -> DataFrame:
    denied = _recent(log, "query_date", as_of, days).where(F.col("access_result") == "DENIED")
    out = denied.select("query_id", "query_time", "username", "operation_type",
                        F.concat_ws(".", "database_name", "table_name").alias("resource_path"), "access_result",
                        "policy_id", "client_ip_address")
    return out if k is None else out.orderBy(F.desc("query_time"), F.desc("query_id")).limit(k)


def audit_enrich(log: DataFrame, users: DataFrame, metrics: DataFrame, as_of: dt.date, days: int = 7) -> DataFrame:
    """Audit rows with their user's directory entry and the query's resource use."""
    recent = _recent(log, "query_date", as_of, days)
    return recent.join(users, "username", "left").join(metrics, "query_id", "left").select(
        "query_id", "query_date", "query_time", "username", "full_name", "department", "role", "database_name",
        "table_name", "operation_type", "query_text", "rows_read", "rows_written", "execution_time_ms", "cpu_seconds",
        "memory_gb_seconds", "client_ip_address", "status",
        F.round(F.col("rows_read") * F.lit(Decimal("0.001")), 2).alias("data_volume_mb"),
    )


def audit_summary(enriched: DataFrame) -> DataFrame:
    return enriched.groupBy("database_name", "table_name").agg(
        F.count_distinct("username").alias("unique_users"),
        F.count("*").alias("total_queries"),
        F.sum("rows_read").alias("total_rows_accessed"),
        clean.exact_ratio(F.sum("execution_time_ms"), F.count("execution_time_ms")).alias("avg_execution_time_ms"),
        F.sum("data_volume_mb").alias("total_data_volume_mb"),
    )


def audit_sensitive(enriched: DataFrame) -> DataFrame:
    return enriched.where(F.col("table_name").rlike(rules.SENSITIVE_TABLES)).select(
        "query_id", "query_date", "query_time", "username", "full_name", "department", "table_name", "operation_type",
        "rows_read", "client_ip_address",
    )


# --- experiments ----------------------------------------------------------------


def hash_slot(key: str) -> Column:
    """0..99, stable for a key across runs and clusters."""
    return F.pmod(F.xxhash64(key), F.lit(100))


def modulo_slot(key: str) -> Column:
    """0..99 from a whole-number key by a multiplicative mix."""
    return F.pmod(F.col(key) * 7919 + 13, F.lit(100))


def ab_assign(df: DataFrame, slot: Column, champion_pct: int = 80) -> DataFrame:
    """Champion or challenger per row; the same key always gets the same arm."""
    return df.withColumn("slot", slot).withColumn(
        "arm", F.when(F.col("slot") < champion_pct, "champion").otherwise("challenger")
    )


def ab_summary(assigned: DataFrame, latency: str = "latency_ms") -> DataFrame:
    """Requests, traffic share, mean and tail latency per arm, and the gain over the champion's mean."""
    basics = assigned.groupBy("arm").agg(
        F.count("*").alias("total_requests"), F.sum(latency).alias("s"), F.count(latency).alias("n")
    )
    tails = exact_percentiles(assigned, ["arm"], latency, {"p95": 0.95, "p99": 0.99})
    every = assigned.agg(F.count("*")).scalar()
    champion = assigned.where(F.col("arm") == "champion").agg(
        clean.exact_ratio(F.sum(latency), F.count(latency))
    ).scalar()
    mean = clean.exact_ratio("s", "n")
    return basics.join(tails, "arm").select(
        "arm", "total_requests", clean.percent("total_requests", every).alias("traffic_percentage"),
        mean.alias("avg_latency_ms"), F.round("p95", 2).alias("p95_latency_ms"), F.round("p99", 2).alias("p99_latency_ms"),
        clean.percent(champion - mean, champion).alias("improvement_pct"),
    )


def canary_stage(df: DataFrame, key: str, stages: Sequence[tuple[str, int]] = tuple(rules.CANARY_STAGES)) -> DataFrame:
    """Spread requests over the rollout stages and send each stage's share to the new model."""
    stage = F.pmod(F.floor(F.col(key) / 100), F.lit(len(stages)))
    names = F.array(*[F.lit(n) for n, _ in stages])
    shares = F.array(*[F.lit(p) for _, p in stages])
    at = (stage + 1).cast("int")
    return df.withColumn("canary_stage", F.element_at(names, at)).withColumn(
        "new_model_pct", F.element_at(shares, at)
    ).withColumn("uses_new_model", modulo_slot(key) < F.col("new_model_pct"))


def canary_decision(df: DataFrame, error: str, limit: str = rules.CANARY_ERROR_LIMIT) -> DataFrame:
    """Error rate of the new model per stage and what to do next."""
    new = F.col("uses_new_model")
    rates = df.groupBy("canary_stage", "new_model_pct").agg(
        F.count("*").alias("requests"),
        F.count_if(new).alias("new_requests"),
        F.count_if(new & (F.col(error) == 1)).alias("new_errors"),
    )
    rate = F.try_divide(F.col("new_errors").cast("decimal(20,0)"), F.col("new_requests").cast("decimal(20,0)"))
    return rates.select(
        "*", F.round(rate, 4).alias("error_rate"),
        F.when(clean.is_true(rate > F.lit(Decimal(limit))), "ROLLBACK").otherwise("ADVANCE").alias("decision"),
    )


def model_monitor(log: DataFrame, as_of: dt.date, days: int = 7) -> DataFrame:
    right = F.col("actual_fraud") == F.col("predicted_fraud")
    confidence = F.col("prediction_confidence")
    return _recent(log, "prediction_date", as_of, days).groupBy("model_version", "model_name").agg(
        F.count("*").alias("total_predictions"),
        F.round(F.try_divide(F.sum(confidence), F.count(confidence).cast("decimal(20,0)")), 3).alias("avg_confidence"),
        clean.exact_ratio(F.sum("latency_ms"), F.count("latency_ms")).alias("avg_latency"),
        clean.exact_ratio(F.count_if(right), F.count("*"), 4).alias("accuracy"),
        F.count_if(F.col("prediction_error") == 1).alias("error_count"),
        F.min("prediction_timestamp").alias("first_prediction"),
        F.max("prediction_timestamp").alias("last_prediction"),
    )


def format_instructions(turns: DataFrame) -> DataFrame:
    """Prompt text per user turn that an assistant turn follows.

    The reply is found by an equi join on (conversation, turn + 1), so a
    conversation of any length is never gathered in one task.
    """
    asked = turns.where(F.col("role") == "user").select("conv_id", "turn", F.col("text").alias("asked"))
    system = turns.where(F.col("role") == "system").groupBy("conv_id").agg(
        F.min_by("text", "turn").alias("instruction")
    )
    replies = turns.where(F.col("role") == "assistant").select(
        "conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("reply")
    )
    parts = [F.lit("### Instruction:\n"), F.coalesce("instruction", F.lit("Answer the client")),
             F.lit("\n\n### Input:\n"), F.col("asked"), F.lit("\n\n### Response:\n"), F.col("reply")]
    return asked.join(replies, ["conv_id", "turn"]).join(system, "conv_id", "left").select(
        "conv_id", "turn", F.concat(*parts).alias("text")
    )
