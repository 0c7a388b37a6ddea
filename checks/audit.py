"""Audit reports, experiments, change feeds and prompt text."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from coinloft import rules
from coinloft.operators import audit, history, tables
from coinloft.plans import gold
from coinloft.session import work_folder
from coinloft.sources.banking import EVENTS_AS_OF as EVENTS_DAY

from .base import EVENTS_AS_OF, half_up, mean
from .core import VIEWS, check

VIEWS["ax_audit"] = f"""
    SELECT query_id, query_date, query_time, username, full_name, department, role, database_name, table_name, operation_type,
           query_text, rows_read, rows_written, execution_time_ms, cpu_seconds, memory_gb_seconds, client_ip_address, status,
           {half_up('rows_read', '1000')} AS data_volume_mb
    FROM raw_audit_log LEFT JOIN raw_user_directory USING (username) LEFT JOIN raw_resource_metrics USING (query_id)
    WHERE query_date >= {EVENTS_AS_OF} - 7"""


def _enriched(k):
    return audit.audit_enrich(k.stage["audit_log"], k.stage["user_directory"], k.stage["resource_metrics"], EVENTS_DAY)


check("audit_filter", f"""
    SELECT query_id, query_time, username, service_name, operation_type, database_name || '.' || table_name AS resource_path,
           client_ip_address, status, query_text FROM raw_audit_log
    WHERE query_date >= {EVENTS_AS_OF} - 7 AND service_name = 'HIVE' AND contains(database_name || '.' || table_name, 'silver.clients')
    ORDER BY query_time DESC, query_id DESC LIMIT 100""")(
    lambda k: audit.audit_filter(k.stage["audit_log"], EVENTS_DAY, "HIVE", "%silver.clients%"))
check("audit_denied", f"""
    SELECT query_id, query_time, username, operation_type, database_name || '.' || table_name AS resource_path, access_result,
           policy_id, client_ip_address FROM raw_audit_log
    WHERE query_date >= {EVENTS_AS_OF} - 7 AND access_result = 'DENIED' ORDER BY query_time DESC, query_id DESC LIMIT 50""")(
    lambda k: audit.audit_denied(k.stage["audit_log"], EVENTS_DAY))
check("enrich_left_3way", "SELECT * FROM ax_audit")(_enriched)
check("audit_enrich", "SELECT * FROM ax_audit")(_enriched)
check("audit_summary", f"""
    SELECT database_name, table_name, count(DISTINCT username) AS unique_users, count(*) AS total_queries,
           sum(rows_read) AS total_rows_accessed, {half_up('sum(execution_time_ms)', 'count(execution_time_ms)')} AS avg_execution_time_ms,
           sum(CAST(round(data_volume_mb * 100) AS BIGINT)) / 100.0 AS total_data_volume_mb FROM ax_audit GROUP BY ALL""")(
    lambda k: audit.audit_summary(_enriched(k)))
check("audit_sensitive", f"""
    SELECT query_id, query_date, query_time, username, full_name, department, table_name, operation_type, rows_read, client_ip_address
    FROM ax_audit WHERE regexp_matches(table_name, '{rules.SENSITIVE_TABLES}')""")(lambda k: audit.audit_sensitive(_enriched(k)))

VIEWS["ax_arms"] = """
    SELECT *, (request_id * 7919 + 13) % 100 AS slot, IF((request_id * 7919 + 13) % 100 < 80, 'champion', 'challenger') AS arm
    FROM raw_prediction_log"""


def _arms(k):
    return audit.ab_assign(k.stage["prediction_log"], audit.modulo_slot("request_id"))


check("ab_assign", "SELECT request_id, slot, arm FROM ax_arms")(lambda k: _arms(k).select("request_id", "slot", "arm"))
check("ab_assign_hashed")(lambda k: audit.ab_assign(k.stage["prediction_log"], audit.hash_slot("request_id")).groupBy("arm").count())
check("ab_summary", f"""
    WITH a AS (SELECT arm, count(*) AS total_requests, {mean('latency_ms')} AS avg_latency_ms,
                      quantile_cont(CAST(latency_ms AS DOUBLE), 0.95) AS p95, quantile_cont(CAST(latency_ms AS DOUBLE), 0.99) AS p99
               FROM ax_arms GROUP BY arm)
    SELECT arm, total_requests, {half_up('total_requests * 100', '(SELECT sum(total_requests) FROM a)')} AS traffic_percentage,
           avg_latency_ms, round(p95, 2) AS p95_latency_ms, round(p99, 2) AS p99_latency_ms,
           {half_up("(CAST(round((SELECT avg_latency_ms FROM a WHERE arm = 'champion') * 100) AS BIGINT) - CAST(round(avg_latency_ms * 100) AS BIGINT)) * 100",
                    "CAST(round((SELECT avg_latency_ms FROM a WHERE arm = 'champion') * 100) AS BIGINT)")} AS improvement_pct
    FROM a""")(lambda k: audit.ab_summary(_arms(k)))
check("canary_decision", f"""
    WITH s AS (SELECT *, [{', '.join(repr(n) for n, _ in rules.CANARY_STAGES)}][1 + request_id // 100 % 4] AS canary_stage,
                      [{', '.join(str(p) for _, p in rules.CANARY_STAGES)}][1 + request_id // 100 % 4] AS new_model_pct FROM ax_arms),
         c AS (SELECT canary_stage, new_model_pct, count(*) AS requests, count(*) FILTER (slot < new_model_pct) AS new_requests,
                      count(*) FILTER (slot < new_model_pct AND prediction_error = 1) AS new_errors FROM s GROUP BY ALL)
    SELECT *, {half_up('new_errors', 'new_requests', 4)} AS error_rate,
           IF(new_errors * 100 > new_requests * 5, 'ROLLBACK', 'ADVANCE') AS decision FROM c""")(
    lambda k: audit.canary_decision(audit.canary_stage(k.stage["prediction_log"], "request_id"), "prediction_error"))
check("model_monitor", f"""
    SELECT model_version, model_name, count(*) AS total_predictions,
           {half_up('sum(CAST(prediction_confidence * 1000 AS BIGINT))', 'count(*) * 1000', 3)} AS avg_confidence,
           {mean('latency_ms')} AS avg_latency, {half_up('count(*) FILTER (actual_fraud = predicted_fraud)', 'count(*)', 4)} AS accuracy,
           count(*) FILTER (prediction_error = 1) AS error_count, min(prediction_timestamp) AS first_prediction,
           max(prediction_timestamp) AS last_prediction
    FROM raw_prediction_log WHERE prediction_date >= {EVENTS_AS_OF} - 7 GROUP BY ALL""")(
    lambda k: audit.model_monitor(k.stage["prediction_log"], EVENTS_DAY))
check("format_instructions", """
    SELECT u.conv_id, u.turn,
           '### Instruction:' || chr(10) || ifnull((SELECT arg_min(s.text, s.turn) FROM conversations s WHERE s.conv_id = u.conv_id AND s.role = 'system'), 'Answer the client')
           || chr(10) || chr(10) || '### Input:' || chr(10) || u.text || chr(10) || chr(10) || '### Response:' || chr(10) || a.text AS text
    FROM conversations u JOIN conversations a ON a.conv_id = u.conv_id AND a.turn = u.turn + 1
    WHERE u.role = 'user' AND a.role = 'assistant'""")(lambda k: audit.format_instructions(k.raw("conversations")))

# --- change handling -----------------------------------------------------------------


@check("scd2_merge", """
    WITH old AS (SELECT client_id, city, risk_category FROM sv_clients WHERE registration_date <= DATE '2001-01-01'),
         new AS (SELECT client_id, IF(email IS NULL, 'MOVED', city) AS city, risk_category FROM sv_clients),
         pair AS (SELECT n.client_id, o.city AS oc, o.risk_category AS orisk, n.city AS nc, n.risk_category AS nr,
                         o.client_id IS NOT NULL AS has_old,
                         o.client_id IS NOT NULL AND (o.city IS DISTINCT FROM n.city OR o.risk_category IS DISTINCT FROM n.risk_category) AS changed
                  FROM new n LEFT JOIN old o ON o.client_id = n.client_id)
    SELECT client_id, oc AS city, orisk AS risk_category, DATE '2001-01-01' AS effective_date, NULL::DATE AS end_date, TRUE AS is_current
    FROM pair WHERE has_old AND NOT changed
    UNION ALL SELECT client_id, oc, orisk, DATE '2001-01-01', DATE '2001-11-05', FALSE FROM pair WHERE changed
    UNION ALL SELECT client_id, nc, nr, DATE '2001-11-05', NULL::DATE, TRUE FROM pair WHERE changed OR NOT has_old""")
def _(k):
    """The dimension holds the clients registered by 2001; a full snapshot arrives in which some have moved."""
    c = k.silver["clients"]
    current = c.where(F.col("registration_date") <= F.lit("2001-01-01").cast("date")).select(
        "client_id", "city", "risk_category", F.lit("2001-01-01").cast("date").alias("effective_date"),
        F.lit(None).cast("date").alias("end_date"), F.lit(True).alias("is_current"))
    moved = F.when(F.col("email").isNull(), "MOVED").otherwise(F.col("city"))
    incoming = c.select("client_id", moved.alias("city"), "risk_category")
    return history.scd2_merge(current, incoming, "client_id", ["city", "risk_category"], k.as_of)


@check("cdc_apply", """
    WITH ch AS (SELECT transaction_id // 10 AS account_id, 'BR' || (transaction_id % 10) AS branch_code,
                       IF(amount < 0, 'D', 'U') AS op, transaction_date, transaction_uuid FROM sv_transactions),
         last AS (SELECT * FROM ch QUALIFY row_number() OVER (PARTITION BY account_id ORDER BY transaction_date DESC, transaction_uuid DESC) = 1)
    SELECT account_id, branch_code FROM raw_accounts WHERE account_id NOT IN (SELECT account_id FROM last)
    UNION ALL SELECT account_id, branch_code FROM last WHERE op <> 'D'""")
def _(k):
    base = k.stage["accounts"].select("account_id", "branch_code")
    changes = k.silver["transactions"].select(
        F.floor(F.col("transaction_id") / 10).alias("account_id"),
        F.concat(F.lit("BR"), F.col("transaction_id") % 10).alias("branch_code"),
        F.when(F.col("amount") < 0, "D").otherwise("U").alias("op"), "transaction_date", "transaction_uuid")
    return history.cdc_apply(base, changes, "account_id", ["transaction_date", "transaction_uuid"])


@check("incremental_load", "SELECT * FROM gd_fact_transactions_daily")
def _(k):
    """Every seventh order's rows are loaded a day later, whatever their dates; only the months they touch are rebuilt."""
    late = F.col("transaction_id") % 70 < 10
    loaded = F.when(late, F.lit(k.run_ts)).otherwise(F.lit(k.run_ts - dt.timedelta(days=1)))
    rows = k.silver["transactions"].withColumn("load_timestamp", loaded)
    month, fact_month = ["transaction_year", "transaction_month"], ["year", "month"]
    store, path = work_folder(k.spark, "silver"), work_folder(k.spark, "fact")
    build = lambda t: gold.fact_transactions_daily({"transactions": t, "accounts": k.silver["accounts"]}, k.as_of, k.run_ts)
    tables.write_append(rows.where(~late), store, month)
    tables.write_full_refresh(build(k.spark.read.parquet(store)), path, fact_month)
    tables.write_append(rows.where(late), store, month)
    history.incremental_load(k.spark.read.parquet(store), path, build, k.run_ts - dt.timedelta(days=1), month, fact_month)
    shape = build(rows)
    return k.spark.read.schema(shape.schema).parquet(path).select(*shape.columns)
