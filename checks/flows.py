"""Streams drained to their end, feature tables and models."""

from __future__ import annotations

from coinloft.learning import features, models
from coinloft.session import work_folder
from coinloft.streaming import jobs

from .base import AS_OF, cents, half_up
from .core import check


FILE_ROWS = 500_000  # of a landed file; a delivery comes as several files beyond that
DEALT_ROWS = 2_000_000  # up to so many, a table may be a single scan task and is dealt into files by a shuffle


def _landing(k, name, copies=1, files=1, file_rows=FILE_ROWS):
    """(path, schema, parts): the stage table in a landing folder, delivered ``copies`` times; rows are dealt out regardless of date.

    A delivery is ``files`` times ``parts`` files, so a file, and the task that writes it, holds about ``file_rows`` rows at most
    however large the table is; a stream that takes ``parts`` files at a time has as many batches as with single files.
    Beyond ``DEALT_ROWS`` the scan's tasks write their own rows as files of that size, and no row is shuffled.
    """
    path = work_folder(k.spark, "landing")
    rows = k.stage[name]
    count = rows.count()
    parts = max(1, -(-count // (files * file_rows)))
    dealt = count <= DEALT_ROWS
    for _ in range(copies):
        if dealt:
            rows.repartition(files * parts).write.mode("append").parquet(path)
        else:
            rows.write.mode("append").option("maxRecordsPerFile", file_rows).parquet(path)
    if not dealt:
        landed = len(k.spark.read.schema(rows.schema).parquet(path).inputFiles())
        parts = max(1, -(-landed // (files * copies)))
    return path, rows.schema, parts


def _folders(k, *names):
    return [work_folder(k.spark, n) for n in names]


@check("stream_file_ingest", "SELECT *, 'test.transactions' AS source_file, year(transaction_date) AS transaction_year, month(transaction_date) AS transaction_month FROM raw_transactions")
def _(k):
    path, schema, parts = _landing(k, "transactions", files=4)
    out, checkpoint = _folders(k, "bronze", "checkpoint")
    jobs.stream_file_ingest(jobs.file_stream(k.spark, path, schema, max_files=2 * parts), "transactions", k.run_ts, out, checkpoint)
    return k.spark.read.parquet(out)


@check("stream_clean_dedup", "SELECT * FROM sv_transactions")
def _(k):
    path, schema, parts = _landing(k, "transactions", copies=2, files=2)
    out, checkpoint = _folders(k, "silver", "checkpoint")
    stream, again = jobs.file_stream(k.spark, path, schema, max_files=parts), lambda paths: k.spark.read.schema(schema).parquet(*paths)
    jobs.stream_clean_dedup(stream, k.as_of, k.run_ts, out, checkpoint, files=again)
    return jobs.landed(k.spark, out)


@check("stream_daily_fact", """
    SELECT transaction_date_only AS transaction_date, transaction_type_normalized AS transaction_type, status_normalized AS status,
           count(*) AS transaction_count, sum(amount) AS total_amount
    FROM sv_transactions GROUP BY ALL""")
def _(k):
    path, schema, parts = _landing(k, "transactions", files=4)
    silver, out, checkpoint = _folders(k, "silver", "daily", "checkpoint")
    jobs.stream_daily_fact(jobs.file_stream(k.spark, path, schema, max_files=parts), k.as_of, k.run_ts, silver, out, checkpoint)
    return k.spark.read.parquet(out).drop("year", "month")


@check("stream_upsert_gold", "SELECT * FROM gd_fact_transactions_daily")
def _(k):
    path, schema, parts = _landing(k, "transactions", files=2)
    silver, gold, checkpoint = _folders(k, "silver", "gold", "checkpoint")
    stream = jobs.file_stream(k.spark, path, schema, max_files=parts)
    jobs.stream_upsert_gold(stream, k.silver["accounts"], k.as_of, k.run_ts, silver, gold, checkpoint)
    return k.spark.read.schema(k.gold["fact_transactions_daily"].schema).parquet(gold)


check("fraud_features", f"""
    SELECT transaction_id, transaction_uuid, amount, transaction_hour, CAST(dayofweek(transaction_date_only) IN (0, 6) AS INT) AS is_weekend,
           CAST(is_suspicious AS INT) AS label, age, credit_score, annual_income, risk_category, account_type_normalized,
           transaction_type_normalized, category_normalized,
           {half_up(cents('amount') + ' * 100', cents('annual_income'), 4)} AS amount_to_income_ratio,
           IF(risk_category = 'HIGH', 1, 0) AS is_high_risk_client, IF(credit_score < 650, 1, 0) AS is_low_credit_score
    FROM sv_transactions t JOIN sv_accounts a ON a.account_id = t.from_account_id JOIN sv_clients c ON c.client_id = a.client_id
    WHERE t.status_normalized = 'COMPLETED'""")(lambda k: features.fraud_features(k.silver))
check("credit_risk_features", f"""
    SELECT loan_id, client_id, age, credit_score, annual_income, employment_status, loan_amount, l.interest_rate, loan_to_value_ratio,
           outstanding_balance, IF(contains(delinquency_status, 'DELINQUENT'), 1, 0) AS is_delinquent,
           {half_up(cents('loan_amount'), cents('annual_income'), 4)} AS debt_to_income_ratio,
           {half_up(cents('annual_income'), 'CAST(age AS BIGINT) * 100')} AS income_to_age_ratio,
           {half_up(cents('outstanding_balance') + ' * 100', cents('loan_amount'))} AS outstanding_pct
    FROM sv_loans l JOIN sv_contracts USING (contract_id) JOIN sv_clients USING (client_id)""")(
    lambda k: features.credit_risk_features(k.silver))
check("churn_features", f"""
    WITH f AS (SELECT c.client_id, c.age, c.credit_score, c.annual_income, {AS_OF} - c.registration_date AS customer_tenure_days,
                      count(DISTINCT a.account_id) AS num_accounts, count(DISTINCT cp.product_id) AS num_products,
                      ifnull(sum(ab.current_balance), 0) AS total_balance, count(t.transaction_id) AS transaction_count_90d,
                      ifnull({AS_OF} - CAST(max(t.transaction_date) AS DATE), 999) AS days_since_last_transaction
               FROM sv_clients c LEFT JOIN sv_accounts a ON a.client_id = c.client_id
               LEFT JOIN sv_client_products cp ON cp.client_id = c.client_id
               LEFT JOIN sv_account_balances ab ON ab.account_id = a.account_id
               LEFT JOIN sv_transactions t ON t.from_account_id = a.account_id AND t.transaction_date >= {AS_OF} - 90
               GROUP BY ALL)
    SELECT *, IF(days_since_last_transaction > 90 AND total_balance < 100, 1, 0) AS is_churned FROM f""")(
    lambda k: features.churn_features(k.silver, k.as_of))

check("fraud_model")(lambda k: models.fraud_model(features.fraud_features(k.silver))[1])
check("tune_grid_cv")(lambda k: models.tune_grid_cv(features.fraud_features(k.silver)))
check("credit_risk_model")(lambda k: models.credit_risk_model(features.credit_risk_features(k.silver))[0])
check("churn_model")(lambda k: models.churn_model(features.churn_features(k.silver, k.as_of))[0])
check("doc_classify")(lambda k: models.doc_classify(k.raw("documents"), k.raw("labels"))[0])
