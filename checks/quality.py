"""Data quality, profiling and reconciliation."""

from __future__ import annotations

from pyspark.sql import functions as F

from coinloft import rules
from coinloft.operators import dedup, profile, quality, tables
from coinloft.plans.load_checks import gold_checks, quality_specs

from .base import AS_OF, ISSUE_TEXT, SCORE, cents, half_up, mean
from .core import check


def mean3(x: str, places: int = 3) -> str:
    return half_up(f"sum({cents(x)})", f"(count({x}) * 100)", places)


def broken(field, rule, arg):
    return {
        "required": f"{field} IS NULL",
        "regex": f"NOT regexp_matches({field}, '{arg}')",
        "range": f"{field} NOT BETWEEN {arg[0]} AND {arg[1]}" if rule == "range" else "",
        "min": f"{field} < {arg}",
        "not_negative": f"{field} < 0",
        "not_zero": f"{field} = 0",
        "in_list": f"{field} NOT IN ({', '.join(repr(v) for v in arg)})" if rule == "in_list" else "",
    }[rule]


def violations(view, key, rule_set):
    return " UNION ALL ".join(
        f"SELECT {key}, '{f}' AS field, '{rule}' AS rule, '{sev}' AS severity, '{rules.RULES_VERSION}' AS rules_version"
        f" FROM {view} WHERE {broken(f, rule, arg)}"
        for f, rule, arg, sev in rule_set
    )


check("dq_score", f"SELECT client_id, ({SCORE}) / 100 AS dq_score FROM raw_clients")(
    lambda k: k.stage["clients"].select("client_id", quality.dq_score(rules.CLIENT_WEIGHTS).alias("dq_score")))
SLOTS = " || '; ' || ".join(
    f"CASE WHEN {t} THEN '{n}' ELSE '' END" for n, t in (
        ("missing_email", "email IS NULL"), ("invalid_email_format", "strpos(email, '@') = 0"), ("missing_phone", "phone IS NULL")))


def _slots(k):
    every = quality.client_issues()
    few = {n: every[n] for n in ("missing_email", "invalid_email_format", "missing_phone")}
    return k.stage["clients"].select(
        "client_id", quality.dq_issues(every).alias("issues"), quality.dq_issues(few, keep_empty=True).alias("slots"))


check("dq_issues", f"SELECT client_id, {ISSUE_TEXT} AS issues, {SLOTS} AS slots FROM raw_clients")(_slots)
check("dq_rules_eval_clients", violations("raw_clients", "client_id", rules.CLIENT_RULES))(
    lambda k: quality.dq_rules_eval(k.stage["clients"], "client_id", rules.CLIENT_RULES))
check("dq_rules_eval", violations("raw_transactions", "transaction_uuid", rules.TRANSACTION_RULES))(
    lambda k: quality.dq_rules_eval(k.stage["transactions"], "transaction_uuid", rules.TRANSACTION_RULES))
CRITICAL = {
    "transaction_id": "transaction_id IS NULL", "from_account_id": "from_account_id IS NULL", "amount": "amount IS NULL",
    "transaction_date": "transaction_date IS NULL"}
REASONS = "concat_ws('; ', " + ", ".join(f"IF({t}, '{f}:required', NULL)" for f, t in CRITICAL.items()) + ")"


def _split(k):
    good, bad = quality.dq_split_quarantine(k.stage["transactions"], rules.TRANSACTION_RULES)
    return good.select("transaction_uuid", F.lit("").alias("quarantine_reason")).unionByName(
        bad.select("transaction_uuid", "quarantine_reason"))


check("dq_split_quarantine", f"SELECT transaction_uuid, {REASONS} AS quarantine_reason FROM raw_transactions")(_split)
FIELDS = list(rules.CLIENT_WEIGHTS)
check("dq_threshold_gate", f"""
    SELECT *, CASE WHEN score_ok AND null_ok AND duplicate_ok AND rows_ok THEN 'PASS' ELSE 'FAIL' END AS gate_status
    FROM (SELECT *, avg_score >= 0.85 AS score_ok, null_rate <= 0.10 AS null_ok, duplicate_rate <= 0.02 AS duplicate_ok,
                 row_count >= 1000 AS rows_ok
          FROM (SELECT 'clients' AS table_name, count(*) AS row_count, {mean3('dq_score')} AS avg_score,
                       {half_up(' + '.join(f'(count(*) - count({f}))' for f in FIELDS), f'count(*) * {len(FIELDS)}', 4)} AS null_rate,
                       {half_up('count(client_id) - count(DISTINCT client_id)', 'count(*)', 4)} AS duplicate_rate FROM sv_clients))""")(
    lambda k: quality.dq_threshold_gate(k.silver["clients"], "clients", "client_id", "dq_score", FIELDS))
check("dq_summary", f"""
    SELECT count(*) AS total_records, {mean3('dq_score')} AS avg_dq_score, min(dq_score) AS min_dq_score,
           max(dq_score) AS max_dq_score, count(*) FILTER (dq_score >= 0.9) AS excellent_quality,
           count(*) FILTER (dq_score >= 0.8 AND dq_score < 0.9) AS good_quality,
           count(*) FILTER (dq_score < 0.8) AS poor_quality FROM sv_clients""")(lambda k: quality.dq_summary(k.silver["clients"]))
check("dq_buckets", f"""
    SELECT CASE WHEN dq_score >= 0.9 THEN 'Excellent (0.9-1.0)' WHEN dq_score >= 0.8 THEN 'Good (0.8-0.9)'
                WHEN dq_score >= 0.7 THEN 'Fair (0.7-0.8)' ELSE 'Poor (<0.7)' END AS quality_category,
           count(*) AS client_count, {mean3('dq_score')} AS avg_score FROM sv_clients GROUP BY ALL""")(
    lambda k: quality.dq_buckets(k.silver["clients"]))
check("dq_issue_frequency", f"""
    SELECT dq_issues, count(*) AS issue_count, {mean3('dq_score')} AS avg_dq_score, min(dq_score) AS min_dq_score
    FROM sv_clients WHERE dq_score < 1 GROUP BY ALL""")(lambda k: quality.dq_issue_frequency(k.silver["clients"]))
check("dq_issue_explode", """
    SELECT issue, count(*) AS record_count FROM (SELECT unnest(string_split(dq_issues, '; ')) AS issue FROM sv_clients WHERE dq_issues <> '')
    GROUP BY ALL""")(lambda k: quality.dq_issue_explode(k.silver["clients"]))
check("worst_quality", """
    SELECT client_id, full_name, dq_score, dq_issues FROM sv_clients WHERE dq_score < 0.8 ORDER BY dq_score, client_id LIMIT 10""")(
    lambda k: quality.worst_quality(k.silver["clients"].select("client_id", "full_name", "dq_score", "dq_issues"), "client_id"))
check("worst_quality_all", "SELECT client_id, full_name, dq_score, dq_issues FROM sv_clients WHERE dq_score < 0.8")(
    lambda k: quality.worst_quality(k.silver["clients"].select("client_id", "full_name", "dq_score", "dq_issues"), "client_id", k=None))


def _profile_sql(c, t):
    return f"""
    SELECT 'clients' AS table_name, count(*) AS total_records, count(DISTINCT client_id) AS unique_ids,
           count(*) - count(DISTINCT client_id) AS duplicate_count,
           count(*) FILTER (email IS NULL OR email = '') AS check_1, count(*) FILTER (phone IS NULL OR phone = '') AS check_2,
           count(*) FILTER (credit_score NOT BETWEEN 300 AND 850) AS check_3, {mean('credit_score')} AS average,
           round(stddev(CAST(credit_score AS DOUBLE)), 2) AS deviation FROM {c}
    UNION ALL
    SELECT 'transactions', count(*), count(DISTINCT transaction_id), count(*) - count(DISTINCT transaction_id),
           count(*) FILTER (amount IS NULL OR amount <= 0), count(*) FILTER (transaction_date IS NULL),
           count(*) FILTER (status NOT IN ('COMPLETED', 'PENDING', 'FAILED', 'CANCELLED')), {mean('amount')},
           round(stddev(CAST(amount AS DOUBLE)), 2) FROM {t}"""


def _profile(frames):
    return profile.profile_table(
        {"clients": (frames["clients"], "client_id", profile.client_defects(), "credit_score"),
         "transactions": (frames["transactions"], "transaction_id", profile.transaction_defects(), "amount")},
        ["check_1", "check_2", "check_3"])


check("aq_quality_check", f"SELECT * EXCLUDE (duplicate_count, deviation) FROM ({_profile_sql('raw_clients', 'raw_transactions')})")(
    lambda k: _profile(k.stage).drop("duplicate_count", "deviation"))
check("profile_table", _profile_sql("sv_clients", "sv_transactions"))(lambda k: _profile(k.silver))
check("profile_layers", " UNION ALL ".join(f"""
    SELECT '{layer}' AS layer, 'clients' AS table_name, count(*) AS total_records, count(DISTINCT client_id) AS unique_keys,
           count(*) FILTER (client_id IS NULL) AS null_keys, count(*) FILTER (email IS NULL) AS null_email,
           count(*) FILTER (phone IS NULL) AS null_phone FROM {v}""" for layer, v in (("bronze", "raw_clients"), ("silver", "sv_clients"))))(
    lambda k: profile.profile_layers({"bronze": k.bronze["clients"], "silver": k.silver["clients"]}, "clients", "client_id", ["email", "phone"]))

NUMERIC, TEXT = ["credit_score", "annual_income"], ["email", "phone", "city", "risk_category"]
FORMATS = {"email": rules.EMAIL_PATTERN, "phone": rules.PHONE_PATTERN}


def _column_sql(c):
    x = f"CAST({c} AS DOUBLE)" if c in NUMERIC else "CAST(NULL AS DOUBLE)"
    text = "NULL" if c in NUMERIC else c
    bad = f"count(*) FILTER (NOT regexp_matches({c}, '{FORMATS[c]}'))" if c in FORMATS else "0"
    avg = mean(c) if c in NUMERIC else "NULL"
    return f"""SELECT '{c}' AS column_name, count(*) AS row_count, count(*) - count({c}) AS null_count, count(DISTINCT {c}) AS distinct_count,
        {bad} AS format_mismatches, min({text}) AS min_text, max({text}) AS max_text, min({x}) AS min_number, max({x}) AS max_number,
        {avg} AS mean, round(stddev({x}), 2) AS deviation, quantile_cont({x}, 0.25) AS q1, quantile_cont({x}, 0.5) AS median,
        quantile_cont({x}, 0.75) AS q3 FROM raw_clients"""


check("profile_columns", " UNION ALL ".join(_column_sql(c) for c in NUMERIC + TEXT))(
    lambda k: profile.profile_columns(k.stage["clients"], NUMERIC, TEXT, FORMATS))
check("profile_text", f"""
    SELECT sum(n) AS total_records, sum(n) FILTER (trim(text, ' ') = '') AS empty_records, min(length(text)) AS min_length,
           max(length(text)) AS max_length, {half_up('sum(length(text) * n)', 'sum(n)')} AS avg_length, count(*) AS distinct_texts,
           sum(n - 1) AS duplicate_records, max(n) AS largest_group
    FROM (SELECT ifnull(text, '') AS text, count(*) AS n FROM documents GROUP BY ALL)""".replace(
    "sum(n) FILTER (trim(text, ' ') = '')", "ifnull(sum(n) FILTER (trim(text, ' ') = ''), 0)"))(
    lambda k: profile.profile_text(k.raw("documents"), "doc_id", "text"))
check("duplicate_keys", "SELECT transaction_id, count(*) AS row_count FROM raw_transactions GROUP BY ALL HAVING count(*) > 1")(
    lambda k: dedup.duplicate_keys(k.stage["transactions"], ["transaction_id"]))
check("temporal_checks", f"""
    SELECT account_id, 'future_open' AS check_name FROM raw_accounts WHERE open_date > {AS_OF}
    UNION ALL SELECT account_id, 'close_before_open' FROM raw_accounts WHERE close_date < open_date
    UNION ALL SELECT account_id, 'very_old' FROM raw_accounts WHERE open_date < {AS_OF} - 2000""")(
    lambda k: quality.temporal_checks(k.stage["accounts"], "account_id", {
        "future_open": F.col("open_date") > F.lit(k.as_of), "close_before_open": F.col("close_date") < F.col("open_date"),
        "very_old": F.col("open_date") < F.date_sub(F.lit(k.as_of), 2000)}))
check("freshness", f"""
    SELECT 'bronze' AS layer, count(*) AS row_count, '2001-11-05 06:00:00' AS newest FROM raw_transactions
    UNION ALL SELECT 'silver', count(*), '2001-11-05 06:00:00' FROM sv_transactions
    UNION ALL SELECT 'gold', count(*), '2001-11-05 06:00:00' FROM gd_fact_transactions_daily""")(
    lambda k: tables.freshness({
        "bronze": (k.bronze["transactions"], "load_timestamp"), "silver": (k.silver["transactions"], "process_timestamp"),
        "gold": (k.gold["fact_transactions_daily"], "created_timestamp")}))
ENTITIES = {"clients": ("clients", "dim_client"), "transactions": ("transactions", "fact_transactions_daily"),
            "accounts": ("accounts", "fact_account_balance_daily")}
check("layer_reconcile", " UNION ALL ".join(f"""
    SELECT '{e}' AS entity, (SELECT count(*) FROM raw_{t}) AS stage_count, (SELECT count(*) FROM raw_{t}) AS bronze_count,
           (SELECT count(*) FROM sv_{t}) AS silver_count, (SELECT count(*) FROM gd_{g}) AS gold_count,
           IF((SELECT count(*) FROM sv_{t}) <= (SELECT count(*) FROM raw_{t}), 'PASS', 'WARNING: Check data flow') AS validation_status"""
    for e, (t, g) in ENTITIES.items()))(
    lambda k: tables.layer_reconcile({
        e: (k.stage[t], k.bronze[t], k.silver[t], k.gold[g]) for e, (t, g) in ENTITIES.items()}))
check("source_preflight", " UNION ALL ".join(f"""
    SELECT 'test.{t}' AS table_name, count(*) AS record_count, IF(count(*) > 0, 'OK', 'ERROR: No data') AS status FROM raw_{t}"""
    for t in ("clients", "products", "transactions", "accounts")))(
    lambda k: tables.source_preflight({f"test.{t}": k.stage[t] for t in ("clients", "products", "transactions", "accounts")}))

DASH = {
    "clients": ("client_id", ["client_id", "first_name", "last_name", "email"], "NOT contains(email, '@') OR credit_score NOT BETWEEN 300 AND 850"),
    "transactions": ("transaction_id", ["transaction_id", "from_account_id", "amount", "transaction_date"], "amount = 0 OR status_normalized = 'UNKNOWN'"),
    "accounts": ("account_id", ["account_id", "client_id", "branch_code"], "close_date < open_date OR status_normalized = 'UNKNOWN'"),
    "loans": ("loan_id", ["loan_id", "contract_id", "delinquency_status"], "loan_to_value_ratio > 1"),
    "products": ("product_id", ["product_id", "product_name", "product_type"], "length(currency) <> 3"),
    "contracts": ("contract_id", ["contract_id", "client_id", "product_id"], "end_date < start_date OR status_normalized = 'UNKNOWN'"),
    "client_products": ("relationship_id", ["relationship_id", "client_id", "product_id"], "end_date < start_date"),
    "account_balances": ("balance_id", ["balance_id", "account_id", "current_balance"], "credit_limit < 0"),
    "cards": ("card_id", ["card_id", "client_id", "account_id"], "expiry_date < issue_date OR status_normalized = 'UNKNOWN'"),
    "branches": ("branch_id", ["branch_id", "branch_code", "branch_name"], "NOT starts_with(branch_code, 'BR')"),
    "employees": ("employee_id", ["employee_id", "branch_id", "hire_date"], "salary <= 0"),
    "credit_applications": ("application_id", ["application_id", "client_id", "requested_amount"], "requested_amount <= 0 OR status_normalized = 'UNKNOWN'"),
}


def _dash_sql(table, key, critical, invalid):
    whole = " AND ".join(f"{c} IS NOT NULL" for c in critical)
    points = half_up("complete * 50 + (total - dup) * 30 + (total - bad) * 20", "total")
    return f"""SELECT {AS_OF} AS report_date, '{table}' AS table_name, 'silver' AS database_name, total AS total_records, total AS new_records_today,
        NULL AS updated_records_today, NULL AS deleted_records_today, complete AS complete_records, total - complete AS incomplete_records,
        {half_up('complete * 100', 'total')} AS completeness_rate, dup AS duplicate_records, {half_up('dup * 100', 'total')} AS duplicate_rate,
        nulls AS null_critical_fields, bad AS invalid_format_records, {points} AS data_quality_score,
        CASE WHEN {points} >= 90 THEN 'A' WHEN {points} >= 80 THEN 'B' WHEN {points} >= 70 THEN 'C' WHEN {points} >= 60 THEN 'D' ELSE 'F' END AS data_quality_grade,
        total - complete AS critical_issues, dup AS major_issues, bad AS minor_issues,
        format('{{{{"incomplete_records":{{}},"duplicate_records":{{}},"invalid_format_records":{{}}}}}}', total - complete, dup, bad) AS issue_details,
        2001 AS year, 11 AS month
    FROM (SELECT count(*) AS total, count(*) FILTER ({whole}) AS complete, count({key}) - count(DISTINCT {key}) AS dup,
                 {' + '.join(f'(count(*) - count({c}))' for c in critical)} AS nulls, count(*) FILTER ({invalid}) AS bad FROM sv_{table})"""


def _dash(k):
    return profile.data_quality_dashboard(quality_specs(k.silver), k.as_of, k.run_ts)


check("data_quality_dashboard", " UNION ALL ".join(_dash_sql(t, *spec) for t, spec in DASH.items()))(_dash)

FIGURES = {
    "dim_client": {"total_clients": "count(*)", "segments": "count(DISTINCT client_segment)", "avg_income": mean("annual_income")},
    "dim_product": {"total_products": "count(*)"},
    "dim_branch": {"total_branches": "count(*)"},
    "dim_date": {"total_dates": "count(*)", "first_key": "min(date_key)", "last_key": "max(date_key)"},
    "fact_transactions_daily": {"daily_aggregates": "count(*)", "total_transactions": "sum(transaction_count)", "total_volume": "sum(total_amount)"},
    "fact_account_balance_daily": {"total_balance_records": "count(*)", "unique_accounts": "count(DISTINCT account_id)", "total_system_balance": "sum(current_balance)"},
    "fact_loan_performance": {"total_loans": "count(*)", "delinquent_loans": "count(*) FILTER (is_delinquent)", "total_loan_amount": "sum(loan_amount)", "total_outstanding": "sum(outstanding_balance)"},
    "client_360_view": {"total_clients": "count(*)", "segments": "count(DISTINCT client_segment)", "total_accounts": "sum(total_accounts)", "total_balance": "sum(total_balance)"},
    "product_performance_summary": {"total_products": "count(*)", "total_product_clients": "sum(total_clients)", "total_contract_value": "sum(total_contract_value)"},
    "branch_performance_dashboard": {"total_branches": "count(*)", "avg_accounts_per_branch": half_up("sum(total_accounts)", "count(*)", 0), "total_system_deposits": "sum(total_deposits)"},
}
check("gold_checks", " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, '{n}' AS metric, CAST({e} AS DOUBLE) AS value FROM gd_{t}" for t, f in FIGURES.items() for n, e in f.items()))(
    lambda k: gold_checks(k.gold))
