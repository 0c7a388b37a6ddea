"""Single operators: sources, sinks, cleaning rules, windows, joins, aggregates."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from coinloft import rules
from coinloft.functions import calendar, clean
from coinloft.operators import aggs, dedup, durations, joins, ledger, tables
from coinloft.plans import gold
from coinloft.schemas import DDL
from coinloft.session import work_folder
from coinloft.sources import banking, readers

from .base import AS_OF, SINCE, band, cents, code_of, half_up, likes, mean, region_of
from .core import VIEWS, check

S = banking.STAGE_TABLES


def cols(df, key, **columns):
    return df.select(key, *[c.alias(n) for n, c in columns.items()])


# --- sources and sinks: written to the shared folder, read back ----------------------

CLIENT_DDL = DDL["clients"]


def _written(k, df, fmt, purpose, **options):
    path = work_folder(k.spark, purpose)
    df.write.options(**options).format(fmt).save(path)
    return path


@check("read_csv_typed", "SELECT * FROM raw_clients")
def _(k):
    path = _written(k, k.stage["clients"], "csv", "csv", header="true", escape="\\", ignoreLeadingWhiteSpace="false", ignoreTrailingWhiteSpace="false")
    return readers.read_csv_typed(k.spark, path, CLIENT_DDL).drop(readers.CORRUPT)


@check("validate_records", """
    SELECT 'good' AS kind, count(email) AS records FROM raw_clients
    UNION ALL SELECT 'reject', count(*) - count(email) FROM raw_clients""")
def _(k):
    # clients without an e-mail are written with a key that is no number
    broken = k.stage["clients"].withColumn(
        "client_id", F.when(F.col("email").isNull(), F.concat(F.lit("x"), "client_id")).otherwise(F.col("client_id").cast("string"))
    )
    path = _written(k, broken, "csv", "csv-broken", header="true")
    good, rejects = readers.validate_records(k.spark, path, CLIENT_DDL)
    count = lambda name, df: df.agg(F.count("client_id" if name == "good" else readers.CORRUPT).alias("records")).select(F.lit(name).alias("kind"), "records")
    return count("good", good).unionByName(count("reject", rejects))


@check("read_table", "SELECT * FROM customer")
def _(k):
    """A layer table, read by path."""
    root = work_folder(k.spark, "layers")
    tables.write_full_refresh(k.raw("customer"), f"{root}/bronze/customer")
    return readers.read_table(k.spark, root, "bronze", "customer")


@check("read_any_format", "SELECT fmt, p.* FROM (VALUES ('parquet'), ('json'), ('csv'), ('orc')) v(fmt), raw_products p")
def _(k):
    source = k.stage["products"]
    out = []
    for fmt in ("parquet", "json", "csv", "orc"):
        options = {"header": "true", "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"} if fmt == "csv" else {}
        path = _written(k, source, fmt, fmt, **options)
        out.append(readers.read_any_format(k.spark, path, fmt, DDL["products"]).select(F.lit(fmt).alias("fmt"), "*"))
    return reduce(lambda a, b: a.unionByName(b), out)


@check("format_compare", """
    SELECT fmt AS format, (SELECT count(*) FROM raw_clients) AS row_count FROM (VALUES ('parquet'), ('json'), ('csv')) v(fmt)""")
def _(k):
    frames = {}
    for fmt in ("parquet", "json", "csv"):
        path = _written(k, k.stage["clients"], fmt, fmt, **({"header": "true"} if fmt == "csv" else {}))
        frames[fmt] = readers.read_any_format(k.spark, path, fmt, CLIENT_DDL)
    return readers.format_compare(frames)


MONTH = ["transaction_year", "transaction_month"]


def _stored_silver(k, purpose):
    path = work_folder(k.spark, purpose)
    tables.write_full_refresh(k.silver["transactions"], path, MONTH)
    return path, k.spark.read.parquet(path)


@check("partitioned_read", """
    SELECT transaction_id, transaction_uuid, amount, transaction_year, transaction_month FROM sv_transactions
    WHERE transaction_year = 2001 AND transaction_month = 10""")
def _(k):
    _, stored = _stored_silver(k, "by-month")
    part = readers.partitioned_read(stored, {"transaction_year": 2001, "transaction_month": 10})
    return part.select("transaction_id", "transaction_uuid", "amount", *MONTH)


@check("write_append", "SELECT * FROM raw_products UNION ALL SELECT * FROM raw_products")
def _(k):
    path = work_folder(k.spark, "append")
    for _ in range(2):
        tables.write_append(k.stage["products"], path)
    return k.spark.read.parquet(path)


@check("write_full_refresh", "SELECT * FROM raw_products")
def _(k):
    path = work_folder(k.spark, "refresh")
    for _ in range(2):
        tables.write_full_refresh(k.stage["products"], path)
    return k.spark.read.parquet(path)


@check("write_partition_overwrite", """
    SELECT transaction_id, transaction_uuid, CASE WHEN transaction_year = 2001 THEN amount * 2 ELSE amount END AS amount,
           transaction_year, transaction_month FROM sv_transactions""")
def _(k):
    columns = ["transaction_id", "transaction_uuid", "amount", *MONTH]
    base = k.silver["transactions"].select(*columns)
    path = work_folder(k.spark, "overwrite")
    tables.write_full_refresh(base, path, MONTH)
    changed = base.where(F.col("transaction_year") == 2001).withColumn("amount", (F.col("amount") * 2).cast("decimal(12,2)"))
    tables.write_partition_overwrite(changed, path, MONTH)
    return k.spark.read.parquet(path).select(*columns)


@check("write_orc_copy", "SELECT * FROM raw_branches")
def _(k):
    path = work_folder(k.spark, "orc")
    tables.write_orc_copy(k.stage["branches"], path)
    return k.spark.read.orc(path)


@check("write_bucketed", """
    SELECT client_id, city, count(account_id) AS accounts FROM raw_clients LEFT JOIN raw_accounts USING (client_id) GROUP BY ALL""")
def _(k):
    frames = []
    for name in ("clients", "accounts"):
        path = work_folder(k.spark, f"bucketed-{name}")
        table = "coinloft_" + path.rsplit("-", 1)[1]
        tables.write_bucketed(k.stage[name], table, "client_id", 32, path)
        frames.append(k.spark.table(table))
    clients, accounts = frames
    return clients.join(accounts, "client_id", "left").groupBy("client_id", "city").agg(F.count("account_id").alias("accounts"))


@check("export_csv", "SELECT query_id, username, table_name FROM raw_audit_log")
def _(k):
    path = work_folder(k.spark, "export")
    rows = k.stage["audit_log"].select("query_id", "username", "table_name")
    tables.export_csv(rows, path, ["query_id"])
    return k.spark.read.schema(rows.schema).option("header", True).csv(path)


@check("compact_partitions", "SELECT transaction_id, transaction_uuid, amount, transaction_year, transaction_month FROM sv_transactions")
def _(k):
    _, stored = _stored_silver(k, "loose")
    path = work_folder(k.spark, "compact")
    tables.compact_partitions(stored, path, MONTH)
    return k.spark.read.parquet(path).select("transaction_id", "transaction_uuid", "amount", *MONTH)


STAT_COLUMNS = ["account_id", "client_id", "account_type", "open_date", "close_date", "status"]
check("collect_statistics", " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, count(*) AS row_count, count(*) - count({c}) AS null_count,"
    f" count(DISTINCT {c}) AS distinct_count, CAST(min({c}) AS VARCHAR) AS min_value, CAST(max({c}) AS VARCHAR) AS max_value"
    " FROM raw_accounts" for c in STAT_COLUMNS
))(lambda k: tables.collect_statistics(k.stage["accounts"].select(*STAT_COLUMNS), exact=True))

check("list_partitions", "SELECT DISTINCT year(transaction_date) AS transaction_year, month(transaction_date) AS transaction_month FROM raw_transactions")(
    lambda k: tables.list_partitions(k.bronze["transactions"], MONTH))
check("partition_counts", "SELECT year(transaction_date) AS transaction_year, month(transaction_date) AS transaction_month, count(*) AS row_count FROM raw_transactions GROUP BY ALL")(
    lambda k: tables.partition_counts(k.bronze["transactions"], MONTH))
check("retention_plan", f"""
    SELECT transaction_year, transaction_month, count(*) AS row_count FROM sv_transactions
    WHERE make_date(transaction_year, transaction_month, 1) < {AS_OF} - 24 * 30 GROUP BY ALL""")(
    lambda k: tables.retention_plan(k.silver["transactions"], k.as_of))
check("archive_partitions", f"""
    SELECT transaction_id, transaction_uuid, amount, transaction_year AS archive_year, transaction_month AS archive_month
    FROM sv_transactions WHERE transaction_year < year({AS_OF} - INTERVAL 24 MONTH)""")(
    lambda k: tables.archive_partitions(k.silver["transactions"], k.as_of).select(
        "transaction_id", "transaction_uuid", "amount", "archive_year", "archive_month"))
for _layer, _view in (("silver", "sv_transactions"), ("bronze", "(SELECT *, year(transaction_date) AS transaction_year FROM raw_transactions)")):
    check("purge_partitions" if _layer == "silver" else "purge_partitions_bronze", f"""
        SELECT transaction_id, transaction_uuid, transaction_year FROM {_view}
        WHERE transaction_year >= year({AS_OF} - INTERVAL 24 MONTH)""")(
        lambda k, layer=_layer: tables.purge_partitions(getattr(k, layer)["transactions"], k.as_of).select(
            "transaction_id", F.col("transaction_uuid"), "transaction_year"))
check("layer_stamp", "SELECT client_id, 'test.clients' AS source_file, '2001-11-05 06:00:00' AS stamped FROM raw_clients")(
    lambda k: k.bronze["clients"].select("client_id", "source_file", F.col("load_timestamp").cast("string").alias("stamped")))

# --- cleaning -----------------------------------------------------------------------

check("trim_upper_lower", """
    SELECT client_id, trim(first_name) AS first_name, upper(trim(country)) AS country, lower(trim(email)) AS email FROM raw_clients""")(
    lambda k: cols(k.stage["clients"], "client_id", first_name=clean.tidy("first_name", "trim"),
                   country=clean.tidy("country", "upper"), email=clean.tidy("email", "lower")))
check("full_name", """
    SELECT client_id, trim(first_name) || ' ' || trim(last_name) AS strict_name,
           concat_ws(' ', trim(first_name), trim(last_name)) AS loose_name FROM raw_clients""")(
    lambda k: cols(k.stage["clients"], "client_id", strict_name=clean.full_name("first_name", "last_name"),
                   loose_name=clean.full_name("first_name", "last_name", skip_missing=True)))
check("email_domain", """
    SELECT client_id, CASE WHEN contains(email, '@') THEN substr(lower(email), strpos(email, '@') + 1) END AS first_at,
           regexp_replace(lower(trim(email)), '.*@', '') AS last_at FROM raw_clients""")(
    lambda k: cols(k.stage["clients"], "client_id", first_at=clean.email_domain("email"),
                   last_at=clean.email_domain("email", after_last=True)))
check("phone_normalize", """
    SELECT client_id, regexp_replace(phone, '[^0-9+]', '', 'g') AS digits,
           regexp_replace(regexp_replace(phone, '[^0-9+]', '', 'g'), '^00', '+') AS international FROM raw_clients""")(
    lambda k: cols(k.stage["clients"], "client_id", digits=clean.phone_digits("phone"),
                   international=clean.phone_digits("phone", international=True)))
check("age_years", f"""
    SELECT client_id, ({AS_OF} - birth_date) * 100 // 36525 AS age,
           {half_up(f'({AS_OF} - birth_date) * 100', '36525', 0)} AS nearest FROM raw_clients""")(
    lambda k: cols(k.stage["clients"], "client_id", age=calendar.age_years("birth_date", k.as_of),
                   nearest=calendar.age_years("birth_date", k.as_of, nearest=True).cast("double")))
check("tenure", f"""
    SELECT employee_id, {AS_OF} - hire_date AS days, {half_up(f'({AS_OF} - hire_date) * 100', '36525')} AS years FROM raw_employees""")(
    lambda k: cols(k.stage["employees"], "employee_id", days=calendar.tenure_days("hire_date", k.as_of),
                   years=calendar.tenure_years("hire_date", k.as_of)))
check("open_interval_days", f"SELECT contract_id, ifnull(end_date, {AS_OF}) - start_date AS days FROM raw_contracts")(
    lambda k: cols(k.stage["contracts"], "contract_id", days=calendar.open_days("start_date", "end_date", k.as_of)))
check("days_to_date", f"SELECT loan_id, next_payment_date - {AS_OF} AS days FROM raw_loans")(
    lambda k: cols(k.stage["loans"], "loan_id", days=calendar.days_until("next_payment_date", k.as_of)))
check("months_since", f"SELECT contract_id, ({AS_OF} - start_date) * 100 // 3044 AS months FROM raw_contracts")(
    lambda k: cols(k.stage["contracts"], "contract_id",
                   months=calendar.months_since("start_date", k.as_of)))
check("is_expired", f"SELECT card_id, ifnull(expiry_date < {AS_OF}, FALSE) AS expired FROM raw_cards")(
    lambda k: cols(k.stage["cards"], "card_id", expired=calendar.expired("expiry_date", k.as_of)))
check("is_expiring_soon", f"""
    SELECT card_id, ifnull(expiry_date - {AS_OF} BETWEEN 0 AND 30, FALSE) AS soon FROM raw_cards""")(
    lambda k: cols(k.stage["cards"], "card_id", soon=calendar.expiring_soon("expiry_date", k.as_of)))
check("value_map", f"""
    SELECT transaction_uuid, {code_of('category', rules.TRANSACTION_CATEGORY, 'OTHER')} AS category,
           {code_of('status', rules.LOOSE_TRANSACTION_STATUS, None)} AS loose_status FROM raw_transactions""")(
    lambda k: cols(k.stage["transactions"], "transaction_uuid", category=clean.mapped("category", rules.TRANSACTION_CATEGORY, "OTHER"),
                   loose_status=clean.mapped("status", rules.LOOSE_TRANSACTION_STATUS)))
check("pattern_map", f"""
    SELECT loan_id, {likes('delinquency_status', rules.DELINQUENCY, 'UNKNOWN')} AS delinquency FROM raw_loans""")(
    lambda k: cols(k.stage["loans"], "loan_id", delinquency=clean.pattern_code("delinquency_status", rules.DELINQUENCY, "UNKNOWN")))
check("band", f"""
    SELECT client_id, {band('credit_score', rules.CREDIT_SCORE_BAND, 'UNKNOWN')} AS score_band,
           {band('annual_income', rules.LOOSE_INCOME_BAND)} AS loose_income_band FROM raw_clients""")(
    lambda k: cols(k.stage["clients"], "client_id", score_band=clean.below("credit_score", rules.CREDIT_SCORE_BAND, "UNKNOWN"),
                   loose_income_band=clean.below("annual_income", rules.LOOSE_INCOME_BAND)))
check("state_code", f"SELECT branch_id, {code_of('state', rules.STATE_CODE, None)} AS state_code FROM raw_branches")(
    lambda k: cols(k.stage["branches"], "branch_id", state_code=clean.mapped("state", rules.STATE_CODE)))
check("region_from_country", f"SELECT client_id, {region_of('country', rules.COUNTRY_REGION)} AS region FROM sv_clients")(
    lambda k: cols(k.silver["clients"], "client_id", region=gold._country_region()))
check("region_from_state", f"SELECT branch_id, {region_of('state_code', rules.STATE_REGION)} AS region FROM sv_branches")(
    lambda k: cols(k.silver["branches"], "branch_id", region=gold._state_region()))
check("active_flag", f"""
    SELECT account_id, upper(trim(status)) = 'ACTIVE' AND ifnull(close_date >= {AS_OF}, TRUE) AS active FROM raw_accounts""")(
    lambda k: cols(k.stage["accounts"], "account_id", active=clean.is_true(
        (clean.code("status") == "ACTIVE") & calendar.not_past("close_date", k.as_of))))
check("null_key_filter", """
    SELECT transaction_uuid FROM raw_transactions
    WHERE transaction_id IS NOT NULL AND amount IS NOT NULL AND transaction_date IS NOT NULL""")(
    lambda k: k.stage["transactions"].dropna(subset=["transaction_id", "amount", "transaction_date"]).select("transaction_uuid"))
check("safe_ratio_pct", f"""
    SELECT balance_id, {half_up(cents('available_balance') + ' * 100', cents('current_balance'))} AS pct FROM raw_account_balances""")(
    lambda k: cols(k.stage["account_balances"], "balance_id", pct=clean.percent("available_balance", "current_balance")))
check("difference_col", "SELECT loan_id, loan_amount - outstanding_balance AS paid, term_months - remaining_months AS elapsed FROM raw_loans")(
    lambda k: cols(k.stage["loans"], "loan_id", paid=F.col("loan_amount") - F.col("outstanding_balance"),
                   elapsed=F.col("term_months") - F.col("remaining_months")))
check("amount_sign", """
    SELECT transaction_uuid, CASE sign(amount) WHEN 1 THEN 'CREDIT' WHEN -1 THEN 'DEBIT' ELSE 'NEUTRAL' END AS direction FROM raw_transactions""")(
    lambda k: cols(k.stage["transactions"], "transaction_uuid", direction=clean.amount_sign("amount")))
check("date_parts", """
    SELECT transaction_uuid, CAST(transaction_date AS DATE) AS day, hour(transaction_date) AS hour,
           dayofweek(transaction_date) + 1 AS day_of_week, year(transaction_date) AS year, month(transaction_date) AS month
    FROM raw_transactions""")(
    lambda k: cols(k.stage["transactions"], "transaction_uuid", day=F.to_date("transaction_date"), hour=F.hour("transaction_date"),
                   day_of_week=F.dayofweek("transaction_date"), year=F.year("transaction_date"), month=F.month("transaction_date")))
check("suspicious_flag", """
    SELECT transaction_uuid, ifnull(abs(amount) > 10000, FALSE) OR ifnull(hour(transaction_date) <= 4, FALSE) AS flagged,
           ifnull(amount > 10000, FALSE) OR ifnull(hour(transaction_date) <= 5, FALSE) AS loose_flagged FROM raw_transactions""")(
    lambda k: cols(k.stage["transactions"], "transaction_uuid",
                   flagged=clean.suspicious("amount", F.hour("transaction_date"), rules.SUSPICIOUS_AMOUNT, rules.NIGHT_HOURS),
                   loose_flagged=clean.suspicious("amount", F.hour("transaction_date"), rules.SUSPICIOUS_AMOUNT, (0, 5), signed=True)))
check("internal_transfer_flag", """
    SELECT transaction_uuid, from_account_id IS NOT NULL AND to_account_id IS NOT NULL AS internal FROM raw_transactions""")(
    lambda k: cols(k.stage["transactions"], "transaction_uuid", internal=clean.internal_transfer("from_account_id", "to_account_id")))
check("mask_card", "SELECT card_id, '****-****-****-' || right(card_number, 4) AS masked FROM raw_cards")(
    lambda k: cols(k.stage["cards"], "card_id", masked=clean.mask_card("card_number")))
check("mask_partial", """
    SELECT client_id, left(email, 3) || '***' AS email, left(phone, 3) || '***' AS phone,
           left(CAST(credit_score AS VARCHAR), 3) || '***' AS credit_score FROM raw_clients""")(
    lambda k: cols(k.stage["clients"], "client_id", **{c: clean.mask_partial(c) for c in ("email", "phone", "credit_score")}))
check("extra_durations", f"""
    SELECT l.loan_id, c.end_date - c.start_date AS contract_duration_days, c.end_date - {AS_OF} AS days_until_maturity,
           ({AS_OF} - c.start_date) * 100 // 3044 AS months_since_start,
           {half_up(cents('outstanding_balance') + ' * 100', cents('loan_amount'))} AS outstanding_percentage,
           ifnull(c.status = 'PENDING', FALSE) AS is_pending
    FROM raw_loans l JOIN raw_contracts c USING (contract_id)""")(
    lambda k: durations.loan_durations(k.stage["loans"], k.stage["contracts"], k.as_of))
check("extra_durations_applications", f"""
    SELECT application_id, decision_date - application_date AS days_to_decision,
           {half_up('approved_amount * 100', 'requested_amount')} AS approval_percentage FROM raw_credit_applications""")(
    lambda k: durations.application_durations(k.stage["credit_applications"]))
check("extra_durations_usage", f"""
    SELECT relationship_id, {AS_OF} - start_date AS days_since_last_usage FROM raw_client_products""")(
    lambda k: durations.days_since_use(k.stage["client_products"], "relationship_id", "start_date", k.as_of))
check("extra_durations_transactions", """
    SELECT transaction_uuid, ifnull(status = 'COMPLETED', FALSE) AS is_completed FROM raw_transactions""")(
    lambda k: durations.completion(k.stage["transactions"]))
check("coalesce_defaults", """
    SELECT transaction_uuid, ifnull(amount, 0) AS amount, ifnull(merchant_name, 'UNKNOWN') AS merchant_name,
           ifnull(to_account_id, -1) AS to_account_id FROM raw_transactions""")(
    lambda k: cols(k.stage["transactions"], "transaction_uuid", amount=F.coalesce("amount", F.lit(0)),
                   merchant_name=F.coalesce("merchant_name", F.lit("UNKNOWN")), to_account_id=F.coalesce("to_account_id", F.lit(-1))))

# --- dedup, ranks, windows -------------------------------------------------------------

check("dedup_latest", """
    SELECT * FROM raw_transactions
    QUALIFY row_number() OVER (PARTITION BY transaction_id ORDER BY transaction_date DESC NULLS LAST, transaction_uuid DESC) = 1""")(
    lambda k: dedup.dedup_latest(k.stage["transactions"], ["transaction_id"],
                                 [F.col("transaction_date").desc_nulls_last(), F.col("transaction_uuid").desc()]))
check("rank_branches", "SELECT branch_id, revenue_rank, customer_rank, efficiency_rank FROM gd_branch_performance_dashboard")(
    lambda k: k.gold["branch_performance_dashboard"].select("branch_id", "revenue_rank", "customer_rank", "efficiency_rank"))

VIEWS["ax_daily"] = f"""
    SELECT account_id, day, opening + sum(delta) OVER (PARTITION BY account_id ORDER BY day) AS balance
    FROM (SELECT account_id, CAST(transaction_date AS DATE) AS day, ifnull(sum(delta), 0) AS delta, count(delta) AS known FROM ax_legs
          WHERE transaction_date IS NOT NULL GROUP BY ALL)
    JOIN (SELECT account_id, {banking.OPENING_BALANCE} AS opening FROM raw_accounts) USING (account_id)"""


def _daily(k):
    accounts = k.stage["accounts"].select("account_id", F.expr(banking.OPENING_BALANCE).alias("opening_balance"))
    return ledger.daily_balances(accounts, k.stage["transactions"])


check("balance_change", """
    SELECT account_id, day, balance, balance - (SELECT p.balance FROM ax_daily p WHERE p.account_id = d.account_id AND p.day <= d.day - 1 ORDER BY p.day DESC LIMIT 1) AS daily,
           balance - (SELECT p.balance FROM ax_daily p WHERE p.account_id = d.account_id AND p.day <= d.day - 7 ORDER BY p.day DESC LIMIT 1) AS weekly,
           balance - (SELECT p.balance FROM ax_daily p WHERE p.account_id = d.account_id AND p.day <= d.day - 30 ORDER BY p.day DESC LIMIT 1) AS monthly
    FROM ax_daily d""")(
    lambda k: ledger.balance_change(_daily(k), "account_id", "day", "balance", {"daily": 1, "weekly": 7, "monthly": 30}))
check("ledger_balance", "SELECT account_id, current_balance, last_updated FROM raw_account_balances")(
    lambda k: k.stage["account_balances"].select("account_id", "current_balance", "last_updated"))

# --- joins -----------------------------------------------------------------------------

check("left_join_equi", """
    SELECT transaction_uuid, a.client_id, a.branch_code FROM raw_transactions t LEFT JOIN raw_accounts a ON t.from_account_id = a.account_id""")(
    lambda k: k.stage["transactions"].join(
        k.stage["accounts"].select(F.col("account_id").alias("from_account_id"), "client_id", "branch_code"), "from_account_id", "left"
    ).select("transaction_uuid", "client_id", "branch_code"))
check("inner_join_equi", "SELECT loan_id, client_id, loan_amount FROM raw_loans JOIN raw_contracts USING (contract_id)")(
    lambda k: k.stage["loans"].join(k.stage["contracts"].select("contract_id", "client_id"), "contract_id").select("loan_id", "client_id", "loan_amount"))
check("left_join_preagg", """
    SELECT client_id, (SELECT count(*) FROM raw_accounts a WHERE a.client_id = c.client_id) AS accounts,
           (SELECT count(*) FROM raw_cards k WHERE k.client_id = c.client_id) AS cards FROM raw_clients c""")(
    lambda k: joins.left_join_preagg(k.stage["clients"].select("client_id"), "client_id", [
        (k.stage["accounts"].groupBy("client_id").agg(F.count("*").alias("accounts")), {"accounts": 0}),
        (k.stage["cards"].groupBy("client_id").agg(F.count("*").alias("cards")), {"cards": 0})]))
check("left_join_on_filter", """
    SELECT account_id, transaction_uuid, amount FROM raw_accounts a
    LEFT JOIN raw_transactions t ON t.from_account_id = a.account_id AND t.status = 'COMPLETED'""")(
    lambda k: joins.left_join_on_filter(
        k.stage["accounts"].select("account_id"),
        k.stage["transactions"].withColumnRenamed("from_account_id", "account_id"), "account_id", F.col("status") == "COMPLETED",
    ).select("account_id", "transaction_uuid", "amount"))
check("chain_join", """
    SELECT transaction_uuid, account_id, client_id, city FROM raw_transactions t
    JOIN raw_accounts a ON a.account_id = t.from_account_id JOIN raw_clients USING (client_id)""")(
    lambda k: joins.chain_join(
        k.stage["transactions"].select("transaction_uuid", F.col("from_account_id").alias("account_id")),
        [(k.stage["accounts"].select("account_id", "client_id"), "account_id", "inner"),
         (k.stage["clients"].select("client_id", "city"), "client_id", "inner")]))
for _safe in (False, True):
    check("fanout_join_agg" + ("_safe" if _safe else ""), """
        SELECT risk_category, count(a.account_id) AS acc_rows, sum(a.account_id) AS acc_total, count(k.card_id) AS card_rows,
               sum(k.cvv) AS card_total
        FROM raw_clients c LEFT JOIN raw_accounts a ON a.client_id = c.client_id LEFT JOIN raw_cards k ON k.client_id = c.client_id
        GROUP BY ALL""" if not _safe else """
        SELECT risk_category, sum(an) AS acc_rows, sum(asum) AS acc_total, sum(kn) AS card_rows, sum(ksum) AS card_total
        FROM raw_clients LEFT JOIN (SELECT client_id, count(*) AS an, sum(account_id) AS asum FROM raw_accounts GROUP BY ALL) USING (client_id)
        LEFT JOIN (SELECT client_id, count(*) AS kn, sum(cvv) AS ksum FROM raw_cards GROUP BY ALL) USING (client_id) GROUP BY ALL""")(
        lambda k, safe=_safe: aggs.fanout_join_agg(
            k.stage["clients"].select("client_id", "risk_category"), ["risk_category"],
            {"acc": (k.stage["accounts"], "client_id", "account_id"), "card": (k.stage["cards"], "client_id", "cvv")}, safe))
check("orphan_check", """
    SELECT transaction_uuid, from_account_id FROM raw_transactions t
    WHERE from_account_id IS NOT NULL AND NOT EXISTS (SELECT 1 FROM raw_accounts a WHERE a.account_id = t.from_account_id)""")(
    lambda k: joins.orphan_check(k.stage["transactions"], "from_account_id", k.stage["accounts"], "account_id").select("transaction_uuid", "from_account_id"))

# --- aggregates --------------------------------------------------------------------------

T = "raw_transactions"
check("agg_basic", f"""
    SELECT category, count(*) AS row_count, sum(amount) AS total, {mean('amount')} AS average, min(amount) AS lowest,
           max(amount) AS highest FROM {T} GROUP BY ALL""")(lambda k: aggs.agg_basic(k.stage["transactions"], ["category"], "amount"))
check("agg_conditional", f"""
    SELECT category, count(*) FILTER (status = 'COMPLETED') AS completed, ifnull(sum(amount) FILTER (status = 'COMPLETED'), 0) AS settled
    FROM {T} GROUP BY ALL""")(
    lambda k: aggs.agg_conditional(k.stage["transactions"], ["category"], {
        "completed": (F.col("status") == "COMPLETED", None), "settled": (F.col("status") == "COMPLETED", F.col("amount"))}))
check("agg_distinct", f"""
    SELECT category, count(DISTINCT from_account_id) AS distinct_from_account_id, count(DISTINCT merchant_name) AS distinct_merchant_name
    FROM {T} GROUP BY ALL""")(lambda k: aggs.agg_distinct(k.stage["transactions"], ["category"], ["from_account_id", "merchant_name"]))
check("agg_distinct_conditional", f"""
    SELECT category, count(DISTINCT from_account_id) FILTER (status = 'COMPLETED') AS paying FROM {T} GROUP BY ALL""")(
    lambda k: aggs.agg_distinct_conditional(k.stage["transactions"], ["category"], {"paying": ("from_account_id", F.col("status") == "COMPLETED")}))
check("agg_ratio", f"""
    SELECT currency, {half_up("count(*) FILTER (status = 'COMPLETED') * 100", 'count(*)')} AS completed_pct FROM {T} GROUP BY ALL""")(
    lambda k: aggs.agg_ratio(k.stage["transactions"], ["currency"], "completed_pct", F.count_if(F.col("status") == "COMPLETED"), F.count("*")))
check("agg_by_expression", """
    SELECT CASE WHEN annual_income < 50000 THEN 'Low Income' WHEN annual_income <= 100000 THEN 'Medium Income'
                ELSE 'High Income' END AS income_segment, count(*) AS clients FROM raw_clients GROUP BY ALL""")(
    lambda k: aggs.agg_by_expression(k.stage["clients"], "income_segment", clean.income_segment("annual_income"), F.count("*").alias("clients")))
check("agg_bool_any", "SELECT from_account_id, bool_or(is_suspicious) AS any_is_suspicious FROM sv_transactions GROUP BY ALL")(
    lambda k: aggs.agg_bool_any(k.silver["transactions"], ["from_account_id"], "is_suspicious"))
check("agg_stddev", f"SELECT category, count(amount) AS n, round(stddev(CAST(amount AS DOUBLE)), 2) AS deviation FROM {T} GROUP BY ALL")(
    lambda k: aggs.agg_stddev(k.stage["transactions"], ["category"], "amount"))
POINTS = {"q1": 0.25, "median": 0.5, "q3": 0.75, "p99": 0.99}
check("agg_percentile", "SELECT category, " + ", ".join(
    f"quantile_cont(CAST(amount AS DOUBLE), {p}) AS {n}" for n, p in POINTS.items()) + f" FROM {T} GROUP BY ALL")(
    lambda k: aggs.agg_percentile(k.stage["transactions"], ["category"], "amount", POINTS))
check("outliers_iqr", f"""
    WITH q AS (SELECT quantile_cont(CAST(amount AS DOUBLE), 0.25) AS q1, quantile_cont(CAST(amount AS DOUBLE), 0.5) AS median,
                      quantile_cont(CAST(amount AS DOUBLE), 0.75) AS q3 FROM {T})
    SELECT q1, median, q3, q1 - 1.5 * (q3 - q1) AS low_fence, q3 + 1.5 * (q3 - q1) AS high_fence, count(amount) AS total_records,
           count(*) FILTER (CAST(amount AS DOUBLE) < q1 - 1.5 * (q3 - q1) OR CAST(amount AS DOUBLE) > q3 + 1.5 * (q3 - q1)) AS outlier_count
    FROM {T}, q GROUP BY ALL""")(lambda k: aggs.outliers_iqr(k.stage["transactions"], "amount"))
check("agg_windowed_recent", f"""
    SELECT category, count(*) AS row_count, count(*) FILTER (transaction_date >= {SINCE}) AS recent_count,
           ifnull(sum(amount) FILTER (transaction_date >= {SINCE}), 0) AS recent_total FROM {T} GROUP BY ALL""")(
    lambda k: aggs.agg_windowed_recent(k.stage["transactions"], ["category"], "transaction_date", k.as_of, "amount"))

# --- order, top-k, stacked reports ----------------------------------------------------------

check("order_multi", "SELECT client_id, risk_category, annual_income FROM raw_clients")(
    lambda k: aggs.order_multi(k.stage["clients"].select("client_id", "risk_category", "annual_income"),
                               [("risk_category", "asc"), ("annual_income", "desc"), ("client_id", "asc")]))
check("top_k", f"SELECT transaction_uuid, amount FROM {T} ORDER BY amount DESC NULLS LAST, transaction_uuid LIMIT 20")(
    lambda k: aggs.top_k(k.stage["transactions"].select("transaction_uuid", "amount"),
                         [F.col("amount").desc_nulls_last(), F.col("transaction_uuid")], 20))
_counts = lambda layer: " UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS record_count FROM {layer}_{t}" for t in S)
check("union_all_report_bronze", _counts("raw"))(lambda k: tables.union_all_report({t: k.bronze[t] for t in S}))
check("union_all_report", _counts("sv"))(lambda k: tables.union_all_report({t: k.silver[t] for t in S}))
GOLD = {
    "dim_client": "Dimension", "dim_product": "Dimension", "dim_branch": "Dimension", "dim_date": "Dimension",
    "fact_transactions_daily": "Fact", "fact_account_balance_daily": "Fact", "fact_loan_performance": "Fact",
    "client_360_view": "Data Mart", "product_performance_summary": "Data Mart", "branch_performance_dashboard": "Data Mart",
}
check("union_all_report_gold", " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, count(*) AS record_count, '{kind}' AS table_type FROM gd_{t}" for t, kind in GOLD.items()))(
    lambda k: tables.union_all_report({t: k.gold[t] for t in GOLD}, table_type=GOLD))
LAYERS = ["Stage (test)", "Bronze", "Silver", "Gold"]
check("custom_sort_order", " UNION ALL ".join(
    f"SELECT '{layer}' AS layer, (SELECT count(*) FROM {v}) AS record_count, {i + 1} AS sort_position"
    for i, (layer, v) in enumerate(zip(LAYERS, ["raw_clients", "raw_clients", "sv_clients", "gd_dim_client"]))))(
    lambda k: tables.custom_sort_order(tables.union_all_report(
        dict(zip(LAYERS, [k.stage["clients"], k.bronze["clients"], k.silver["clients"], k.gold["dim_client"]])), "layer"), "layer", LAYERS))
check("scalar_subquery_row", "SELECT " + ", ".join(f"(SELECT count(*) FROM raw_{t}) AS {t}" for t in S))(
    lambda k: tables.scalar_row({t: k.stage[t] for t in S}))
