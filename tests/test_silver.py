from decimal import Decimal

import pytest
from conftest import AS_OF, RUN_TS
from pyspark.sql import functions as F

from coinloft import rules
from coinloft.operators import dedup, joins, quality
from coinloft.plans import silver

MISSING = ["first_name", "last_name", "email", "phone", "birth_date", "credit_score", "annual_income"]


@pytest.fixture(scope="module")
def clients(bad_clients):
    rows = silver.silver_clients(bad_clients, AS_OF, RUN_TS).collect()
    return {r.client_id: r for r in rows}


@pytest.mark.parametrize(
    "client, score, issues",
    [
        (1, "0.90", "missing_first_name"), (2, "0.90", "missing_last_name"), (3, "0.85", "missing_email"),
        (4, "0.85", "missing_phone"), (5, "0.90", "missing_birth_date"), (6, "1.00", "invalid_email_format"),
        (7, "1.00", ""), (8, "1.00", ""), (9, "1.00", ""), (12, "1.00", ""), (13, "1.00", "invalid_credit_score"),
        (14, "1.00", "invalid_credit_score"), (15, "1.00", "negative_income"), (20, "1.00", ""),
        (19, "0.00", "; ".join(f"missing_{c}" for c in MISSING)),
    ],
)
def test_score_and_issues(clients, client, score, issues):
    assert clients[client].dq_score == Decimal(score)
    assert clients[client].dq_issues == issues


def test_domains_and_names(clients, bad_clients):
    assert clients[7].email_domain == "@example.com"
    assert clients[8].email_domain == ""
    assert clients[6].email_domain is None
    assert clients[1].full_name is None
    loose = {r.client_id: r for r in silver.silver_clients(bad_clients, AS_OF, RUN_TS, loose=True).collect()}
    assert loose[7].email_domain == "example.com"
    assert loose[6].email_domain == "invalid-email"
    assert loose[1].full_name == "Lee"
    assert loose[19].credit_score_category == "EXCELLENT" and clients[19].credit_score_category == "UNKNOWN"
    assert loose[19].income_category == "VERY_HIGH" and clients[19].income_category == "UNKNOWN"


def test_regex_rules_are_stricter_than_the_issue_list(bad_clients):
    hits = quality.dq_rules_eval(bad_clients, "client_id", rules.CLIENT_RULES).collect()
    mail = {r.client_id for r in hits if (r.field, r.rule) == ("email", "regex")}
    assert mail == {6, 7, 8}
    phone = {r.client_id for r in hits if (r.field, r.rule) == ("phone", "regex")}
    assert phone == {r.client_id for r in bad_clients.where("phone IS NOT NULL").collect()}


def test_dedup_gives_unique_keys_and_the_latest_row(bad_clients):
    out = silver.silver_clients(bad_clients, AS_OF, RUN_TS, dedup=True)
    assert out.count() == out.select("client_id").distinct().count() == 20
    assert {r.client_id for r in dedup.duplicate_keys(bad_clients, ["client_id"]).collect()} == {16, 17}
    latest = dedup.dedup_latest(bad_clients, ["client_id"], ["registration_date"]).where("client_id = 17").first()
    assert latest.email == "other@example.com"


def test_dedup_limits_groups_before_the_shuffle(spark, bad_clients):
    spark.conf.set("spark.sql.maxPlanStringLength", "100000")
    plan = dedup.dedup_latest(bad_clients, ["client_id"], ["registration_date"])._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_transactions(bad_transactions):
    rows = {r.transaction_id: r for r in silver.silver_transactions(bad_transactions, AS_OF, RUN_TS).collect()}
    assert len(rows) == 10
    assert rows[1].amount_abs == Decimal("500.00") and rows[1].transaction_type_normalized == "DEPOSIT"
    assert rows[5].status_normalized == "UNKNOWN" and rows[5].category_normalized == "OTHER"
    assert rows[8].is_suspicious and not rows[6].is_suspicious
    assert not rows[2].is_internal_transfer and rows[4].is_internal_transfer


def test_quarantine_splits_without_loss(bad_transactions):
    good, bad = quality.dq_split_quarantine(bad_transactions, rules.TRANSACTION_RULES)
    assert good.count() + bad.count() == 10
    assert [(r.transaction_id, r.quarantine_reason) for r in bad.collect()] == [(2, "from_account_id:required")]


def test_accounts(bad_accounts):
    rows = {r.account_id: r for r in silver.silver_accounts(bad_accounts, AS_OF, RUN_TS).collect()}
    assert rows[6].status_normalized == "UNKNOWN" and not rows[6].is_active
    assert rows[7].account_type_normalized == "OTHER"
    checks = quality.temporal_checks(
        bad_accounts, "account_id",
        {"close_before_open": F.col("close_date") < F.col("open_date"), "future_open": F.col("open_date") > F.lit(AS_OF)},
    )
    assert {(r.account_id, r.check_name) for r in checks.collect()} == {(1, "close_before_open"), (8, "future_open")}


def test_orphans(bad_accounts, bad_clients):
    out = joins.orphan_check(bad_accounts, "client_id", bad_clients, "client_id")
    assert [r.account_id for r in out.collect()] == [3]


def test_loans_keep_the_published_null_rules(spark):
    from coinloft.schemas import source_schema

    D = Decimal
    rows = [
        (1, 1, D("100.00"), D("25.00"), D("5.00"), 12, 3, None, None, None, D("1.00"), None),
        (2, 1, D("0.00"), D("0.00"), D("5.00"), 12, 3, None, None, " current", D("1.00"), D("0.600")),
    ]
    df = spark.createDataFrame(rows, source_schema("loans")).withColumn("load_timestamp", F.lit(RUN_TS))
    out = {r.loan_id: r for r in silver.silver_loans(df, AS_OF, RUN_TS).collect()}
    assert out[1].is_delinquent and out[1].ltv_category == "VERY_HIGH_RISK" and out[1].payment_progress == D("75.00")
    assert not out[2].is_delinquent and out[2].ltv_category == "LOW_RISK" and out[2].payment_progress == 0


def test_utilization_overflow_is_null(spark):
    from coinloft.schemas import source_schema

    D = Decimal
    rows = [(1, 1, D("50000.00"), D("1.00"), "usd", RUN_TS, D("10.00")), (2, 2, None, None, "usd", RUN_TS, None)]
    df = spark.createDataFrame(rows, source_schema("account_balances")).withColumn("load_timestamp", F.lit(RUN_TS))
    out = {r.balance_id: r for r in silver.silver_account_balances(df, AS_OF, RUN_TS).collect()}
    assert out[1].credit_utilization is None
    assert out[2].credit_utilization == 0 and out[2].balance_category == "VERY_HIGH" and out[2].credit_limit == 0


def test_cards_hide_number_and_cvv(spark):
    import datetime as dt

    from coinloft.schemas import source_schema

    rows = [(1, 1, 1, "4111222233334444", "X", dt.date(2025, 1, 1), 123, "debit", "gold", "LOST", dt.date(2020, 1, 1))]
    df = spark.createDataFrame(rows, source_schema("cards")).withColumn("load_timestamp", F.lit(RUN_TS))
    out = silver.silver_cards(df, AS_OF, RUN_TS)
    assert "cvv" not in out.columns and "card_number" not in out.columns
    row = out.first()
    assert row.card_number_masked == "****-****-****-4444" and row.status_normalized == "UNKNOWN" and row.is_expired
