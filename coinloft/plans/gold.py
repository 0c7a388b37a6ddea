"""Gold tables: dimensions, facts and marts over the silver tables.

``t`` maps a silver table name to its DataFrame. Measures are summed per key
before each join, so a key that holds a third of the rows shuffles as a few
partial rows, and no join multiplies rows that are then summed.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import rules
from ..functions import calendar, clean
from ..operators.joins import left_join_preagg, one_row
from ..operators.ledger import balance_change
from ..operators.ranking import global_rank
from ..session import cut_lineage

Frames = Mapping[str, DataFrame]
MONEY = "decimal(18,2)"
WINDOW_DAYS = 30


def _money(column):
    return column.cast(MONEY)


def _stamps(df: DataFrame, run_ts: dt.datetime, updated: bool = True) -> DataFrame:
    df = df.withColumn("created_timestamp", F.lit(run_ts))
    return df.withColumn("updated_timestamp", F.lit(run_ts)) if updated else df


def _missing(kind: str):
    return F.lit(None).cast(kind)


def _age_group():
    return clean.below("age", rules.AGE_BAND)


def _segment():
    return clean.segment("annual_income", "credit_score", rules.SEGMENTS, rules.SEGMENT_REST)


def _state_region():
    pairs = [(F.col("state_code").isin(*states), F.lit(region)) for region, states in rules.STATE_REGION.items()]
    return clean.first_match(pairs, F.lit("OTHER"))


def _country_region():
    pairs = [(F.col("country").isin(*names), F.lit(region)) for region, names in rules.COUNTRY_REGION.items()]
    return clean.first_match(pairs, F.lit("OTHER"))


# --- per-client, per-product and per-branch measures, shared by several tables


def client_accounts(t: Frames) -> DataFrame:
    kind = F.col("account_type_normalized")
    return t["accounts"].groupBy("client_id").agg(
        F.count("*").alias("total_accounts"),
        F.count_if("is_active").alias("active_accounts"),
        F.count_if(kind == "CHECKING").alias("checking_accounts"),
        F.count_if(kind == "SAVINGS").alias("savings_accounts"),
        F.count_if(kind == "LOAN").alias("loan_accounts"),
    )


def client_product_count(t: Frames) -> DataFrame:
    return (
        t["client_products"].where("is_active").groupBy("client_id")
        .agg(F.count_distinct("product_id").alias("total_products"))
    )


def client_contract_count(t: Frames) -> DataFrame:
    return t["contracts"].groupBy("client_id").agg(F.count("*").alias("total_contracts"))


def client_cards(t: Frames) -> DataFrame:
    return t["cards"].groupBy("client_id").agg(
        F.count("*").alias("total_cards"), F.count_if(~F.col("is_expired")).alias("active_cards")
    )


def client_loans(t: Frames) -> DataFrame:
    per_contract = t["loans"].groupBy("contract_id").agg(
        F.count("*").alias("n"),
        F.count_if("is_delinquent").alias("late"),
        F.sum("loan_amount").alias("amount"),
        F.sum("outstanding_balance").alias("outstanding"),
        F.sum("next_payment_amount").alias("payment"),
    )
    owners = t["contracts"].select("contract_id", "client_id")
    return per_contract.join(owners, "contract_id").groupBy("client_id").agg(
        F.sum("n").alias("total_loans"),
        F.sum(F.col("n") - F.col("late")).alias("active_loans"),
        _money(F.sum("amount")).alias("total_loan_amount"),
        _money(F.sum("outstanding")).alias("total_outstanding_balance"),
        _money(F.sum("payment")).alias("total_loan_payment"),
        F.sum("late").alias("delinquent_loans"),
    )


def account_balance_sums(t: Frames) -> DataFrame:
    return t["account_balances"].groupBy("account_id").agg(
        F.sum("current_balance").alias("balance"), F.count("current_balance").alias("balances")
    )


def client_balances(t: Frames) -> DataFrame:
    owners = t["accounts"].select("account_id", "client_id")
    return account_balance_sums(t).join(owners, "account_id").groupBy("client_id").agg(
        _money(F.sum("balance")).alias("total_balance"),
        _money(clean.exact_ratio(F.sum("balance"), F.sum("balances"))).alias("avg_balance"),
    )


def client_activity(t: Frames, as_of: dt.date) -> DataFrame:
    """COMPLETED transactions of the last 30 days."""
    kind = F.col("transaction_type_normalized")
    per_account = (
        t["transactions"]
        .where(F.col("status_normalized") == "COMPLETED")
        .where(F.col("transaction_date") >= calendar.recent_start(as_of, WINDOW_DAYS))
        .where(F.col("from_account_id").isNotNull())
        .groupBy(F.col("from_account_id").alias("account_id"))
        .agg(
            F.count("*").alias("n"),
            F.sum("amount").alias("volume"),
            F.count_if(kind == "DEPOSIT").alias("deposits"),
            F.count_if(kind == "WITHDRAWAL").alias("withdrawals"),
            F.count_if(kind == "TRANSFER").alias("transfers"),
            F.count_if("is_suspicious").alias("suspicious"),
            F.max("transaction_date").alias("last_date"),
        )
    )
    owners = t["accounts"].select("account_id", "client_id")
    return per_account.join(owners, "account_id").groupBy("client_id").agg(
        F.sum("n").alias("transactions_30d"),
        _money(F.sum("volume")).alias("transaction_volume_30d"),
        _money(clean.exact_ratio(F.sum("volume"), F.sum("n"))).alias("avg_transaction_30d"),
        F.sum("deposits").alias("deposits_30d"),
        F.sum("withdrawals").alias("withdrawals_30d"),
        F.sum("transfers").alias("transfers_30d"),
        F.sum("suspicious").alias("suspicious_activities"),
        F.to_date(F.max("last_date")).alias("last_transaction_date"),
    )


def product_clients(t: Frames, as_of: dt.date) -> DataFrame:
    """Distinct-client measures per product, counted over one row per product and client."""
    start = calendar.recent_start(as_of, WINDOW_DAYS)
    end = F.col("end_date")
    known = t["client_products"].where(F.col("client_id").isNotNull())
    pairs = known.groupBy("product_id", "client_id").agg(
        F.bool_or("is_active").alias("active"),
        F.bool_or(clean.is_true(F.col("start_date") >= start)).alias("joined"),
        F.bool_or(clean.is_true((end >= start) & (end < F.lit(as_of)))).alias("left"),
    )
    return pairs.groupBy("product_id").agg(
        F.count("client_id").alias("total_clients"),
        F.count_if("active").alias("active_clients"),
        F.count_if("joined").alias("new_clients_mtd"),
        F.count_if("left").alias("churned_clients_mtd"),
    )


def product_contracts(t: Frames, as_of: dt.date) -> DataFrame:
    income = F.col("contract_amount") * F.col("interest_rate") / 100
    recent = F.col("created_date") >= calendar.recent_start(as_of, WINDOW_DAYS)
    this_year = F.year("created_date") == as_of.year
    return t["contracts"].groupBy("product_id").agg(
        F.count("*").alias("total_contracts"),
        F.count_if(F.col("status_normalized") == "ACTIVE").alias("active_contracts"),
        _money(F.sum("contract_amount")).alias("total_contract_value"),
        _money(clean.exact_ratio(F.sum("contract_amount"), F.count("contract_amount"))).alias("avg_contract_value"),
        F.sum(F.when(recent, income).otherwise(0)).cast("decimal(22,4)").alias("total_revenue_mtd"),
        F.sum(F.when(this_year, income).otherwise(0)).cast("decimal(22,4)").alias("total_revenue_ytd"),
    )


def branch_accounts(t: Frames, as_of: dt.date) -> DataFrame:
    """Account and distinct-client measures per branch, over one row per branch and client."""
    start = calendar.recent_start(as_of, WINDOW_DAYS)
    pairs = t["accounts"].groupBy("branch_code", "client_id").agg(
        F.count("*").alias("n"),
        F.count_if("is_active").alias("n_active"),
        F.count_if(F.col("open_date") >= start).alias("n_new"),
    )
    known = F.col("client_id").isNotNull()
    return pairs.groupBy("branch_code").agg(
        F.sum("n").alias("total_accounts"),
        F.sum("n_active").alias("active_accounts"),
        F.sum("n_new").alias("new_clients_mtd"),
        F.count("client_id").alias("total_clients"),
        F.count_if(known & (F.col("n_active") > 0)).alias("active_clients"),
    )


def branch_loans(t: Frames) -> DataFrame:
    """Loans of a branch's clients. A client's loans count once per account of the
    client at the branch, which is the table's definition; the product of the two
    counts is taken without pairing the rows."""
    per_contract = t["loans"].groupBy("contract_id").agg(F.sum("loan_amount").alias("amount"))
    owners = t["contracts"].select("contract_id", "client_id")
    per_client = per_contract.join(owners, "contract_id").groupBy("client_id").agg(F.sum("amount").alias("amount"))
    at_branch = t["accounts"].groupBy("client_id", "branch_code").agg(F.count("*").alias("n"))
    return at_branch.join(per_client, "client_id").groupBy("branch_code").agg(
        _money(F.sum(F.col("amount") * F.col("n"))).alias("total_loans_issued")
    )


def branch_loans_once(t: Frames) -> DataFrame:
    """The fan-out-safe form: each loan counts once per branch of its client."""
    per_contract = t["loans"].groupBy("contract_id").agg(F.sum("loan_amount").alias("amount"))
    owners = t["contracts"].select("contract_id", "client_id")
    per_client = per_contract.join(owners, "contract_id").groupBy("client_id").agg(F.sum("amount").alias("amount"))
    at_branch = t["accounts"].select("client_id", "branch_code").distinct()
    return at_branch.join(per_client, "client_id").groupBy("branch_code").agg(
        _money(F.sum("amount")).alias("total_loans_issued")
    )


def branch_approvals(t: Frames) -> DataFrame:
    """Approved share of the decided applications of the branch's clients."""
    per_client = t["credit_applications"].groupBy("client_id").agg(
        F.count_if("is_approved").alias("approved"),
        F.count_if(F.col("is_approved") | F.col("is_rejected")).alias("decided"),
    )
    at_branch = t["accounts"].select("client_id", "branch_code").distinct()
    return at_branch.join(per_client, "client_id").groupBy("branch_code").agg(
        clean.percent(F.sum("approved"), F.sum("decided")).cast("decimal(5,2)").alias("loan_approval_rate")
    )


# --- dimensions ---------------------------------------------------------------


# what a client's versions hold: everything that does not change with the report day
CLIENT_TRACKED = [
    "first_name", "last_name", "full_name", "email", "email_domain", "phone", "birth_date", "registration_date", "address", "city",
    "country", "risk_category", "credit_score", "credit_score_category", "employment_status", "annual_income", "income_category",
]


def dim_client(t: Frames, as_of: dt.date, run_ts: dt.datetime, versions: DataFrame | None = None) -> DataFrame:
    """One row per client, or per version of a client where ``versions`` (id, ``CLIENT_TRACKED`` and the version's days) are given.

    An open version's key is the client's id, a closed one's a hash of the client and its days. Age, tenure, segment and
    the counts are those of the report day in every version.
    """
    if versions is None:
        key, clients = F.col("client_id"), t["clients"].withColumns({
            "effective_date": F.col("registration_date"), "end_date": _missing("date"), "is_current": F.lit(True)})
    else:
        clients = versions.withColumn("age", calendar.age_years("birth_date", as_of))
        key = F.when(F.col("is_current"), F.col("client_id")).otherwise(F.xxhash64("client_id", "effective_date", "end_date"))
    accounts = client_accounts(t).select("client_id", "total_accounts", F.col("active_accounts").alias("total_active_accounts"))
    base = left_join_preagg(
        clients,
        "client_id",
        [
            (accounts, {"total_accounts": 0, "total_active_accounts": 0}),
            (client_product_count(t), {"total_products": 0}),
            (client_contract_count(t), {"total_contracts": 0}),
            (client_cards(t).select("client_id", "total_cards"), {"total_cards": 0}),
            (client_loans(t).select("client_id", "total_loans"), {"total_loans": 0}),
        ],
    )
    out = base.select(
        key.alias("client_key"), "client_id", "first_name", "last_name", "full_name", "email",
        "email_domain", "phone", "birth_date", "age", _age_group().alias("age_group"), "registration_date",
        calendar.tenure_days("registration_date", as_of).alias("customer_tenure_days"),
        calendar.tenure_years("registration_date", as_of).alias("customer_tenure_years"),
        "address", "city", "country", _country_region().alias("region"), "risk_category", "credit_score",
        "credit_score_category", "employment_status", "annual_income", "income_category",
        _segment().alias("client_segment"), _missing("decimal(12,2)").alias("client_lifetime_value"),
        "total_accounts", "total_active_accounts", "total_products", "total_contracts", "total_cards", "total_loans",
        "effective_date", "end_date", "is_current",
    )
    return _stamps(out, run_ts)


def dim_product(t: Frames, as_of: dt.date, run_ts: dt.datetime) -> DataFrame:
    contracts = t["contracts"].groupBy("product_id").agg(
        F.count("*").alias("total_contracts"), _money(F.sum("contract_amount")).alias("total_revenue")
    )
    base = left_join_preagg(
        t["products"],
        "product_id",
        [
            (product_clients(t, as_of).select("product_id", "total_clients"), {"total_clients": 0}),
            (contracts, {"total_contracts": 0, "total_revenue": F.lit(0).cast(MONEY)}),
        ],
    )
    out = base.select(
        F.col("product_id").alias("product_key"), "product_id", "product_name", "product_type", "product_category",
        "currency", "active", "total_clients", "total_contracts", "total_revenue",
        F.lit(as_of).alias("effective_date"), _missing("date").alias("end_date"), F.col("active").alias("is_current"),
    )
    return _stamps(out, run_ts)


def dim_branch(t: Frames, as_of: dt.date, run_ts: dt.datetime) -> DataFrame:
    staff = t["employees"].where("is_active").groupBy("branch_id").agg(F.count("*").alias("total_employees"))
    accounts = branch_accounts(t, as_of).select("branch_code", "total_accounts", "total_clients")
    base = left_join_preagg(t["branches"], "branch_id", [(staff, {"total_employees": 0})])
    base = left_join_preagg(base, "branch_code", [(accounts, {"total_accounts": 0, "total_clients": 0})])
    out = base.select(
        F.col("branch_id").alias("branch_key"), "branch_id", "branch_code", "branch_name", "address", "city", "state",
        "state_code", "zip_code", _state_region().alias("region"), "phone", "manager_name", "opening_date",
        "branch_age_days", "total_employees", "total_accounts", "total_clients",
        F.col("opening_date").alias("effective_date"), _missing("date").alias("end_date"),
        F.lit(True).alias("is_current"),
    )
    return _stamps(out, run_ts)


def dim_date(days: DataFrame) -> DataFrame:
    """Calendar attributes of the ``date_value`` column of ``days``."""
    d = F.col("date_value")
    month, dom, dow = F.month(d), F.dayofmonth(d), F.dayofweek(d)
    weekend = dow.isin(1, 7)
    holidays = [((month == m) & (dom == n), F.lit(label)) for m, n, label in rules.HOLIDAYS]
    holiday = clean.first_match(holidays, _missing("string"))
    return days.select(
        F.date_format(d, "yyyyMMdd").cast("int").alias("date_key"), d.alias("date_value"),
        F.year(d).alias("year"), F.quarter(d).alias("quarter"),
        F.concat(F.lit("Q"), F.quarter(d), F.lit(" "), F.year(d)).alias("quarter_name"),
        month.alias("month"), F.date_format(d, "MMMM").alias("month_name"), F.date_format(d, "MMM").alias("month_short"),
        F.weekofyear(d).alias("week_of_year"), dom.alias("day_of_month"), dow.alias("day_of_week"),
        F.date_format(d, "EEEE").alias("day_name"), F.date_format(d, "EEE").alias("day_short"),
        weekend.alias("is_weekend"), holiday.isNotNull().alias("is_holiday"), holiday.alias("holiday_name"),
        (~weekend & holiday.isNull()).alias("is_business_day"),
        F.year(d).alias("fiscal_year"), F.quarter(d).alias("fiscal_quarter"), month.alias("fiscal_month"),
    )


def calendar_days(bounds: DataFrame) -> DataFrame:
    """Every day between the ``first_day`` and ``last_day`` of a one-row frame."""
    return bounds.select(F.explode(F.sequence("first_day", "last_day")).alias("date_value"))


def dim_account(t: Frames, as_of: dt.date, run_ts: dt.datetime) -> DataFrame:
    used = (
        t["transactions"].where(F.col("from_account_id").isNotNull())
        .groupBy(F.col("from_account_id").alias("account_id")).agg(F.count("*").alias("total_transactions"))
    )
    cards = t["cards"].groupBy("account_id").agg(F.count("*").alias("total_cards"))
    base = left_join_preagg(
        t["accounts"], "account_id", [(used, {"total_transactions": 0}), (cards, {"total_cards": 0})]
    )
    out = base.select(
        F.col("account_id").alias("account_key"), "account_id", "account_number",
        F.col("account_type_normalized").alias("account_type"), F.col("status_normalized").alias("account_status"),
        "client_id", "contract_id", "branch_code", "currency", F.col("open_date").alias("opening_date"),
        calendar.tenure_years("open_date", as_of).alias("account_age_years"), "total_transactions", "total_cards",
        F.col("open_date").alias("effective_date"), F.col("close_date").alias("end_date"),
        F.col("is_active").alias("is_current"),
    )
    return _stamps(out, run_ts)


# --- facts ----------------------------------------------------------------------


DAILY_GRAIN = {
    "transaction_date": "transaction_date_only", "account_id": "from_account_id",
    "transaction_type": "transaction_type_normalized", "category": "category_normalized",
    "currency": "currency", "year": "transaction_year", "month": "transaction_month",
}
DAILY_COUNTS = ["successful_count", "failed_count", "pending_count", "cancelled_count", "suspicious_transaction_count"]


def daily_partials(transactions: DataFrame) -> DataFrame:
    """Totals per day, account and codes that add up: partials of disjoint rows merge into those of all rows."""
    state = F.col("status_normalized")
    return (
        transactions
        .where(F.col("transaction_date_only").isNotNull())
        .groupBy(*[F.col(source).alias(name) for name, source in DAILY_GRAIN.items()])
        .agg(
            F.count("*").alias("transaction_count"),
            F.sum("amount").alias("total_amount"),
            F.count("amount").alias("amounts"),
            F.min("amount").alias("min_amount"),
            F.max("amount").alias("max_amount"),
            F.count_if(state == "COMPLETED").alias("successful_count"),
            F.count_if(state == "FAILED").alias("failed_count"),
            F.count_if(state == "PENDING").alias("pending_count"),
            F.count_if(state == "CANCELLED").alias("cancelled_count"),
            F.count_if("is_suspicious").alias("suspicious_transaction_count"),
        )
    )


def merge_partials(partials: DataFrame, *owner: str) -> DataFrame:
    """One row per grain (and owner columns) from any number of partial rows."""
    return partials.groupBy(*DAILY_GRAIN, *owner).agg(
        F.sum("transaction_count").alias("transaction_count"),
        F.sum("total_amount").alias("total_amount"),
        F.sum("amounts").alias("amounts"),
        F.min("min_amount").alias("min_amount"),
        F.max("max_amount").alias("max_amount"),
        *[F.sum(c).alias(c) for c in DAILY_COUNTS],
    )


def fact_from_partials(partials: DataFrame, accounts: DataFrame, run_ts: dt.datetime) -> DataFrame:
    """The daily fact from partial rows, several per grain or one."""
    owners = accounts.select("account_id", "client_id", "branch_code")
    total = merge_partials(partials.join(owners, "account_id", "left"), "client_id", "branch_code")
    out = total.select(
        "transaction_date", F.coalesce("client_id", F.lit(-1)).alias("client_id"), "account_id",
        F.coalesce("branch_code", F.lit("UNKNOWN")).alias("branch_code"), "transaction_type", "category", "currency",
        "transaction_count", _money(F.col("total_amount")).alias("total_amount"),
        _money(clean.exact_ratio("total_amount", "amounts")).alias("avg_amount"), "min_amount", "max_amount",
        *DAILY_COUNTS[:4],
        clean.percent("successful_count", "transaction_count").cast("decimal(5,2)").alias("success_rate"),
        (F.col("suspicious_transaction_count") > 0).alias("has_suspicious_transactions"),
        "suspicious_transaction_count", "year", "month",
    )
    return _stamps(out, run_ts)


def fact_transactions_daily(t: Frames, as_of: dt.date, run_ts: dt.datetime) -> DataFrame:
    """Daily totals. Rows are reduced to the daily grain before the account join,
    which also spreads the rows of a hot account over its days and codes."""
    return fact_from_partials(daily_partials(t["transactions"]), t["accounts"], run_ts)


def fact_account_balance_daily(t: Frames, as_of: dt.date, run_ts: dt.datetime) -> DataFrame:
    """Balance snapshots with their change over 1, 7 and 30 days (NULL without an earlier snapshot)."""
    snapshots = t["account_balances"].where(F.col("last_updated").isNotNull()).withColumn(
        "snapshot_date", F.to_date("last_updated")
    )
    closing = snapshots.groupBy("account_id", "snapshot_date").agg(
        F.max_by("current_balance", F.struct("last_updated", "balance_id")).alias("closing")
    )
    spans = {"balance_change_daily": 1, "balance_change_weekly": 7, "balance_change_monthly": 30}
    changes = balance_change(closing, "account_id", "snapshot_date", "closing", spans).drop("closing")
    owners = t["accounts"].select("account_id", "client_id", F.col("account_type_normalized").alias("account_type"), "branch_code")
    out = snapshots.join(changes, ["account_id", "snapshot_date"]).join(owners, "account_id").select(
        "snapshot_date", "account_id", "client_id", "account_type", "branch_code", "currency", "current_balance",
        "available_balance", "reserved_amount", "credit_limit", "credit_utilization", "balance_category", *spans,
        F.year("last_updated").alias("year"), F.month("last_updated").alias("month"),
    )
    return _stamps(out, run_ts, updated=False)


def fact_loan_performance(t: Frames, as_of: dt.date, run_ts: dt.datetime) -> DataFrame:
    """Loans without a contract are left out."""
    owners = t["contracts"].select("contract_id", "client_id")
    out = t["loans"].join(owners, "contract_id").select(
        "loan_id", "contract_id", "client_id", F.lit(as_of).alias("snapshot_date"), "loan_amount",
        "outstanding_balance", "paid_amount", "payment_progress", "interest_rate", "term_months", "remaining_months",
        "elapsed_months", "next_payment_date", "next_payment_amount",
        calendar.days_until("next_payment_date", as_of).alias("days_to_next_payment"),
        _missing("int").alias("total_payments_made"), _missing("int").alias("missed_payments"),
        _missing("int").alias("late_payments"), _missing("decimal(5,2)").alias("on_time_payment_rate"),
        F.col("delinquency_status_normalized").alias("delinquency_status"), "is_delinquent",
        _missing("int").alias("days_past_due"), "collateral_value", "loan_to_value_ratio", "ltv_category",
        _missing("decimal(5,4)").alias("default_probability"),
        F.lit(as_of.year).alias("year"), F.lit(as_of.month).alias("month"),
    )
    return _stamps(out, run_ts)


# --- marts ----------------------------------------------------------------------


def client_360_view(t: Frames, as_of: dt.date, run_ts: dt.datetime) -> DataFrame:
    zero = F.lit(0).cast(MONEY)
    base = left_join_preagg(
        t["clients"],
        "client_id",
        [
            (client_accounts(t), dict.fromkeys(
                ["total_accounts", "active_accounts", "checking_accounts", "savings_accounts", "loan_accounts"], 0)),
            (client_balances(t), {"total_balance": zero, "avg_balance": zero}),
            (client_product_count(t), {"total_products": 0}),
            (client_contract_count(t), {"total_contracts": 0}),
            (client_cards(t), {"total_cards": 0, "active_cards": 0}),
            (client_loans(t), {
                "total_loans": 0, "active_loans": 0, "total_loan_amount": zero, "total_outstanding_balance": zero,
                "total_loan_payment": zero, "delinquent_loans": 0}),
            (client_activity(t, as_of), {
                "transactions_30d": 0, "transaction_volume_30d": zero, "avg_transaction_30d": zero, "deposits_30d": 0,
                "withdrawals_30d": 0, "transfers_30d": 0, "suspicious_activities": 0}),
        ],
    )
    idle = F.coalesce(F.datediff(F.lit(as_of), "last_transaction_date"), F.lit(999))
    out = base.select(
        "client_id", F.lit(as_of).alias("snapshot_date"), "full_name", "email", "phone", "age",
        _age_group().alias("age_group"), "city", "country", "risk_category", "credit_score", "credit_score_category",
        "annual_income", "income_category", _segment().alias("client_segment"),
        "total_accounts", "active_accounts", "checking_accounts", "savings_accounts", "loan_accounts",
        "total_balance", "avg_balance", "total_products", "total_contracts", "total_cards", "active_cards",
        "total_loans", "active_loans", "total_loan_amount", "total_outstanding_balance", "total_loan_payment",
        "delinquent_loans", "transactions_30d", "transaction_volume_30d", "avg_transaction_30d", "deposits_30d",
        "withdrawals_30d", "transfers_30d", "last_transaction_date", idle.alias("days_since_last_transaction"),
        clean.at_least("transactions_30d", rules.FREQUENCY_BAND).alias("transaction_frequency"),
        _missing("string").alias("channel_preference"), _missing("decimal(12,2)").alias("customer_lifetime_value"),
        _missing("decimal(12,2)").alias("total_revenue"), _missing("decimal(10,2)").alias("total_fees_paid"),
        _missing("decimal(5,2)").alias("profitability_score"), _missing("decimal(5,2)").alias("risk_score"),
        _missing("int").alias("fraud_alerts"), "suspicious_activities",
        F.lit(as_of.year).alias("snapshot_year"), F.lit(as_of.month).alias("snapshot_month"),
    )
    return _stamps(out, run_ts)


def product_performance_summary(t: Frames, as_of: dt.date, run_ts: dt.datetime) -> DataFrame:
    zero, zero4 = F.lit(0).cast(MONEY), F.lit(0).cast("decimal(22,4)")
    clients = product_clients(t, as_of)
    base = left_join_preagg(
        t["products"],
        "product_id",
        [
            (clients, dict.fromkeys(["total_clients", "active_clients", "new_clients_mtd", "churned_clients_mtd"], 0)),
            (product_contracts(t, as_of), {
                "total_contracts": 0, "active_contracts": 0, "total_contract_value": zero, "avg_contract_value": zero,
                "total_revenue_mtd": zero4, "total_revenue_ytd": zero4}),
        ],
    )
    all_clients = clients.agg(F.sum("total_clients")).scalar()
    older = F.col("total_clients") - F.col("new_clients_mtd")
    out = base.select(
        "product_id", F.lit(as_of).alias("report_date"), "product_name", "product_type", "product_category",
        "total_clients", "new_clients_mtd", "churned_clients_mtd", "active_clients",
        clean.percent("active_clients", "total_clients", F.lit(0)).cast("decimal(5,2)").alias("retention_rate"),
        "total_contracts", "active_contracts", "total_contract_value", "avg_contract_value", "total_revenue_mtd",
        "total_revenue_ytd",
        clean.percent("new_clients_mtd", older).cast("decimal(12,2)").alias("client_growth_rate"),
        _missing("decimal(5,2)").alias("revenue_growth_rate"),
        clean.percent("total_clients", all_clients).cast("decimal(5,2)").alias("market_share"),
        F.lit(as_of.year).alias("year"), F.lit(as_of.month).alias("month"),
    )
    return _stamps(out, run_ts)


def branch_performance(t: Frames, as_of: dt.date, run_ts: dt.datetime, fanout_safe: bool = False) -> DataFrame:
    """The dashboard without its ranks."""
    zero = F.lit(0).cast(MONEY)
    staff = t["employees"].groupBy("branch_id").agg(
        F.count("*").alias("total_employees"),
        F.count_if("is_active").alias("active_employees"),
        F.round(F.avg("tenure_years"), 1).cast("decimal(5,1)").alias("avg_employee_tenure_years"),
    )
    owners = t["accounts"].select("account_id", "branch_code")
    balances = account_balance_sums(t).join(owners, "account_id").groupBy("branch_code").agg(
        _money(F.sum("balance")).alias("total_deposits"),
        _money(clean.exact_ratio(F.sum("balance"), F.sum("balances"))).alias("avg_account_balance"),
    )
    recent = F.col("transaction_date") >= calendar.recent_start(as_of, WINDOW_DAYS)
    moved = (
        t["transactions"].where(F.col("status_normalized") == "COMPLETED").where(F.col("from_account_id").isNotNull())
        .groupBy(F.col("from_account_id").alias("account_id"))
        .agg(F.sum("amount").alias("volume"), F.sum(F.when(recent, F.col("amount")).otherwise(0)).alias("recent"))
        .join(owners, "account_id")
        .groupBy("branch_code")
        .agg(
            _money(F.sum("volume")).alias("total_transaction_volume"),
            (F.sum("recent").cast("decimal(22,2)") * F.lit(0.001).cast("decimal(4,3)")).cast("decimal(22,5)").alias("total_revenue_mtd"),
        )
    )
    loans = branch_loans_once(t) if fanout_safe else branch_loans(t)
    base = left_join_preagg(t["branches"], "branch_id", [(staff, {
        "total_employees": 0, "active_employees": 0, "avg_employee_tenure_years": F.lit(0).cast("decimal(5,1)")})])
    base = left_join_preagg(
        base,
        "branch_code",
        [
            (branch_accounts(t, as_of), dict.fromkeys(
                ["total_accounts", "active_accounts", "new_clients_mtd", "total_clients", "active_clients"], 0)),
            (balances, {"total_deposits": zero, "avg_account_balance": zero}),
            (loans, {"total_loans_issued": zero}),
            (moved, {"total_transaction_volume": zero, "total_revenue_mtd": F.lit(0).cast("decimal(22,5)")}),
            (branch_approvals(t), {}),
        ],
    )
    out = base.select(
        "branch_id", "branch_code", F.lit(as_of).alias("report_date"), "branch_name", "city", "state",
        _state_region().alias("region"), "manager_name", "total_employees", "active_employees",
        "avg_employee_tenure_years", "total_clients", "new_clients_mtd", "active_clients", "total_accounts",
        "active_accounts", "total_deposits", "total_loans_issued", "total_transaction_volume", "total_revenue_mtd",
        _missing("decimal(12,2)").alias("total_fees_collected"), "avg_account_balance", "loan_approval_rate",
        _missing("decimal(3,2)").alias("customer_satisfaction_score"), _missing("decimal(5,2)").alias("nps_score"),
        F.lit(as_of.year).alias("year"), F.lit(as_of.month).alias("month"),
    )
    return _stamps(out, run_ts)


def rank_branches(dashboard: DataFrame) -> DataFrame:
    """Ranks by revenue, clients and deposits per employee; missing metrics rank last."""
    per_head = clean.exact_ratio("total_deposits", "total_employees")
    ranked = global_rank(
        dashboard.withColumn("_efficiency", per_head),
        "branch_id",
        {"revenue_rank": "total_revenue_mtd", "customer_rank": "total_clients", "efficiency_rank": "_efficiency"},
    )
    return ranked.drop("_efficiency")


def branch_performance_dashboard(t: Frames, as_of: dt.date, run_ts: dt.datetime, fanout_safe: bool = False) -> DataFrame:
    """Ranking reads the metrics several times, so they are written once first."""
    return rank_branches(cut_lineage(branch_performance(t, as_of, run_ts, fanout_safe), "branch-metrics"))


def financial_kpi_summary(t: Frames, as_of: dt.date, run_ts: dt.datetime) -> DataFrame:
    """Enterprise totals, one row per metric category. Each source is reduced to one row first."""
    start = calendar.recent_start(as_of, WINDOW_DAYS)
    joined = F.col("registration_date") >= start
    clients = t["clients"].agg(
        F.count("*").alias("total_clients"), F.count_if("is_active").alias("active_clients"),
        F.count_if(joined).alias("new_clients"),
    )
    accounts = t["accounts"].agg(
        F.count("*").alias("total_accounts"), F.count_if("is_active").alias("active_accounts")
    )
    kinds = t["accounts"].where(F.col("account_type_normalized") != "LOAN").select("account_id")
    deposits = (
        t["account_balances"].where(F.col("current_balance") > 0).groupBy("account_id")
        .agg(F.sum("current_balance").alias("balance")).join(kinds, "account_id")
        .agg(F.coalesce(F.sum("balance"), F.lit(0)).cast(MONEY).alias("total_deposits"))
    )
    bad = F.col("delinquency_status_normalized").isin("DELINQUENT_90", "DELINQUENT_120_PLUS")
    loans = t["loans"].agg(
        F.count("*").alias("n"), F.count_if("is_delinquent").alias("late"),
        F.coalesce(F.sum("outstanding_balance"), F.lit(0)).cast(MONEY).alias("total_loans"),
        F.coalesce(F.sum(F.when(bad, F.col("outstanding_balance"))), F.lit(0)).cast(MONEY).alias("npl"),
    )
    income = F.col("contract_amount") * F.col("interest_rate") / 100
    revenue = t["contracts"].agg(
        F.sum(F.when(F.col("created_date") >= start, income).otherwise(0)).cast("decimal(22,4)").alias("mtd"),
        F.sum(F.when(F.year("created_date") == as_of.year, income).otherwise(0)).cast("decimal(22,4)").alias("ytd"),
    )
    moved = t["transactions"].agg(
        F.count("*").alias("n"), F.count_if(F.col("status_normalized") == "COMPLETED").alias("ok"),
        F.coalesce(F.sum("amount"), F.lit(0)).cast(MONEY).alias("volume"), F.count("amount").alias("amounts"),
    )
    parts = {"c": clients, "a": accounts, "d": deposits, "l": loans, "r": revenue, "x": moved}
    spark = t["clients"].sparkSession
    row = spark.range(1).select(*[one_row(df).alias(name) for name, df in parts.items()])
    categories = F.explode(F.array(*[F.lit(c) for c in ("DEPOSITS", "LOANS", "TRANSACTIONS", "REVENUE")]))
    older = F.col("c.total_clients") - F.col("c.new_clients")
    out = row.select(categories.alias("metric_category"), "*").select(
        F.lit(as_of).alias("report_date"), "metric_category", "c.total_clients", "c.active_clients",
        "a.total_accounts", "a.active_accounts", F.col("l.total_loans").alias("total_assets"),
        F.col("d.total_deposits").alias("total_liabilities"),
        _money(F.col("l.total_loans") - F.col("d.total_deposits")).alias("net_assets"), "d.total_deposits",
        "l.total_loans", F.col("r.mtd").alias("total_revenue_mtd"), F.col("r.ytd").alias("total_revenue_ytd"),
        F.col("x.n").alias("total_transactions"), F.col("x.volume").alias("total_transaction_volume"),
        _money(clean.exact_ratio("x.volume", "x.amounts")).alias("avg_transaction_value"),
        clean.percent("x.ok", "x.n").cast("decimal(5,2)").alias("transaction_success_rate"),
        F.col("l.late").alias("total_delinquent_loans"),
        clean.percent("l.late", "l.n").cast("decimal(5,2)").alias("delinquency_rate"),
        F.col("l.npl").alias("total_npl_amount"), _missing("decimal(5,2)").alias("provision_coverage_ratio"),
        clean.percent("c.new_clients", older).cast("decimal(12,2)").alias("client_growth_rate"),
        _missing("decimal(5,2)").alias("revenue_growth_rate"), _missing("decimal(5,2)").alias("loan_growth_rate"),
        _missing("decimal(5,2)").alias("deposit_growth_rate"),
        F.lit(as_of.year).alias("year"), F.lit(as_of.month).alias("month"),
    )
    return _stamps(out, run_ts)


PARTITIONS = {
    "fact_transactions_daily": ["year", "month"],
    "fact_account_balance_daily": ["year", "month"],
    "fact_loan_performance": ["year", "month"],
    "client_360_view": ["snapshot_year", "snapshot_month"],
    "product_performance_summary": ["year", "month"],
    "branch_performance_dashboard": ["year", "month"],
    "financial_kpi_summary": ["year", "month"],
    "data_quality_dashboard": ["year", "month"],
}
