"""The twelve silver tables. Each is one filter and one wide projection.

``dedup`` keeps the latest record per key first. ``loose`` switches to the
second rule set: fewer synonyms, unknown codes pass through, and its own bands.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import rules
from ..functions import calendar, clean
from ..functions.clean import code
from ..operators import quality
from ..operators.dedup import dedup_latest

KEYS = {
    "clients": "client_id",
    "products": "product_id",
    "contracts": "contract_id",
    "accounts": "account_id",
    "client_products": "relationship_id",
    "transactions": "transaction_id",
    "account_balances": "balance_id",
    "cards": "card_id",
    "branches": "branch_id",
    "employees": "employee_id",
    "loans": "loan_id",
    "credit_applications": "application_id",
}
PARTITIONS = {
    "clients": ["registration_year"],
    "contracts": ["start_year"],
    "accounts": ["open_year"],
    "transactions": ["transaction_year", "transaction_month"],
    "credit_applications": ["application_year"],
}
# what decides which copy is the latest, before the columns named by the caller
NEWEST = {"transactions": ["transaction_date", "transaction_uuid"], "account_balances": ["last_updated"]}


def _source(
    bronze: DataFrame, name: str, dedup: bool, required: Sequence[str] = (), per: Sequence[str] = ()
) -> DataFrame:
    rows = bronze.dropna(subset=[KEYS[name], *required])
    if not dedup:
        return rows
    keys = list(per) or [KEYS[name]]
    newest = [*NEWEST.get(name, []), "load_timestamp"]
    rest = [F.xxhash64(*[c for c in rows.columns if c not in newest]).desc()]
    return dedup_latest(rows, keys, [F.col(c).desc_nulls_last() for c in newest] + rest)


def _shape(df: DataFrame, name: str, run_ts: dt.datetime, columns: dict[str, Column], last: dict[str, Column] | None = None):
    stamps = {
        "load_timestamp": F.col("load_timestamp"),
        "process_timestamp": F.lit(run_ts),
        "source_system": F.lit(f"bronze.{name}"),
    }
    every = {**columns, **stamps, **(last or {})}
    return df.select(*[c.alias(n) for n, c in every.items()])


def _keep(*names: str) -> dict[str, Column]:
    return {n: F.col(n) for n in names}


def _trim(*names: str) -> dict[str, Column]:
    return {n: F.trim(n) for n in names}


def _code(*names: str) -> dict[str, Column]:
    return {n: code(n) for n in names}


def silver_clients(bronze, as_of, run_ts, dedup=False, loose=False):
    score_band = clean.below("credit_score", rules.CREDIT_SCORE_BAND, None if loose else "UNKNOWN")
    income_cuts, income_null = (rules.LOOSE_INCOME_BAND, None) if loose else (rules.INCOME_BAND, "UNKNOWN")
    issues = quality.client_issues()
    if loose:
        active = clean.all_of(F.col(c).isNotNull() for c in ("email", "phone", "credit_score"))
        issue_text = quality.dq_issues({k: issues[k] for k in quality.SHORT_ISSUES}, ",")
    else:
        active = clean.is_true(F.datediff(F.lit(as_of), "registration_date") <= 365)
        issue_text = quality.dq_issues(issues)
    columns = {
        **_keep("client_id"),
        **_trim("first_name", "last_name"),
        "full_name": clean.full_name("first_name", "last_name", skip_missing=loose),
        "email": clean.tidy("email", "lower"),
        "email_domain": clean.email_domain("email", after_last=loose),
        "phone": F.trim("phone") if loose else F.col("phone"),
        "phone_normalized": clean.phone_digits("phone", international=loose),
        **_keep("birth_date"),
        "age": calendar.age_years("birth_date", as_of, nearest=loose),
        **_keep("registration_date"),
        **_trim("address", "city"),
        "country": F.trim("country") if loose else code("country"),
        **_code("risk_category"),
        **_keep("credit_score"),
        "credit_score_category": score_band,
        **_code("employment_status"),
        **_keep("annual_income"),
        "income_category": clean.below("annual_income", income_cuts, income_null),
        "is_active": active,
        "dq_score": quality.dq_score(rules.CLIENT_WEIGHTS),
        "dq_issues": issue_text,
    }
    return _shape(
        _source(bronze, "clients", dedup), "clients", run_ts, columns, {"registration_year": F.year("registration_date")}
    )


def silver_products(bronze, as_of, run_ts, dedup=False, loose=False):
    groups = rules.LOOSE_PRODUCT_CATEGORY if loose else rules.PRODUCT_CATEGORY
    columns = {
        **_keep("product_id"),
        **_trim("product_name"),
        **_code("product_type"),
        "product_category": clean.mapped("product_type", groups, "OTHER"),
        **_code("currency"),
        "active": F.coalesce("active", F.lit(loose)),
    }
    return _shape(_source(bronze, "products", dedup), "products", run_ts, columns)


def silver_contracts(bronze, as_of, run_ts, dedup=False):
    columns = {
        **_keep("contract_id", "client_id", "product_id"),
        **_trim("contract_number"),
        **_keep("start_date", "end_date"),
        "contract_duration_days": calendar.open_days("start_date", "end_date", as_of),
        **_keep("contract_amount", "interest_rate", "status"),
        "status_normalized": clean.mapped("status", rules.CONTRACT_STATUS, "UNKNOWN"),
        **_keep("monthly_payment", "created_date"),
        "is_expired": calendar.expired("end_date", as_of),
        "days_to_expiry": calendar.days_until("end_date", as_of),
    }
    return _shape(
        _source(bronze, "contracts", dedup), "contracts", run_ts, columns, {"start_year": F.year("start_date")}
    )


def silver_accounts(bronze, as_of, run_ts, dedup=False, loose=False):
    types = (rules.LOOSE_ACCOUNT_TYPE, None) if loose else (rules.ACCOUNT_TYPE, "OTHER")
    states = (rules.LOOSE_ACCOUNT_STATUS, None) if loose else (rules.ACCOUNT_STATUS, "UNKNOWN")
    if loose:
        active = clean.is_true(code("status").isin("ACTIVE", "OPEN"))
    else:
        active = clean.is_true((code("status") == "ACTIVE") & calendar.not_past("close_date", as_of))
    columns = {
        **_keep("account_id", "client_id", "contract_id"),
        **_trim("account_number"),
        "account_type": code("account_type") if loose else F.col("account_type"),
        "account_type_normalized": clean.mapped("account_type", *types),
        **_code("currency"),
        **_keep("open_date", "close_date"),
        "account_age_days": calendar.open_days("open_date", "close_date", as_of),
        "status": code("status") if loose else F.col("status"),
        "status_normalized": clean.mapped("status", *states),
        "branch_code": F.trim("branch_code") if loose else F.col("branch_code"),
        "is_active": active,
    }
    return _shape(_source(bronze, "accounts", dedup), "accounts", run_ts, columns, {"open_year": F.year("open_date")})


def silver_client_products(bronze, as_of, run_ts, dedup=False):
    columns = {
        **_keep("relationship_id", "client_id", "product_id", "relationship_type"),
        "relationship_type_normalized": code("relationship_type"),
        **_keep("start_date", "end_date"),
        "relationship_duration_days": calendar.open_days("start_date", "end_date", as_of),
        **_keep("status"),
        "is_active": clean.is_true((code("status") == "ACTIVE") & calendar.not_past("end_date", as_of)),
    }
    rows = _source(bronze, "client_products", dedup, ["client_id", "product_id"])
    return _shape(rows, "client_products", run_ts, columns)


def silver_transactions(bronze, as_of, run_ts, dedup=False, loose=False, carry=()):
    """``carry``: further columns of the bronze rows that are kept."""
    if loose:
        types, states, groups = (
            (rules.LOOSE_TRANSACTION_TYPE, None),
            (rules.LOOSE_TRANSACTION_STATUS, None),
            (rules.LOOSE_TRANSACTION_CATEGORY, None),
        )
        raw, required, night = _code, [], (0, 5)
    else:
        types, states, groups = (
            (rules.TRANSACTION_TYPE, "OTHER"),
            (rules.TRANSACTION_STATUS, "UNKNOWN"),
            (rules.TRANSACTION_CATEGORY, "OTHER"),
        )
        raw, required, night = _keep, ["amount", "transaction_date"], rules.NIGHT_HOURS
    hour = F.hour("transaction_date")
    columns = {
        "transaction_id": F.col("transaction_id").cast("bigint"),
        **_trim("transaction_uuid"),
        **_keep("from_account_id", "to_account_id"),
        **_trim("from_account_number", "to_account_number"),
        **raw("transaction_type"),
        "transaction_type_normalized": clean.mapped("transaction_type", *types),
        **_keep("amount"),
        "amount_abs": F.abs("amount"),
        **_code("currency"),
        **_keep("transaction_date"),
        "transaction_date_only": F.to_date("transaction_date"),
        "transaction_hour": hour,
        **_trim("description"),
        **raw("status"),
        "status_normalized": clean.mapped("status", *states),
        **raw("category"),
        "category_normalized": clean.mapped("category", *groups),
        **_trim("merchant_name"),
        "is_internal_transfer": clean.internal_transfer("from_account_id", "to_account_id"),
        "is_suspicious": clean.suspicious("amount", hour, rules.SUSPICIOUS_AMOUNT, night, signed=loose),
        **_keep(*carry),
    }
    parts = {"transaction_year": F.year("transaction_date"), "transaction_month": F.month("transaction_date")}
    return _shape(_source(bronze, "transactions", dedup, required), "transactions", run_ts, columns, parts)


def silver_account_balances(bronze, as_of, run_ts, dedup=False, loose=False):
    """``dedup`` keeps the latest balance per account."""
    balance, limit = F.col("current_balance"), F.col("credit_limit")
    columns = {
        **_keep("balance_id", "account_id", "current_balance", "available_balance"),
        "reserved_amount": (balance - F.col("available_balance")).cast("decimal(14,2)"),
        **_code("currency"),
        **_keep("last_updated"),
        "credit_limit": F.coalesce(limit, F.lit(0).cast("decimal(12,2)")),
        "credit_utilization": F.expr(
            "CASE WHEN credit_limit > 0"
            " THEN try_cast(round(current_balance * 100 / credit_limit, 2) AS DECIMAL(5,2)) ELSE 0 END"
        ).cast("decimal(5,2)"),
        "balance_category": clean.balance_band(balance, rules.BALANCE_BAND, zero=not loose),
    }
    rows = _source(bronze, "account_balances", dedup, per=["account_id"])
    return _shape(rows, "account_balances", run_ts, columns)


def silver_cards(bronze, as_of, run_ts, dedup=False):
    """The card number is masked and the cvv never leaves bronze."""
    columns = {
        **_keep("card_id", "client_id", "account_id"),
        "card_number_masked": clean.mask_card("card_number"),
        **_trim("card_holder_name"),
        **_keep("expiry_date", "card_type"),
        "card_type_normalized": code("card_type"),
        **_code("card_level"),
        **_keep("status"),
        "status_normalized": clean.mapped("status", rules.CARD_STATUS, "UNKNOWN"),
        **_keep("issue_date"),
        "card_age_days": calendar.tenure_days("issue_date", as_of),
        "is_expired": calendar.expired("expiry_date", as_of),
        "days_to_expiry": calendar.days_until("expiry_date", as_of),
    }
    return _shape(_source(bronze, "cards", dedup), "cards", run_ts, columns)


def silver_branches(bronze, as_of, run_ts, dedup=False):
    columns = {
        **_keep("branch_id"),
        **_code("branch_code"),
        **_trim("branch_name", "address", "city", "state"),
        "state_code": clean.mapped("state", rules.STATE_CODE),
        **_trim("zip_code"),
        **_keep("phone"),
        "phone_normalized": clean.phone_digits("phone"),
        **_trim("manager_name"),
        **_keep("opening_date"),
        "branch_age_days": calendar.tenure_days("opening_date", as_of),
    }
    return _shape(_source(bronze, "branches", dedup), "branches", run_ts, columns)


def silver_employees(bronze, as_of, run_ts, dedup=False):
    columns = {
        **_keep("employee_id", "branch_id"),
        **_trim("first_name", "last_name"),
        "full_name": clean.full_name("first_name", "last_name"),
        "email": clean.tidy("email", "lower"),
        "email_domain": clean.email_domain("email"),
        **_keep("phone"),
        "phone_normalized": clean.phone_digits("phone"),
        **_keep("position"),
        "position_normalized": code("position"),
        **_keep("department"),
        "department_normalized": code("department"),
        **_keep("hire_date"),
        "tenure_days": calendar.tenure_days("hire_date", as_of),
        "tenure_years": calendar.tenure_years("hire_date", as_of),
        **_keep("salary"),
        "salary_category": clean.below("salary", rules.SALARY_BAND, "UNKNOWN"),
        **_keep("status"),
        "status_normalized": code("status"),
        "is_active": clean.is_true(code("status") == "ACTIVE"),
    }
    return _shape(_source(bronze, "employees", dedup), "employees", run_ts, columns)


def silver_loans(bronze, as_of, run_ts, dedup=False):
    """A missing delinquency status counts as delinquent, as in the table's definition."""
    paid = F.col("loan_amount") - F.col("outstanding_balance")
    current = code("delinquency_status").isin("CURRENT", "NONE")
    columns = {
        **_keep("loan_id", "contract_id", "loan_amount", "outstanding_balance"),
        "paid_amount": paid,
        "payment_progress": clean.percent(paid, "loan_amount", F.lit(0)).cast("decimal(7,2)"),
        **_keep("interest_rate", "term_months", "remaining_months"),
        "elapsed_months": F.col("term_months") - F.col("remaining_months"),
        **_keep("next_payment_date", "next_payment_amount", "delinquency_status"),
        "delinquency_status_normalized": clean.pattern_code("delinquency_status", rules.DELINQUENCY, "UNKNOWN"),
        "is_delinquent": ~clean.is_true(current),
        **_keep("collateral_value", "loan_to_value_ratio"),
        "ltv_category": clean.below("loan_to_value_ratio", rules.LTV_BAND, inclusive=True),
    }
    return _shape(_source(bronze, "loans", dedup), "loans", run_ts, columns)


def silver_credit_applications(bronze, as_of, run_ts, dedup=False):
    approved = F.coalesce("approved_amount", F.lit(0))
    columns = {
        **_keep("application_id", "client_id", "application_date", "requested_amount"),
        "approved_amount": approved,
        "approval_rate": clean.percent(approved, "requested_amount", F.lit(0)).cast("decimal(7,2)"),
        **_keep("purpose"),
        "purpose_normalized": code("purpose"),
        **_keep("status"),
        "status_normalized": clean.mapped("status", rules.APPLICATION_STATUS, "UNKNOWN"),
        **_keep("decision_date"),
        "processing_days": F.datediff("decision_date", "application_date"),
        **_keep("interest_rate_proposed"),
        **_trim("reason_for_rejection"),
        "rejection_category": clean.pattern_code("reason_for_rejection", rules.REJECTION_REASON, "OTHER", missing=True),
        **_keep("officer_id"),
        "is_approved": clean.is_true(code("status").isin(*rules.APPLICATION_STATUS["APPROVED"])),
        "is_rejected": clean.is_true(code("status").isin(*rules.APPLICATION_STATUS["REJECTED"])),
    }
    return _shape(
        _source(bronze, "credit_applications", dedup), "credit_applications", run_ts, columns,
        {"application_year": F.year("application_date")},
    )


BUILDERS = {name: globals()[f"silver_{name}"] for name in KEYS}
