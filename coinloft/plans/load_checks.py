"""Summary figures of every gold table after its load, as (table, metric, value) rows."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import rules


def _figures() -> dict[str, dict]:
    total = lambda c: F.sum(c).cast("decimal(28,2)")
    avg = lambda c, places=2: F.round(F.try_divide(F.sum(c).cast("decimal(22,2)"), F.count(c).cast("decimal(20,0)")), places)
    return {
        "dim_client": {"total_clients": F.count("*"), "segments": F.count_distinct("client_segment"), "avg_income": avg("annual_income")},
        "dim_product": {"total_products": F.count("*")},
        "dim_branch": {"total_branches": F.count("*")},
        "dim_date": {"total_dates": F.count("*"), "first_key": F.min("date_key"), "last_key": F.max("date_key")},
        "fact_transactions_daily": {
            "daily_aggregates": F.count("*"), "total_transactions": F.sum("transaction_count"), "total_volume": total("total_amount")},
        "fact_account_balance_daily": {
            "total_balance_records": F.count("*"), "unique_accounts": F.count_distinct("account_id"),
            "total_system_balance": total("current_balance")},
        "fact_loan_performance": {
            "total_loans": F.count("*"), "delinquent_loans": F.count_if("is_delinquent"),
            "total_loan_amount": total("loan_amount"), "total_outstanding": total("outstanding_balance")},
        "client_360_view": {
            "total_clients": F.count("*"), "segments": F.count_distinct("client_segment"),
            "total_accounts": F.sum("total_accounts"), "total_balance": total("total_balance")},
        "product_performance_summary": {
            "total_products": F.count("*"), "total_product_clients": F.sum("total_clients"),
            "total_contract_value": total("total_contract_value")},
        "branch_performance_dashboard": {
            "total_branches": F.count("*"), "avg_accounts_per_branch": avg("total_accounts", 0),
            "total_system_deposits": total("total_deposits")},
    }


def gold_checks(g: Mapping[str, DataFrame]) -> DataFrame:
    out = None
    for table, figures in _figures().items():
        row = g[table].agg(*[c.cast("decimal(28,2)").alias(n) for n, c in figures.items()])
        pair = F.explode(F.array(*[F.struct(F.lit(n).alias("metric"), F.col(n).alias("value")) for n in figures]))
        one = row.select(pair.alias("p")).select(F.lit(table).alias("table_name"), "p.metric", "p.value")
        out = one if out is None else out.unionByName(one)
    return out


def quality_specs(t: Mapping[str, DataFrame]) -> dict[str, tuple[DataFrame, str, list[str], Column]]:
    """What the quality dashboard measures per silver table: key, critical columns, invalid values."""
    unknown = F.col("status_normalized") == "UNKNOWN"
    specs = {
        "clients": (
            "client_id", ["client_id", "first_name", "last_name", "email"],
            ~F.col("email").contains("@") | ~F.col("credit_score").between(*rules.SCORE_RANGE),
        ),
        "transactions": (
            "transaction_id", ["transaction_id", "from_account_id", "amount", "transaction_date"],
            (F.col("amount") == 0) | unknown,
        ),
        "accounts": (
            "account_id", ["account_id", "client_id", "branch_code"], (F.col("close_date") < F.col("open_date")) | unknown
        ),
        "loans": ("loan_id", ["loan_id", "contract_id", "delinquency_status"], F.col("loan_to_value_ratio") > 1),
        "products": ("product_id", ["product_id", "product_name", "product_type"], F.length("currency") != 3),
        "contracts": ("contract_id", ["contract_id", "client_id", "product_id"], (F.col("end_date") < F.col("start_date")) | unknown),
        "client_products": ("relationship_id", ["relationship_id", "client_id", "product_id"], F.col("end_date") < F.col("start_date")),
        "account_balances": ("balance_id", ["balance_id", "account_id", "current_balance"], F.col("credit_limit") < 0),
        "cards": ("card_id", ["card_id", "client_id", "account_id"], (F.col("expiry_date") < F.col("issue_date")) | unknown),
        "branches": ("branch_id", ["branch_id", "branch_code", "branch_name"], ~F.col("branch_code").startswith("BR")),
        "employees": ("employee_id", ["employee_id", "branch_id", "hire_date"], F.col("salary") <= 0),
        "credit_applications": (
            "application_id", ["application_id", "client_id", "requested_amount"], (F.col("requested_amount") <= 0) | unknown
        ),
    }
    return {name: (t[name], *spec) for name, spec in specs.items()}
