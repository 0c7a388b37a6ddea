"""Feature tables for the models."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import clean
from ..operators.joins import at_least_one, match_counts

Frames = Mapping[str, DataFrame]


def fraud_features(t: Frames) -> DataFrame:
    """COMPLETED transactions with their account and client attributes; the label is the suspicious flag."""
    done = t["transactions"].where(F.col("status_normalized") == "COMPLETED").select(
        "transaction_id", "transaction_uuid", F.col("from_account_id").alias("account_id"), "amount", "transaction_hour",
        F.dayofweek("transaction_date_only").isin(1, 7).cast("int").alias("is_weekend"),
        F.col("is_suspicious").cast("int").alias("label"), "transaction_type_normalized", "category_normalized",
    )
    accounts = t["accounts"].select("account_id", "client_id", "account_type_normalized")
    clients = t["clients"].select("client_id", "age", "credit_score", "annual_income", "risk_category")
    return done.join(accounts, "account_id").join(clients, "client_id").select(
        "transaction_id", "transaction_uuid", "amount", "transaction_hour", "is_weekend", "label", "age", "credit_score",
        "annual_income", "risk_category", "account_type_normalized", "transaction_type_normalized", "category_normalized",
        clean.percent("amount", "annual_income", places=4).alias("amount_to_income_ratio"),
        clean.is_true(F.col("risk_category") == "HIGH").cast("int").alias("is_high_risk_client"),
        clean.is_true(F.col("credit_score") < 650).cast("int").alias("is_low_credit_score"),
    )


def credit_risk_features(t: Frames) -> DataFrame:
    """One row per loan with its client's figures; ratios need a positive divisor."""
    clients = t["clients"].select("client_id", "age", "credit_score", "annual_income", "employment_status")
    contracts = t["contracts"].select("contract_id", "client_id")
    loans = t["loans"].select(
        "loan_id", "contract_id", "loan_amount", "interest_rate", "loan_to_value_ratio", "outstanding_balance",
        clean.is_true(F.col("delinquency_status").contains("DELINQUENT")).cast("int").alias("is_delinquent"),
    )
    positive = lambda part, whole, places: F.when(F.col(whole) > 0, clean.exact_ratio(part, whole, places))
    return loans.join(contracts, "contract_id").join(clients, "client_id").select(
        "loan_id", "client_id", "age", "credit_score", "annual_income", "employment_status", "loan_amount", "interest_rate",
        "loan_to_value_ratio", "outstanding_balance", "is_delinquent",
        positive("loan_amount", "annual_income", 4).alias("debt_to_income_ratio"),
        positive("annual_income", "age", 2).alias("income_to_age_ratio"),
        clean.percent("outstanding_balance", "loan_amount").alias("outstanding_pct"),
    )


def churn_features(t: Frames, as_of: dt.date, days: int = 90) -> DataFrame:
    """Activity per client. Balances and transactions count once per combination of the
    client's accounts, products and transactions, as the joined query counts them;
    the counts are multiplied, the combinations never built."""
    recent = t["transactions"].where(F.col("transaction_date") >= F.lit(as_of - dt.timedelta(days=days)))
    moves = match_counts(
        recent.select(F.col("from_account_id").alias("account_id"), "transaction_date"), "account_id",
        last=F.max("transaction_date"),
    ).withColumnRenamed("n", "tx_n")
    balances = match_counts(
        t["account_balances"].select("account_id", "current_balance"), "account_id", bal=F.sum("current_balance")
    ).withColumnRenamed("n", "bal_n")
    accounts = (
        t["accounts"].select("client_id", "account_id").where(F.col("client_id").isNotNull())
        .join(moves, "account_id", "left").join(balances, "account_id", "left")
        .groupBy("client_id").agg(
            F.count_distinct("account_id").alias("num_accounts"),
            F.sum(F.col("bal") * at_least_one("tx_n")).alias("bal"),
            F.sum(F.col("tx_n") * at_least_one("bal_n")).alias("moves"),
            F.max("last").alias("last"),
        )
    )
    products = (
        t["client_products"].groupBy("client_id", "product_id").agg(F.count("*").alias("n"))
        .groupBy("client_id").agg(F.count("product_id").alias("num_products"), F.sum("n").alias("copies"))
    )
    copies = at_least_one("copies")
    idle = F.coalesce(F.datediff(F.lit(as_of), "last"), F.lit(999))
    total = F.coalesce(F.col("bal") * copies, F.lit(0)).cast("decimal(28,2)")
    return t["clients"].join(accounts, "client_id", "left").join(products, "client_id", "left").select(
        "client_id", "age", "credit_score", "annual_income",
        F.datediff(F.lit(as_of), "registration_date").alias("customer_tenure_days"),
        F.coalesce("num_accounts", F.lit(0)).alias("num_accounts"),
        F.coalesce("num_products", F.lit(0)).alias("num_products"),
        total.alias("total_balance"),
        F.coalesce(F.col("moves") * copies, F.lit(0)).alias("transaction_count_90d"),
        idle.alias("days_since_last_transaction"),
        ((idle > days) & (total < 100)).cast("int").alias("is_churned"),
    )
