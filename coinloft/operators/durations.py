"""Durations and shares of loans, applications, relationships and transactions that the layer tables leave out."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import calendar, clean


def loan_durations(loans: DataFrame, contracts: DataFrame, as_of: dt.date) -> DataFrame:
    """Length, age and rest of a loan's contract, and the share still owed."""
    dates = contracts.select("contract_id", "start_date", "end_date", "status")
    return loans.join(dates, "contract_id").select(
        "loan_id", F.datediff("end_date", "start_date").alias("contract_duration_days"),
        calendar.days_until("end_date", as_of).alias("days_until_maturity"),
        calendar.months_since("start_date", as_of).alias("months_since_start"),
        clean.percent("outstanding_balance", "loan_amount").alias("outstanding_percentage"),
        clean.is_true(F.col("status") == "PENDING").alias("is_pending"))


def application_durations(applications: DataFrame) -> DataFrame:
    """Days to the decision and the share of the request that was approved (NULL without an approved amount)."""
    return applications.select(
        "application_id", F.datediff("decision_date", "application_date").alias("days_to_decision"),
        clean.percent("approved_amount", "requested_amount").alias("approval_percentage"))


def days_since_use(rows: DataFrame, key: str, last_used: str, as_of: dt.date) -> DataFrame:
    """Days since ``last_used``; NULL where it is."""
    return rows.select(key, F.datediff(calendar.day(as_of), F.col(last_used)).alias("days_since_last_usage"))


def completion(transactions: DataFrame) -> DataFrame:
    """``is_completed`` holds for the published spelling of the status only."""
    return transactions.select("transaction_uuid", clean.is_true(F.col("status") == "COMPLETED").alias("is_completed"))
