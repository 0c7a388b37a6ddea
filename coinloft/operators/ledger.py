"""Account balances and their history from the transaction ledger."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

ASSET_TYPES = ("SAVINGS", "CHECKING", "DEPOSIT")


def ledger_legs(transactions: DataFrame) -> DataFrame:
    """One signed row per touched account of each COMPLETED transaction, from a single scan.

    A transfer of an account to itself only counts as a debit.
    """
    debit = F.struct(F.col("from_account_id").alias("account_id"), (-F.col("amount")).alias("delta"))
    credit = F.struct(
        F.when(~F.col("from_account_id").eqNullSafe(F.col("to_account_id")), F.col("to_account_id")).alias("account_id"),
        F.col("amount").alias("delta"),
    )
    return (
        transactions.where(F.col("status") == "COMPLETED")
        .select("transaction_date", F.explode(F.array(debit, credit)).alias("leg"))
        .select("transaction_date", "leg.account_id", "leg.delta")
        .where(F.col("account_id").isNotNull())
    )


def ledger_balance(accounts: DataFrame, transactions: DataFrame) -> DataFrame:
    """Opening balance plus credits minus debits, per account.

    Legs are summed per account before the join, so a hot account shuffles one
    row per task. Balances of asset accounts are never negative.
    """
    moved = (
        ledger_legs(transactions)
        .groupBy("account_id")
        .agg(F.sum("delta").alias("moved"), F.max("transaction_date").alias("last_transaction"))
    )
    raw = F.col("opening_balance") + F.coalesce("moved", F.lit(0))
    asset = F.upper(F.trim("account_type")).isin(*ASSET_TYPES)
    return accounts.join(moved, "account_id", "left").select(
        "account_id",
        F.when(asset, F.abs(raw)).otherwise(raw).cast("decimal(14,2)").alias("current_balance"),
        F.coalesce("last_transaction", F.col("open_date").cast("timestamp_ntz")).alias("last_updated"),
    )


def daily_balances(accounts: DataFrame, transactions: DataFrame) -> DataFrame:
    """End-of-day running balance per account and day with movement.

    Legs are summed per account and day first: the window then holds at most
    one row per calendar day of an account, however hot the account is.
    """
    per_day = (
        ledger_legs(transactions.where(F.col("transaction_date").isNotNull()))
        .groupBy("account_id", F.to_date("transaction_date").alias("day"))
        .agg(F.coalesce(F.sum("delta"), F.lit(0)).alias("delta"))
    )
    running = Window.partitionBy("account_id").orderBy("day").rowsBetween(Window.unboundedPreceding, 0)
    return per_day.join(accounts.select("account_id", "opening_balance"), "account_id").select(
        "account_id",
        "day",
        (F.col("opening_balance") + F.sum("delta").over(running)).cast("decimal(18,2)").alias("balance"),
    )


def balance_change(daily: DataFrame, key: str, day: str, value: str, spans: dict[str, int]) -> DataFrame:
    """Change of ``value`` against its last known state ``n`` days back, per span.

    ``daily`` holds one row per key and day. Days without a row are allowed:
    the frame reaches back to the newest row that is at least ``n`` days old.
    """
    number = F.unix_date(F.col(day))
    out = daily
    for name, back in spans.items():
        frame = Window.partitionBy(key).orderBy(number).rangeBetween(Window.unboundedPreceding, -back)
        out = out.withColumn(name, F.col(value) - F.last(value).over(frame))
    return out
