"""Analytical queries. ``s`` holds stage tables, ``g`` gold tables.

Where a query joins several one-to-many tables before it sums, its published
answer counts each row once per combination. Those answers are computed from
row counts per key (a sum times the other tables' match counts), never by
emitting the combinations.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import clean
from ..operators.joins import at_least_one, match_counts

Frames = Mapping[str, DataFrame]


def _sum2(c: Column | str) -> Column:
    return F.sum(c).cast("decimal(28,2)")


def _mean(total: Column, n: Column) -> Column:
    return clean.exact_ratio(total, n)


def _avg(name: str) -> Column:
    return clean.exact_ratio(F.sum(name), F.count(name))


def _completed() -> Column:
    return F.col("status") == "COMPLETED"


def _null_safe(left: DataFrame, right: DataFrame, keys, how: str = "left") -> DataFrame:
    r = right.select(*[F.col(c).alias(f"_{c}") if c in keys else F.col(c) for c in right.columns])
    test = clean.all_of(left[k].eqNullSafe(r[f"_{k}"]) for k in keys)
    return left.join(r, test, how).drop(*[f"_{k}" for k in keys])


def client_base(s: Frames) -> DataFrame:
    high = F.col("credit_score") > 700
    return s["clients"].groupBy("risk_category", "employment_status").agg(
        F.count("*").alias("client_count"),
        _avg("credit_score").alias("avg_credit_score"),
        _avg("annual_income").alias("avg_annual_income"),
        _sum2("annual_income").alias("total_annual_income"),
        F.count_if(high).alias("high_credit_clients"),
        clean.percent(F.count_if(high), F.count("*")).alias("high_credit_percentage"),
    )


def monthly_activity(s: Frames) -> DataFrame:
    return s["transactions"].where(_completed()).groupBy(
        F.year("transaction_date").alias("year"), F.month("transaction_date").alias("month"), "category", "transaction_type"
    ).agg(
        F.count("*").alias("transaction_count"),
        _sum2("amount").alias("total_amount"),
        _avg("amount").alias("avg_amount"),
        F.count_distinct("from_account_id").alias("unique_accounts"),
    )


def product_effectiveness(s: Frames) -> DataFrame:
    keys = ["product_name", "product_type"]
    products = s["products"].where("active").select("product_id", *keys)
    contracts = s["contracts"].select("contract_id", "product_id", "client_id", "contract_amount", "monthly_payment")
    named = contracts.join(products, "product_id")
    # one row per contract with its match counts
    clients = match_counts(s["clients"].select("client_id"), "client_id").withColumnRenamed("n", "clients")
    accounts = match_counts(s["accounts"].select("contract_id"), "contract_id").withColumnRenamed("n", "accounts")
    sized = named.join(clients, "client_id", "left").join(accounts, "contract_id", "left").withColumn(
        "copies", at_least_one("clients") * at_least_one("accounts")
    )
    sums = sized.groupBy(*keys).agg(
        F.count_distinct(F.when(F.col("clients") > 0, F.col("client_id"))).alias("client_count"),
        F.count_distinct("contract_id").alias("contract_count"),
        _sum2(F.col("contract_amount") * F.col("copies")).alias("total_contract_amount"),
        _mean(
            F.sum(F.col("contract_amount") * F.col("copies")),
            F.sum(F.when(F.col("contract_amount").isNotNull(), F.col("copies"))),
        ).alias("avg_contract_amount"),
        _sum2(F.col("monthly_payment") * F.col("copies")).alias("total_monthly_payments"),
    )
    held = (
        s["accounts"].select("contract_id", "account_id").join(named.select("contract_id", *keys), "contract_id")
        .groupBy(*keys).agg(F.count_distinct("account_id").alias("account_count"))
    )
    out = _null_safe(_null_safe(products.select(*keys).distinct(), sums, keys), held, keys)
    counts = ["client_count", "contract_count", "account_count"]
    return out.select(*[F.coalesce(c, F.lit(0)).alias(c) if c in counts else F.col(c) for c in out.columns])


def loan_risk(s: Frames) -> DataFrame:
    """Loans with a contract; a contract held by n rows counts n times, as an inner join does."""
    contracts = match_counts(s["contracts"].select("contract_id"), "contract_id")
    loans = s["loans"].join(contracts, "contract_id")
    n = F.col("n")
    high = F.col("outstanding_balance") > F.col("loan_amount") * F.lit(0.8).cast("decimal(2,1)")
    each = lambda c: F.sum(F.col(c) * n)
    known = lambda c: F.sum(F.when(F.col(c).isNotNull(), n))
    return loans.groupBy("delinquency_status").agg(
        F.sum(n).alias("loan_count"),
        each("loan_amount").cast("decimal(28,2)").alias("total_loan_amount"),
        each("outstanding_balance").cast("decimal(28,2)").alias("total_outstanding"),
        _mean(each("interest_rate"), known("interest_rate")).alias("avg_interest_rate"),
        clean.percent(each("outstanding_balance"), each("loan_amount")).alias("outstanding_percentage"),
        F.round(
            F.try_divide(each("loan_to_value_ratio").cast("decimal(30,3)"), known("loan_to_value_ratio").cast("decimal(20,0)")), 3
        ).alias("avg_ltv"),
        F.coalesce(F.sum(F.when(high, n)), F.lit(0)).alias("high_risk_loans"),
    )


def balance_distribution(s: Frames) -> DataFrame:
    accounts = s["accounts"].where(F.col("status") == "ACTIVE").select("account_id", "account_type", "status")
    balance = F.col("current_balance")
    return accounts.join(s["account_balances"], "account_id").groupBy("account_type", "status").agg(
        F.count("*").alias("account_count"),
        _sum2(balance).alias("total_balance"),
        _avg("current_balance").alias("avg_balance"),
        F.min(balance).alias("min_balance"),
        F.max(balance).alias("max_balance"),
        _sum2("credit_limit").alias("total_credit_limit"),
        F.count_if(balance < 0).alias("negative_balance_count"),
    )


def _account_measures(s: Frames) -> DataFrame:
    """One row per account row with the match counts and sums of its other tables."""
    balances = match_counts(
        s["account_balances"], "account_id",
        bal_sum=F.sum("current_balance"), bal_known=F.count("current_balance"),
    ).withColumnRenamed("n", "bal_n")
    cards = match_counts(s["cards"].select("account_id"), "account_id").withColumnRenamed("n", "card_n")
    moves = match_counts(
        s["transactions"].where(_completed()).select(F.col("from_account_id").alias("account_id"), "amount"),
        "account_id", tx_sum=F.sum("amount"),
    ).withColumnRenamed("n", "tx_n")
    clients = match_counts(s["clients"].select("client_id"), "client_id").withColumnRenamed("n", "client_n")
    accounts = s["accounts"].select("account_id", "client_id", "branch_code")
    return (
        accounts.join(balances, "account_id", "left").join(cards, "account_id", "left")
        .join(moves, "account_id", "left").join(clients, "client_id", "left")
    )


def branch_comparison(s: Frames, fanout_safe: bool = False) -> DataFrame:
    """``fanout_safe`` sums every balance and transaction once instead of once per combination."""
    keys = ["branch_code", "city", "state"]
    one = F.lit(1)
    copies = {
        name: one if fanout_safe else at_least_one(f"{name}_n") for name in ("bal", "card", "tx", "client")
    }
    balance = F.sum(F.col("bal_sum") * copies["card"] * copies["tx"] * copies["client"])
    known = F.sum(F.coalesce("bal_known", F.lit(0)) * copies["card"] * copies["tx"] * copies["client"])
    volume = F.sum(F.col("tx_sum") * copies["bal"] * copies["card"] * copies["client"])
    accounts = _account_measures(s).groupBy("branch_code").agg(
        F.count_distinct("account_id").alias("total_accounts"),
        F.count_distinct(F.when(F.col("client_n") > 0, F.col("client_id"))).alias("total_clients"),
        balance.alias("bal"), known.alias("known"), volume.alias("volume"),
    )
    cards = (
        s["cards"].select("account_id", "card_id")
        .join(s["accounts"].select("account_id", "branch_code"), "account_id")
        .groupBy("branch_code").agg(F.count_distinct("card_id").alias("cards_issued"))
    )
    staff = match_counts(s["employees"].select("branch_id"), "branch_id")
    branches = s["branches"].select("branch_id", *keys)
    places = branches.join(staff, "branch_id", "left").groupBy(*keys).agg(
        (F.count("*") if fanout_safe else F.sum(at_least_one("n"))).alias("copies")
    )
    workers = (
        s["employees"].select("branch_id", "employee_id").join(branches, "branch_id")
        .groupBy(*keys).agg(F.count_distinct("employee_id").alias("total_employees"))
    )
    out = _null_safe(places, workers, keys).join(accounts, "branch_code", "left").join(cards, "branch_code", "left")
    weight = F.col("copies")
    return out.select(
        *keys,
        *[F.coalesce(c, F.lit(0)).alias(c) for c in ("total_accounts", "total_clients", "total_employees")],
        (F.col("bal") * weight).cast("decimal(28,2)").alias("total_deposits"),
        _mean(F.col("bal"), F.col("known")).alias("avg_account_balance"),
        F.coalesce("cards_issued", F.lit(0)).alias("cards_issued"),
        (F.col("volume") * weight).cast("decimal(28,2)").alias("total_transaction_volume"),
    )


def credit_application_stats(s: Frames) -> DataFrame:
    approved = F.count_if(F.col("status") == "APPROVED")
    return s["credit_applications"].groupBy("purpose", "status").agg(
        F.count("*").alias("application_count"),
        _avg("requested_amount").alias("avg_requested_amount"),
        _avg("approved_amount").alias("avg_approved_amount"),
        F.sum("requested_amount").alias("total_requested"),
        F.sum("approved_amount").alias("total_approved"),
        clean.percent(approved, F.count("*")).alias("approval_rate"),
        _avg("interest_rate_proposed").alias("avg_proposed_rate"),
    )


def monthly_clients(s: Frames) -> DataFrame:
    """Rows shrink to month, account and category before the two joins."""
    small = s["transactions"].where(_completed() & F.col("from_account_id").isNotNull()).groupBy(
        F.year("transaction_date").alias("year"), F.month("transaction_date").alias("month"),
        F.col("from_account_id").alias("account_id"), "category",
    ).agg(F.count("*").alias("n"), F.sum("amount").alias("amount"), F.count("amount").alias("amounts"))
    accounts = s["accounts"].select("account_id", "client_id")
    clients = match_counts(s["clients"].select("client_id"), "client_id").withColumnRenamed("n", "copies")
    c = F.col("copies")
    return small.join(accounts, "account_id").join(clients, "client_id").groupBy("year", "month").agg(
        F.count_distinct("account_id").alias("active_accounts"),
        F.count_distinct("client_id").alias("active_clients"),
        F.sum(F.col("n") * c).alias("total_transactions"),
        _sum2(F.col("amount") * c).alias("transaction_volume"),
        _mean(F.sum(F.col("amount") * c), F.sum(F.col("amounts") * c)).alias("avg_transaction_size"),
        F.count_distinct("category").alias("unique_categories"),
    )


def segmentation(s: Frames) -> DataFrame:
    keys = ["risk_category", "employment_status", "income_segment"]
    balances = match_counts(
        s["account_balances"], "account_id", bal_sum=F.sum("current_balance"), bal_known=F.count("current_balance")
    ).withColumnRenamed("n", "bal_n")
    accounts = (
        s["accounts"].where(F.col("client_id").isNotNull()).select("account_id", "client_id")
        .join(balances, "account_id", "left").groupBy("client_id")
        .agg(
            F.sum(at_least_one("bal_n")).alias("account_rows"),
            F.sum("bal_sum").alias("bal_sum"),
            F.sum("bal_known").alias("bal_known"),
        )
    )
    late = F.col("delinquency_status").startswith("DELINQUENT")
    loans = match_counts(s["loans"], "contract_id", late=F.count_if(late)).withColumnRenamed("n", "loan_n")
    contracts = (
        s["contracts"].where(F.col("client_id").isNotNull()).select("contract_id", "client_id")
        .join(loans, "contract_id", "left").groupBy("client_id")
        .agg(F.sum(at_least_one("loan_n")).alias("contract_rows"), F.sum("late").alias("late"))
    )
    clients = s["clients"].select(
        "client_id", "risk_category", "employment_status", clean.income_segment("annual_income").alias("income_segment"),
        "credit_score", "annual_income",
    )
    a, k = at_least_one("account_rows"), at_least_one("contract_rows")
    rows = a * k
    sized = clients.join(accounts, "client_id", "left").join(contracts, "client_id", "left")
    weighted = lambda c: _mean(F.sum(F.col(c) * rows), F.sum(F.when(F.col(c).isNotNull(), rows)))
    sums = sized.groupBy(*keys).agg(
        F.sum(rows).alias("client_count"),
        weighted("credit_score").alias("avg_credit_score"),
        weighted("annual_income").alias("avg_income"),
        _mean(F.sum(F.col("bal_sum") * k), F.sum(F.col("bal_known") * k)).alias("avg_balance"),
        F.coalesce(F.sum(F.col("late") * a), F.lit(0)).alias("delinquent_loans"),
    )
    grouped = clients.select("client_id", *keys)
    held = (
        s["accounts"].select("client_id", "account_id").join(grouped, "client_id")
        .groupBy(*keys).agg(F.count_distinct("account_id").alias("accounts_per_client"))
    )
    lent = (
        s["loans"].select("contract_id", "loan_id").join(s["contracts"].select("contract_id", "client_id"), "contract_id")
        .join(grouped, "client_id").groupBy(*keys).agg(F.count_distinct("loan_id").alias("total_loans"))
    )
    out = _null_safe(_null_safe(sums, held, keys), lent, keys)
    return out.select(
        *[F.coalesce(c, F.lit(0)).alias(c) if c in ("accounts_per_client", "total_loans") else F.col(c) for c in out.columns]
    )


def card_usage(s: Frames) -> DataFrame:
    keys = ["card_type", "card_level", "card_status"]
    clients = match_counts(
        s["clients"].select("client_id", "credit_score"), "client_id",
        score_sum=F.sum("credit_score"), score_known=F.count("credit_score"),
    ).withColumnRenamed("n", "client_n")
    accounts = match_counts(s["accounts"].select("account_id"), "account_id").withColumnRenamed("n", "acc_n")
    balances = match_counts(
        s["account_balances"], "account_id", limit_sum=F.sum("credit_limit"), bal_sum=F.sum("current_balance")
    ).withColumnRenamed("n", "bal_n")
    moves = s["transactions"].where(F.col("from_account_id").isNotNull()).withColumnRenamed("from_account_id", "account_id")
    spent = F.when(_completed(), F.col("amount"))
    used = match_counts(
        moves, "account_id", tx_sum=F.sum(spent), tx_known=F.count(spent),
        other=F.count_if(~clean.is_true(_completed())),
    ).withColumnRenamed("n", "tx_n")
    cards = (
        s["cards"].select("card_id", "client_id", "account_id", "card_type", "card_level", F.col("status").alias("card_status"))
        .join(clients, "client_id").join(accounts, "account_id").join(balances, "account_id").join(used, "account_id", "left")
    )
    c, a, b, t = F.col("client_n"), F.col("acc_n"), F.col("bal_n"), at_least_one("tx_n")
    # a COMPLETED sum is 0, not missing, once a row without a COMPLETED transaction is summed
    settled = F.coalesce("tx_sum", F.when(F.col("tx_n").isNull() | (F.col("other") > 0), F.lit(0)))
    sums = cards.groupBy(*keys).agg(
        F.count_distinct("card_id").alias("card_count"),
        F.count_distinct("client_id").alias("unique_clients"),
        _mean(F.sum(F.col("score_sum") * a * b * t), F.sum(F.col("score_known") * a * b * t)).alias("avg_client_credit_score"),
        _sum2(F.col("limit_sum") * c * a * t).alias("total_credit_limit"),
        _sum2(F.col("bal_sum") * c * a * t).alias("total_balance"),
        _sum2(settled * c * a * b).alias("total_spent"),
        _mean(F.sum(F.col("tx_sum") * c * a * b), F.sum(F.col("tx_known") * c * a * b)).alias("avg_transaction_amount"),
    )
    kinds = cards.select("account_id", *keys).distinct()
    ids = moves.where(F.col("transaction_id").isNotNull()).select("account_id", "transaction_id").distinct()
    groups = moves.where(F.col("category").isNotNull()).select("account_id", "category").distinct()
    n_ids = ids.join(kinds, "account_id").groupBy(*keys).agg(F.count_distinct("transaction_id").alias("total_transactions"))
    n_groups = groups.join(kinds, "account_id").groupBy(*keys).agg(F.count_distinct("category").alias("spending_categories"))
    out = _null_safe(_null_safe(sums, n_ids, keys), n_groups, keys)
    return out.select(
        *[F.coalesce(x, F.lit(0)).alias(x) if x in ("total_transactions", "spending_categories") else F.col(x) for x in out.columns]
    )


# --- over gold ------------------------------------------------------------------


def volume_by_segment(g: Frames, year: int, month: int) -> DataFrame:
    fact = g["fact_transactions_daily"].where((F.col("year") == year) & (F.col("month") == month))
    # shrink to the join key first: a client with many rows crosses the shuffle once per day and type
    small = fact.groupBy("client_id", "transaction_type", "transaction_date").agg(
        F.sum("transaction_count").alias("n"), F.sum("total_amount").alias("amount"),
        F.sum("avg_amount").alias("avg_sum"), F.count("avg_amount").alias("avg_n"),
        F.sum("success_rate").alias("rate_sum"), F.count("success_rate").alias("rate_n"),
    )
    clients = g["dim_client"].select("client_id", "client_segment")
    return small.join(clients, "client_id").groupBy("client_segment", "transaction_type", "transaction_date").agg(
        F.sum("n").alias("total_transactions"),
        _sum2("amount").alias("total_volume"),
        _mean(F.sum("avg_sum"), F.sum("avg_n")).alias("avg_transaction_size"),
        _mean(F.sum("rate_sum"), F.sum("rate_n")).alias("avg_success_rate"),
    )


def top_branches(g: Frames, k: int = 10) -> DataFrame:
    b = g["branch_performance_dashboard"].where(F.col("total_employees") > 0)
    return b.select(
        "branch_id", "branch_name", "region", "total_employees", "active_employees", "total_clients", "total_accounts",
        "total_deposits", "total_loans_issued", F.round("total_revenue_mtd", 2).alias("revenue_mtd"),
        F.col("avg_account_balance").alias("avg_balance"),
        clean.exact_ratio("total_deposits", "total_employees").alias("deposits_per_employee"), "total_revenue_mtd",
    ).orderBy(F.desc("total_revenue_mtd"), "branch_id").limit(k).drop("total_revenue_mtd")


def vip_360(g: Frames, k: int = 20) -> DataFrame:
    v = g["client_360_view"].where(F.col("client_segment") == "VIP")
    return v.orderBy(F.desc("total_balance"), "client_id").limit(k).select(
        "client_id", "full_name", "client_segment", "age", "city", "credit_score", "credit_score_category",
        "total_accounts", "active_accounts", "total_balance", "total_cards", "active_cards", "total_loans", "active_loans",
        "total_loan_amount", F.col("total_outstanding_balance").alias("outstanding_balance"), "transactions_30d",
        F.col("transaction_volume_30d").alias("volume_30d"), "days_since_last_transaction", "channel_preference",
    )


def product_compare(g: Frames) -> DataFrame:
    return g["product_performance_summary"].select(
        "product_id", "product_name", "product_type", "product_category", "total_clients", "active_clients",
        "total_contracts", "active_contracts", "total_contract_value", "avg_contract_value",
        F.round("total_revenue_mtd", 2).alias("revenue_mtd"), F.round("total_revenue_ytd", 2).alias("revenue_ytd"),
        "retention_rate", "client_growth_rate",
    )


def balance_trends(g: Frames, year: int, month: int) -> DataFrame:
    f = g["fact_account_balance_daily"].where((F.col("year") == year) & (F.col("month") == month))
    return f.groupBy("snapshot_date", "account_type", "branch_code").agg(
        F.count_distinct("account_id").alias("account_count"),
        _sum2("current_balance").alias("total_balance"),
        _avg("current_balance").alias("avg_balance"),
        _sum2("available_balance").alias("total_available"),
        _avg("credit_utilization").alias("avg_credit_utilization"),
        _sum2("balance_change_daily").alias("daily_change"),
    )


def segment_summary(g: Frames) -> DataFrame:
    return g["client_360_view"].groupBy("client_segment").agg(
        F.count("*").alias("client_count"),
        F.round(clean.exact_ratio(F.sum("credit_score"), F.count("credit_score"), 6), 0).alias("avg_credit_score"),
        _avg("total_balance").alias("avg_balance"),
        clean.exact_ratio(F.sum("transactions_30d"), F.count("transactions_30d"), 1).alias("avg_monthly_transactions"),
    )


def monthly_volume(g: Frames, k: int = 12) -> DataFrame:
    return g["fact_transactions_daily"].groupBy("year", "month").agg(
        F.sum("transaction_count").alias("total_transactions"),
        _sum2("total_amount").alias("total_volume"),
        _avg("avg_amount").alias("avg_transaction_amount"),
    ).orderBy(F.desc("year"), F.desc("month")).limit(k)


def product_top(g: Frames, k: int = 10) -> DataFrame:
    return g["product_performance_summary"].orderBy(F.desc("total_contract_value"), "product_id").limit(k).select(
        "product_id", "product_name", "product_type", "total_clients", "active_clients",
        F.col("total_contract_value").alias("total_value"), F.round("total_revenue_mtd", 2).alias("monthly_revenue"),
    )


def branch_top(g: Frames, k: int = 10) -> DataFrame:
    return g["branch_performance_dashboard"].orderBy("revenue_rank", "branch_id").limit(k).select(
        "branch_id", "branch_name", "city", "total_accounts", "total_clients", "total_deposits",
        F.col("revenue_rank").alias("performance_rank"),
    )


def suspicious_total(silver_transactions: DataFrame) -> DataFrame:
    return silver_transactions.where("is_suspicious").agg(
        F.count("*").alias("total_suspicious"),
        _sum2("amount").alias("total_suspicious_amount"),
        _avg("amount").alias("avg_suspicious_amount"),
    )
