"""Banking stage tables seen through the benchmark tables.

Each table is a projection whose expressions are plain SQL, valid in Spark and
in the checking engine alike. No row of the source is left out. Codes come in
mixed case and padding, and some keys, amounts and dates are missing on
purpose, so that the cleaning rules have work to do.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.ledger import ledger_balance

AS_OF = dt.date(2001, 11, 5)
EVENTS_AS_OF = dt.date(2024, 1, 31)
RUN_TS = dt.datetime(2001, 11, 5, 6, 0, 0)

STAGE_TABLES = [
    "clients", "products", "contracts", "accounts", "client_products", "transactions",
    "account_balances", "cards", "branches", "employees", "loans", "credit_applications",
]

CLIENTS = {
    "client_id": "c_custkey",
    "first_name": "CASE WHEN c_custkey % 23 = 0 THEN NULL ELSE '  First' || (c_custkey % 300) END",
    "last_name": "CASE WHEN c_custkey % 29 = 0 THEN NULL ELSE 'Last' || c_custkey || ' ' END",
    "email": "CASE WHEN c_custkey % 17 = 0 THEN NULL"
             " WHEN c_custkey % 19 = 0 THEN 'user' || c_custkey || '.example.com'"
             " WHEN c_custkey % 31 = 0 THEN 'User' || c_custkey || '@@Example.com'"
             " WHEN c_custkey % 37 = 0 THEN 'user' || c_custkey || '@'"
             " ELSE 'User' || c_custkey || '@Mail' || (c_custkey % 4) || '.Example.com' END",
    "phone": "CASE WHEN c_custkey % 13 = 0 THEN NULL"
             " WHEN c_custkey % 7 = 0 THEN '00' || (1000000000 + c_custkey)"
             " ELSE '(555) ' || (100 + c_custkey % 900) || '-' || (1000 + c_custkey % 9000) END",
    "birth_date": "CASE WHEN c_custkey % 47 = 0 THEN NULL"
                  " ELSE DATE '1930-01-01' + CAST(c_custkey * 7919 % 26000 AS INT) END",
    "registration_date": "CASE WHEN c_custkey % 53 = 0 THEN NULL"
                         " ELSE DATE '1995-01-01' + CAST(c_custkey * 31 % 2500 AS INT) END",
    "address": "CASE WHEN c_custkey % 11 = 0 THEN NULL ELSE ' ' || c_custkey || ' Main St ' END",
    "city": "CASE WHEN c_custkey % 59 = 0 THEN NULL ELSE n_name || ' ' END",
    "country": "CASE c_nationkey % 8 WHEN 0 THEN 'US' WHEN 1 THEN 'uk' WHEN 2 THEN 'DE' WHEN 3 THEN 'FR '"
               " WHEN 4 THEN ' it' WHEN 5 THEN 'ES' WHEN 6 THEN 'BR' ELSE 'us ' END",
    "risk_category": "CASE c_custkey % 3 WHEN 0 THEN 'low' WHEN 1 THEN 'MEDIUM' ELSE ' High ' END",
    "credit_score": "CASE WHEN c_custkey % 41 = 0 THEN NULL"
                    " ELSE CAST(250 + c_custkey * 7919 % 651 AS INT) END",
    "employment_status": "CASE c_mktsegment WHEN 'BUILDING' THEN 'EMPLOYED' WHEN 'AUTOMOBILE' THEN 'self_employed'"
                         " WHEN 'MACHINERY' THEN 'EMPLOYED ' WHEN 'HOUSEHOLD' THEN 'RETIRED'"
                         " ELSE 'UNEMPLOYED' END",
    "annual_income": "CASE WHEN c_custkey % 43 = 0 THEN NULL"
                     " ELSE CAST(round(c_acctbal * 100) * 25 / 100 AS DECIMAL(12,2)) END",
}
PRODUCTS = {
    "product_id": "p_partkey",
    "product_name": "' ' || p_name",
    "product_type": "CASE p_type WHEN 'ECONOMY' THEN 'CARD' WHEN 'SMALL' THEN 'loan' WHEN 'MEDIUM' THEN 'DEPOSIT '"
                    " WHEN 'PROMO' THEN 'INVESTMENT' WHEN 'STANDARD' THEN 'ACCOUNT' ELSE 'Mortgage' END",
    "currency": "CASE WHEN p_partkey % 2 = 0 THEN 'usd' ELSE 'USD ' END",
    "active": "CASE WHEN p_partkey % 33 = 0 THEN NULL ELSE p_partkey % 10 <> 0 END",
}
CONTRACTS = {
    "contract_id": "o_orderkey",
    "client_id": "o_custkey",
    "product_id": "product_id",
    "contract_number": "' CN-' || o_orderkey",
    "start_date": "CAST(o_orderdate AS DATE)",
    "end_date": "CASE WHEN o_orderkey % 5 = 0 THEN NULL"
                " ELSE CAST(o_orderdate AS DATE) + CAST(o_orderkey % 2000 AS INT) END",
    "contract_amount": "CAST(o_totalprice AS DECIMAL(12,2))",
    "interest_rate": "CAST(CAST(o_orderkey % 1500 AS DOUBLE) / 100 AS DECIMAL(5,2))",
    "status": "CASE WHEN o_orderstatus = 'P' THEN 'active' WHEN o_orderstatus = 'O' THEN 'PENDING'"
              " WHEN o_orderkey % 3 = 0 THEN 'CLOSED' WHEN o_orderkey % 3 = 1 THEN 'TERMINATED '"
              " WHEN o_orderkey % 4 = 0 THEN 'lost' ELSE ' Frozen' END",
    "monthly_payment": "CAST(floor(round(o_totalprice * 100) / 36) / 100 AS DECIMAL(12,2))",
    "created_date": "CAST(o_orderdate AS DATE) + CAST(o_orderkey % 97 AS INT)",
}
ACCOUNTS = {
    "account_id": "o_orderkey",
    "client_id": "o_custkey",
    "contract_id": "o_orderkey",
    "account_number": "' ACC' || o_orderkey",
    "account_type": "CASE o_orderkey % 7 WHEN 0 THEN 'SAVINGS' WHEN 1 THEN 'checking' WHEN 2 THEN 'CREDIT'"
                    " WHEN 3 THEN ' LOAN' WHEN 4 THEN 'DEPOSIT' WHEN 5 THEN 'INV' ELSE 'other' END",
    "currency": "CASE WHEN o_orderkey % 4 = 0 THEN 'eur' ELSE 'USD' END",
    "open_date": "CAST(o_orderdate AS DATE) + CAST(o_orderkey % 97 AS INT)",
    "close_date": "CASE WHEN o_orderkey % 9 = 0"
                  " THEN CAST(o_orderdate AS DATE) + CAST(o_orderkey % 1500 AS INT) END",
    "status": "CASE o_orderkey % 8 WHEN 0 THEN 'CLOSED' WHEN 1 THEN 'BLOCKED' WHEN 2 THEN 'dormant '"
              " WHEN 3 THEN 'open' WHEN 4 THEN ' active' ELSE 'ACTIVE' END",
    "branch_code": "'BR' || (o_orderkey % 120)",
}
# one row per (o_custkey, l_partkey), with the first l_shipdate as first_ship
CLIENT_PRODUCTS = {
    "relationship_id": "o_custkey * 1000000000 + l_partkey",
    "client_id": "o_custkey",
    "product_id": "l_partkey",
    "relationship_type": "CASE (o_custkey + l_partkey) % 4 WHEN 0 THEN 'OWNER' WHEN 1 THEN 'co_owner'"
                         " WHEN 2 THEN 'AUTHORIZED_USER ' ELSE 'BENEFICIARY' END",
    "start_date": "CAST(first_ship AS DATE)",
    "end_date": "CASE WHEN (o_custkey + l_partkey) % 3 = 0"
                " THEN CAST(first_ship AS DATE) + CAST((o_custkey * 7 + l_partkey) % 900 AS INT) END",
    "status": "CASE (o_custkey * 3 + l_partkey) % 5 WHEN 0 THEN 'CLOSED' WHEN 1 THEN 'active ' ELSE 'ACTIVE' END",
}
TRANSACTIONS = {
    "transaction_id": "l_orderkey * 10 + l_linenumber",
    "transaction_uuid": "' TX-' || l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey"
                        " || '-' || CAST(CAST(l_shipdate AS DATE) AS STRING)",
    "from_account_id": "CASE WHEN l_partkey % 41 = 0 THEN NULL"
                       " WHEN l_partkey % 43 = 0 THEN l_orderkey + 100000000000 ELSE l_orderkey END",
    "to_account_id": "CASE WHEN l_linenumber % 2 = 0 THEN l_partkey END",
    "from_account_number": "'ACC' || l_orderkey || ' '",
    "to_account_number": "CASE WHEN l_linenumber % 2 = 0 THEN ' ACC' || l_partkey END",
    "transaction_type": "CASE l_linenumber WHEN 1 THEN 'DEPOSIT' WHEN 2 THEN ' transfer ' WHEN 3 THEN 'PMT'"
                        " WHEN 4 THEN 'Withdrawal' WHEN 5 THEN 'fee' WHEN 6 THEN 'PURCHASE' ELSE 'CREDIT' END",
    "amount": "CASE WHEN l_partkey % 97 = 0 THEN NULL WHEN l_partkey % 101 = 0 THEN CAST(0 AS DECIMAL(12,2))"
              " WHEN l_suppkey % 13 = 0 THEN CAST(-floor(round(l_extendedprice * 100) / 10) / 100 AS DECIMAL(12,2))"
              " ELSE CAST(floor(round(l_extendedprice * 100) / 10) / 100 AS DECIMAL(12,2)) END",
    "currency": "CASE l_suppkey % 3 WHEN 0 THEN 'USD' WHEN 1 THEN 'eur ' ELSE 'usd' END",
    "transaction_date": "CASE WHEN l_partkey % 211 = 0 THEN NULL"
                        " ELSE l_shipdate + CAST(l_partkey % 24 AS INT) * INTERVAL '1' HOUR END",
    "description": "' Order ' || l_orderkey",
    "status": "CASE WHEN l_returnflag = 'A' AND l_linenumber = 3 THEN ' success' WHEN l_returnflag = 'A' THEN 'COMPLETED'"
              " WHEN l_returnflag = 'N' AND l_linestatus = 'F' THEN 'pending ' WHEN l_returnflag = 'N' THEN 'COMPLETED'"
              " WHEN l_linestatus = 'F' THEN 'FAILED' WHEN l_linenumber = 7 THEN 'unknown' ELSE 'CANCELLED' END",
    "category": "CASE l_partkey % 11 WHEN 0 THEN 'FOOD' WHEN 1 THEN 'Transport' WHEN 2 THEN 'ENTERTAINMENT '"
                " WHEN 3 THEN 'BILLS' WHEN 4 THEN 'SHOPPING' WHEN 5 THEN 'SALARY' WHEN 6 THEN 'Restaurant'"
                " WHEN 7 THEN 'HEALTH' WHEN 8 THEN 'ins' WHEN 9 THEN 'misc' ELSE 'OTHER' END",
    "merchant_name": "CASE WHEN l_suppkey % 5 = 0 THEN NULL ELSE ' Merchant ' || l_suppkey END",
}
# over the rows of the ledger
ACCOUNT_BALANCES = {
    "balance_id": "account_id + 1",
    "account_id": "account_id",
    "current_balance": "current_balance",
    "available_balance": "CAST(current_balance - CAST(account_id % 500 AS DECIMAL(12,2)) AS DECIMAL(14,2))",
    "currency": "CASE WHEN account_id % 4 = 0 THEN 'eur' ELSE ' USD' END",
    "last_updated": "last_updated",
    "credit_limit": "CASE WHEN account_id % 31 = 0 THEN NULL WHEN account_id % 7 = 2"
                    " THEN CAST(1000 + account_id % 24000 AS DECIMAL(12,2)) ELSE CAST(0 AS DECIMAL(12,2)) END",
}
OPENING_BALANCE = "CAST(100 + account_id * 37 % 49900 AS DECIMAL(12,2))"
CARDS = {
    "card_id": "o_orderkey",
    "client_id": "o_custkey",
    "account_id": "o_orderkey - o_orderkey % 3",
    "card_number": "CAST(4000000000000000 + o_orderkey * 7919 AS STRING)",
    "card_holder_name": "' Holder ' || o_custkey",
    "expiry_date": "CASE WHEN o_orderkey % 61 = 0 THEN NULL"
                   " ELSE CAST(o_orderdate AS DATE) + CAST(o_orderkey % 1826 AS INT) END",
    "cvv": "CAST(100 + o_orderkey % 900 AS INT)",
    "card_type": "CASE o_orderkey % 3 WHEN 0 THEN 'debit' WHEN 1 THEN 'CREDIT' ELSE ' Prepaid' END",
    "card_level": "CASE o_orderkey % 4 WHEN 0 THEN 'standard' WHEN 1 THEN 'GOLD' ELSE 'Platinum ' END",
    "status": "CASE o_orderkey % 6 WHEN 0 THEN 'BLOCKED' WHEN 1 THEN 'expired' WHEN 2 THEN 'LOST'"
              " WHEN 3 THEN 'closed' ELSE 'ACTIVE' END",
    "issue_date": "CAST(o_orderdate AS DATE)",
}
BRANCHES = {
    "branch_id": "s_suppkey",
    "branch_code": "CASE WHEN s_suppkey % 10 = 9 THEN ' br' || s_suppkey ELSE 'BR' || s_suppkey END",
    "branch_name": "s_name || ' Branch '",
    "address": "' ' || s_suppkey || ' High St'",
    "city": "n_name",
    "state": "CASE s_nationkey % 10 WHEN 0 THEN 'California' WHEN 1 THEN 'TX' WHEN 2 THEN 'new york' WHEN 3 THEN 'Florida'"
             " WHEN 4 THEN 'Illinois ' WHEN 5 THEN 'Nevada' WHEN 6 THEN 'WA' WHEN 7 THEN 'oh' WHEN 8 THEN 'PA'"
             " ELSE 'Texas' END",
    "zip_code": "' ' || (10000 + s_suppkey % 90000)",
    "phone": "'(657)828-' || (1000 + s_suppkey % 9000) || 'x3209'",
    "manager_name": "' Manager ' || s_suppkey",
    "opening_date": "DATE '1970-01-01' + CAST(s_suppkey * 97 % 9000 AS INT)",
}
EMPLOYEES = {
    "employee_id": "c_custkey",
    "branch_id": "branch_id",
    "first_name": "' Emp' || (c_custkey % 50)",
    "last_name": "CASE WHEN c_custkey % 71 = 0 THEN NULL ELSE 'Worker' || c_custkey END",
    "email": "CASE WHEN c_custkey % 29 = 0 THEN 'no-mail' ELSE ' E' || c_custkey || '@Bank.Example.com' END",
    "phone": "'+1-' || (200 + c_custkey % 700) || '-555-' || (1000 + c_custkey % 9000)",
    "position": "CASE c_custkey % 4 WHEN 0 THEN 'teller' WHEN 1 THEN 'Manager ' WHEN 2 THEN 'ANALYST' ELSE 'officer' END",
    "department": "CASE c_custkey % 3 WHEN 0 THEN 'Retail' WHEN 1 THEN ' LOANS' ELSE 'operations' END",
    "hire_date": "DATE '1985-01-01' + CAST(c_custkey * 53 % 6000 AS INT)",
    "salary": "CASE WHEN c_custkey % 67 = 0 THEN NULL"
              " ELSE CAST(25000 + round(c_acctbal * 100) * 12 / 100 AS DECIMAL(12,2)) END",
    "status": "CASE c_custkey % 5 WHEN 0 THEN 'INACTIVE' WHEN 1 THEN 'suspended' WHEN 2 THEN ' active' ELSE 'ACTIVE' END",
}
LOANS = {
    "loan_id": "o_orderkey",
    "contract_id": "CASE WHEN o_orderkey % 50 = 0 THEN o_orderkey + 100000000000"
                   " ELSE o_orderkey - o_orderkey % 2 END",
    "loan_amount": "CAST(o_totalprice AS DECIMAL(12,2))",
    "outstanding_balance": "CAST(floor(round(o_totalprice * 100) * (o_orderkey % 100) / 100) / 100 AS DECIMAL(12,2))",
    "interest_rate": "CAST(CAST(o_orderkey % 1200 AS DOUBLE) / 100 AS DECIMAL(5,2))",
    "term_months": "CAST(12 + o_orderkey % 349 AS INT)",
    "remaining_months": "CAST(o_orderkey % 12 AS INT)",
    "next_payment_date": "CASE WHEN o_orderkey % 83 = 0 THEN NULL"
                         " ELSE DATE '2001-11-01' + CAST(o_orderkey % 60 AS INT) END",
    "next_payment_amount": "CAST(floor(round(o_totalprice * 100) / 48) / 100 AS DECIMAL(12,2))",
    "delinquency_status": "CASE o_orderkey % 9 WHEN 0 THEN NULL WHEN 1 THEN 'DELINQUENT_30' WHEN 2 THEN 'delinquent_60'"
                          " WHEN 3 THEN 'DELINQUENT_90+' WHEN 4 THEN 'none' WHEN 5 THEN ' current' ELSE 'CURRENT' END",
    "collateral_value": "CAST(o_totalprice AS DECIMAL(12,2)) + CAST(o_orderkey % 9000 AS DECIMAL(12,2))",
    "loan_to_value_ratio": "CASE WHEN o_orderkey % 91 = 0 THEN NULL"
                           " ELSE CAST(CAST(o_orderkey % 1200 AS DOUBLE) / 1000 AS DECIMAL(4,3)) END",
}
CREDIT_APPLICATIONS = {
    "application_id": "o_orderkey",
    "client_id": "o_custkey",
    "application_date": "CAST(o_orderdate AS DATE)",
    "requested_amount": "CASE WHEN o_orderkey % 77 = 0 THEN 0 ELSE CAST(floor(o_totalprice) AS INT) END",
    "approved_amount": "CASE WHEN o_orderkey % 8 < 3 THEN CAST(floor(round(o_totalprice * 100) * (50 + o_orderkey % 51)"
                       " / 10000) AS INT) END",
    "purpose": "CASE o_orderpriority WHEN '1-URGENT' THEN 'home' WHEN '2-HIGH' THEN 'CAR ' WHEN '3-MEDIUM' THEN 'Education'"
               " WHEN '5-LOW' THEN 'travel' ELSE 'BUSINESS' END",
    "status": "CASE o_orderkey % 8 WHEN 0 THEN 'APPROVED' WHEN 1 THEN 'accepted' WHEN 2 THEN 'APPROVED'"
              " WHEN 3 THEN 'Rejected' WHEN 4 THEN 'DENIED' WHEN 5 THEN 'under_review' WHEN 6 THEN 'CANCELLED '"
              " ELSE 'new' END",
    "decision_date": "CASE WHEN o_orderkey % 8 IN (5, 7) THEN NULL"
                     " ELSE CAST(o_orderdate AS DATE) + CAST(o_orderkey % 45 AS INT) END",
    "interest_rate_proposed": "CAST(CAST(300 + o_orderkey % 900 AS DOUBLE) / 100 AS DECIMAL(5,2))",
    "reason_for_rejection": "CASE WHEN NOT (o_orderkey % 8 IN (3, 4)) THEN NULL WHEN o_orderkey % 5 = 0 THEN ' Low credit score'"
                            " WHEN o_orderkey % 5 = 1 THEN 'Insufficient income' WHEN o_orderkey % 5 = 2 THEN 'High debt'"
                            " WHEN o_orderkey % 5 = 3 THEN 'employment history' ELSE 'policy' END",
    "officer_id": "o_custkey",
}
# from events -------------------------------------------------------------
AUDIT_LOG = {
    "query_id": "event_id",
    "query_date": "CAST(ts AS DATE)",
    "query_time": "ts",
    "username": "'user' || user_id",
    "service_name": "CASE WHEN user_id % 4 = 0 THEN 'SPARK' ELSE 'HIVE' END",
    "database_name": "CASE event_type WHEN 'view' THEN 'gold' WHEN 'click' THEN 'silver' ELSE 'bronze' END",
    "table_name": "CASE event_type WHEN 'view' THEN 'client_360_view' WHEN 'click' THEN 'clients'"
                  " WHEN 'purchase' THEN 'transactions' WHEN 'signup' THEN 'credit_applications' ELSE 'branches' END",
    "operation_type": "CASE event_type WHEN 'purchase' THEN 'INSERT' WHEN 'signup' THEN 'ALTER' ELSE 'SELECT' END",
    "query_text": "event_type || ' ' || props",
    "rows_read": "CAST(floor(round(value * 100)) AS BIGINT)",
    "rows_written": "CASE WHEN event_type = 'purchase' THEN CAST(floor(value) AS BIGINT) ELSE 0 END",
    "execution_time_ms": "CAST(floor(round(value * 100) / 7) AS BIGINT)",
    "client_ip_address": "'10.0.' || (user_id % 250) || '.' || (event_id % 250)",
    "status": "CASE WHEN event_type = 'error' THEN 'FAILED' ELSE 'SUCCESS' END",
    "access_result": "CASE WHEN event_type = 'error' THEN 'DENIED' ELSE 'ALLOWED' END",
    "policy_id": "user_id % 6",
}
USER_DIRECTORY = {
    "username": "'user' || user_id",
    "full_name": "'User Number ' || user_id",
    "department": "CASE user_id % 4 WHEN 0 THEN 'IT' WHEN 1 THEN 'RISK' WHEN 2 THEN 'RETAIL' ELSE 'AUDIT' END",
    "role": "CASE user_id % 3 WHEN 0 THEN 'analyst' WHEN 1 THEN 'engineer' ELSE 'manager' END",
}
RESOURCE_METRICS = {
    "query_id": "event_id",
    "cpu_seconds": "CAST(floor(round(value * 100) / 10) AS BIGINT)",
    "memory_gb_seconds": "CAST(floor(round(value * 100) / 25) AS BIGINT)",
}
PREDICTION_LOG = {
    "request_id": "event_id",
    "model_name": "CASE WHEN user_id % 2 = 0 THEN 'fraud_detection' ELSE 'credit_risk' END",
    "model_version": "CASE WHEN user_id % 3 = 0 THEN 'v2' ELSE 'v1' END",
    "prediction_confidence": "CAST(CAST(event_id * 7919 % 1001 AS DOUBLE) / 1000 AS DECIMAL(5,3))",
    "latency_ms": "CAST(value AS DECIMAL(12,2))",
    "actual_fraud": "CASE WHEN event_type = 'error' THEN 1 ELSE 0 END",
    "predicted_fraud": "CASE WHEN event_id % 10 = 0 THEN 1 ELSE 0 END",
    "prediction_error": "CASE WHEN event_type = 'error' AND event_id % 3 = 0 THEN 1 ELSE 0 END",
    "prediction_timestamp": "ts",
    "prediction_date": "CAST(ts AS DATE)",
}


def _project(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    return df.select(*[F.expr(sql).alias(name) for name, sql in columns.items()])


class Stage:
    """The stage layer over one folder of benchmark tables."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")

    def source(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def table(self, name: str) -> DataFrame:
        return getattr(self, f"_{name}")()

    def _clients(self):
        nation = self.source("nation").select("n_nationkey", "n_name")
        joined = self.source("customer").join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        return _project(joined, CLIENTS)

    def _products(self):
        return _project(self.source("part"), PRODUCTS)

    def _contracts(self):
        n_products = self.source("part").agg(F.count("*")).scalar()
        orders = self.source("orders").withColumn("product_id", F.col("o_orderkey") % n_products)
        return _project(orders, CONTRACTS)

    def _accounts(self):
        return _project(self.source("orders"), ACCOUNTS)

    def _client_products(self):
        orders = self.source("orders").select("o_orderkey", "o_custkey")
        lines = self.source("lineitem").select("l_orderkey", "l_partkey", "l_shipdate")
        pairs = (
            lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
            .groupBy("o_custkey", "l_partkey")
            .agg(F.min("l_shipdate").alias("first_ship"))
        )
        return _project(pairs, CLIENT_PRODUCTS)

    def _transactions(self):
        return _project(self.source("lineitem"), TRANSACTIONS)

    def _account_balances(self):
        accounts = self._accounts().select(
            "account_id", "account_type", "open_date", F.expr(OPENING_BALANCE).alias("opening_balance")
        )
        return _project(ledger_balance(accounts, self._transactions()), ACCOUNT_BALANCES)

    def _cards(self):
        return _project(self.source("orders"), CARDS)

    def _branches(self):
        nation = self.source("nation").select("n_nationkey", "n_name")
        joined = self.source("supplier").join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
        return _project(joined, BRANCHES)

    def _employees(self):
        n_branches = self.source("supplier").agg(F.count("*")).scalar()
        staff = self.source("customer").withColumn("branch_id", F.col("c_custkey") % n_branches)
        return _project(staff, EMPLOYEES)

    def _loans(self):
        return _project(self.source("orders"), LOANS)

    def _credit_applications(self):
        return _project(self.source("orders"), CREDIT_APPLICATIONS)

    def _audit_log(self):
        return _project(self.source("events"), AUDIT_LOG)

    def _user_directory(self):
        return _project(self.source("events").select("user_id").distinct(), USER_DIRECTORY)

    def _resource_metrics(self):
        return _project(self.source("events"), RESOURCE_METRICS)

    def _prediction_log(self):
        return _project(self.source("events"), PREDICTION_LOG)
