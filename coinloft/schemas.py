"""Declared columns of the twelve source tables. Names, order and
types are the contract of the input files. Keys are 64-bit, as row counts at
scale do not fit 32 bits."""

from __future__ import annotations

from pyspark.sql import types as T

DDL = {
    "clients": (
        "client_id BIGINT, first_name STRING, last_name STRING, email STRING, phone STRING, birth_date DATE,"
        " registration_date DATE, address STRING, city STRING, country STRING, risk_category STRING,"
        " credit_score INT, employment_status STRING, annual_income DECIMAL(12,2)"
    ),
    "products": "product_id BIGINT, product_name STRING, product_type STRING, currency STRING, active BOOLEAN",
    "contracts": (
        "contract_id BIGINT, client_id BIGINT, product_id BIGINT, contract_number STRING, start_date DATE,"
        " end_date DATE, contract_amount DECIMAL(12,2), interest_rate DECIMAL(5,2), status STRING,"
        " monthly_payment DECIMAL(12,2), created_date DATE"
    ),
    "accounts": (
        "account_id BIGINT, client_id BIGINT, contract_id BIGINT, account_number STRING, account_type STRING,"
        " currency STRING, open_date DATE, close_date DATE, status STRING, branch_code STRING"
    ),
    "client_products": (
        "relationship_id BIGINT, client_id BIGINT, product_id BIGINT, relationship_type STRING, start_date DATE,"
        " end_date DATE, status STRING"
    ),
    "transactions": (
        "transaction_id BIGINT, transaction_uuid STRING, from_account_id BIGINT, to_account_id BIGINT,"
        " from_account_number STRING, to_account_number STRING, transaction_type STRING, amount DECIMAL(12,2),"
        " currency STRING, transaction_date TIMESTAMP_NTZ, description STRING, status STRING, category STRING,"
        " merchant_name STRING"
    ),
    "account_balances": (
        "balance_id BIGINT, account_id BIGINT, current_balance DECIMAL(14,2), available_balance DECIMAL(14,2),"
        " currency STRING, last_updated TIMESTAMP_NTZ, credit_limit DECIMAL(12,2)"
    ),
    "cards": (
        "card_id BIGINT, client_id BIGINT, account_id BIGINT, card_number STRING, card_holder_name STRING,"
        " expiry_date DATE, cvv INT, card_type STRING, card_level STRING, status STRING, issue_date DATE"
    ),
    "branches": (
        "branch_id BIGINT, branch_code STRING, branch_name STRING, address STRING, city STRING, state STRING,"
        " zip_code STRING, phone STRING, manager_name STRING, opening_date DATE"
    ),
    "employees": (
        "employee_id BIGINT, branch_id BIGINT, first_name STRING, last_name STRING, email STRING, phone STRING,"
        " position STRING, department STRING, hire_date DATE, salary DECIMAL(12,2), status STRING"
    ),
    "loans": (
        "loan_id BIGINT, contract_id BIGINT, loan_amount DECIMAL(12,2), outstanding_balance DECIMAL(12,2),"
        " interest_rate DECIMAL(5,2), term_months INT, remaining_months INT, next_payment_date DATE,"
        " next_payment_amount DECIMAL(12,2), delinquency_status STRING, collateral_value DECIMAL(13,2),"
        " loan_to_value_ratio DECIMAL(4,3)"
    ),
    "credit_applications": (
        "application_id BIGINT, client_id BIGINT, application_date DATE, requested_amount INT, approved_amount INT,"
        " purpose STRING, status STRING, decision_date DATE, interest_rate_proposed DECIMAL(5,2),"
        " reason_for_rejection STRING, officer_id BIGINT"
    ),
}


def source_schema(name: str) -> T.StructType:
    return T.StructType.fromDDL(DDL[name])
