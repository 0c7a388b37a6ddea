"""The layers again as SQL views, written for the checking engine."""

from __future__ import annotations

from coinloft import rules
from coinloft.sources import banking

from .core import VIEWS

AS_OF = f"DATE '{banking.AS_OF}'"
EVENTS_AS_OF = f"DATE '{banking.EVENTS_AS_OF}'"
SINCE = f"({AS_OF} - 30)"


def half_up(num: str, den: str, places: int = 2) -> str:
    """num / den in whole-number arithmetic, rounded half away from zero; NULL unless den > 0."""
    s = 10**places
    return (
        f"(CASE WHEN ({den}) > 0 THEN CAST(sign({num}) AS DOUBLE)"
        f" * ((2 * abs(CAST({num} AS HUGEINT)) * {s} + CAST({den} AS HUGEINT)) // (2 * CAST({den} AS HUGEINT))) / {s}.0 END)"
    )


def cents(x: str) -> str:
    return f"CAST(({x}) * 100 AS BIGINT)"


def mean(x: str, places: int = 2) -> str:
    """Rounded average of a column with two decimals."""
    return half_up(f"sum({cents(x)})", f"(count({x}) * 100)", places)


def code_of(x: str, codes, rest: str | None) -> str:
    key = f"upper(trim({x}))"
    arms = " ".join(
        f"WHEN list_contains([{', '.join(repr(v) for v in names)}], {key}) THEN '{label}'"
        for label, names in codes.items()
    )
    return f"(CASE {arms} ELSE {key if rest is None else repr(rest)} END)"


def region_of(x: str, codes) -> str:
    arms = " ".join(
        f"WHEN list_contains([{', '.join(repr(v) for v in names)}], {x}) THEN '{label}'" for label, names in codes.items()
    )
    return f"(CASE {arms} ELSE 'OTHER' END)"


def band(x: str, cuts, missing: str | None = None, op: str = "<") -> str:
    steps, rest = cuts
    arms = " ".join(f"WHEN {x} {op} {bound} THEN '{label}'" for bound, label in steps)
    null = f"WHEN {x} IS NULL THEN '{missing}' " if missing else ""
    return f"(CASE {null}{arms} ELSE '{rest}' END)"


def likes(x: str, patterns, rest: str) -> str:
    arms = " ".join(f"WHEN upper(trim({x})) LIKE '{p}' THEN '{label}'" for p, label in patterns)
    return f"(CASE {arms} ELSE '{rest}' END)"


def up(*names: str) -> str:
    return ", ".join(f"upper(trim({n})) AS {n}" for n in names)


def tr(*names: str) -> str:
    return ", ".join(f"trim({n}) AS {n}" for n in names)


def _view(columns: dict[str, str], source: str) -> str:
    return f"SELECT {', '.join(f'{sql} AS {name}' for name, sql in columns.items())} FROM {source}"


b = banking
LEDGER = f"""
(SELECT a.account_id,
        CASE WHEN upper(trim(a.account_type)) IN ('SAVINGS', 'CHECKING', 'DEPOSIT') THEN abs(a.opening + coalesce(m.moved, 0))
             ELSE a.opening + coalesce(m.moved, 0) END AS current_balance,
        coalesce(m.last_day, CAST(a.open_date AS TIMESTAMP)) AS last_updated
 FROM (SELECT *, {b.OPENING_BALANCE} AS opening FROM raw_accounts) a
 LEFT JOIN (SELECT account_id, sum(delta) AS moved, max(transaction_date) AS last_day FROM ax_legs GROUP BY ALL) m
   ON a.account_id = m.account_id)
"""
VIEWS.update(
    raw_clients=_view(b.CLIENTS, "customer JOIN nation ON c_nationkey = n_nationkey"),
    raw_products=_view(b.PRODUCTS, "part"),
    raw_contracts=_view(b.CONTRACTS, "(SELECT *, o_orderkey % (SELECT count(*) FROM part) AS product_id FROM orders)"),
    raw_accounts=_view(b.ACCOUNTS, "orders"),
    raw_client_products=_view(
        b.CLIENT_PRODUCTS,
        "(SELECT o_custkey, l_partkey, min(l_shipdate) AS first_ship FROM lineitem"
        " JOIN orders ON l_orderkey = o_orderkey GROUP BY o_custkey, l_partkey)",
    ),
    raw_transactions=_view(b.TRANSACTIONS, "lineitem"),
    ax_legs="""
        SELECT transaction_date, from_account_id AS account_id, -amount AS delta FROM raw_transactions
        WHERE status = 'COMPLETED' AND from_account_id IS NOT NULL
        UNION ALL
        SELECT transaction_date, to_account_id, amount FROM raw_transactions
        WHERE status = 'COMPLETED' AND to_account_id IS NOT NULL AND from_account_id IS DISTINCT FROM to_account_id""",
    raw_account_balances=_view(b.ACCOUNT_BALANCES, LEDGER),
    raw_cards=_view(b.CARDS, "orders"),
    raw_branches=_view(b.BRANCHES, "supplier JOIN nation ON s_nationkey = n_nationkey"),
    raw_employees=_view(b.EMPLOYEES, "(SELECT *, c_custkey % (SELECT count(*) FROM supplier) AS branch_id FROM customer)"),
    raw_loans=_view(b.LOANS, "orders"),
    raw_credit_applications=_view(b.CREDIT_APPLICATIONS, "orders"),
    raw_audit_log=_view(b.AUDIT_LOG, "events"),
    raw_user_directory=_view(b.USER_DIRECTORY, "(SELECT DISTINCT user_id FROM events)"),
    raw_resource_metrics=_view(b.RESOURCE_METRICS, "events"),
    raw_prediction_log=_view(b.PREDICTION_LOG, "events"),
)

DOMAIN = "CASE WHEN contains(email, '@') THEN substr(lower(email), strpos(email, '@') + 1) END AS email_domain"
DIGITS = "regexp_replace(phone, '[^0-9+]', '', 'g') AS phone_normalized"
SCORE = " + ".join(f"CAST({f} IS NOT NULL AS INT) * {int(w * 100)}" for f, w in rules.CLIENT_WEIGHTS.items())
ISSUES = {
    "missing_first_name": "first_name IS NULL",
    "missing_last_name": "last_name IS NULL",
    "missing_email": "email IS NULL",
    "invalid_email_format": "strpos(email, '@') = 0",
    "missing_phone": "phone IS NULL",
    "missing_birth_date": "birth_date IS NULL",
    "missing_credit_score": "credit_score IS NULL",
    "invalid_credit_score": "credit_score NOT BETWEEN 300 AND 850",
    "missing_annual_income": "annual_income IS NULL",
    "negative_income": "annual_income < 0",
}
ISSUE_TEXT = f"concat_ws('; ', {', '.join(f'IF({test}, {name!r}, NULL)' for name, test in ISSUES.items())})"
RATE = "CAST({} AS DECIMAL(7,2))"

VIEWS.update(
    sv_clients=f"""
        SELECT client_id, {tr('first_name', 'last_name')}, trim(first_name) || ' ' || trim(last_name) AS full_name,
               lower(trim(email)) AS email, {DOMAIN}, phone, {DIGITS}, birth_date,
               CAST(({AS_OF} - birth_date) * 100 // 36525 AS INT) AS age, registration_date, {tr('address', 'city')},
               {up('country', 'risk_category')}, credit_score,
               {band('credit_score', rules.CREDIT_SCORE_BAND, 'UNKNOWN')} AS credit_score_category,
               {up('employment_status')}, annual_income,
               {band('annual_income', rules.INCOME_BAND, 'UNKNOWN')} AS income_category,
               coalesce({AS_OF} - registration_date <= 365, FALSE) AS is_active,
               CAST(({SCORE}) / 100 AS DECIMAL(3,2)) AS dq_score, {ISSUE_TEXT} AS dq_issues,
               'bronze.clients' AS source_system, year(registration_date) AS registration_year
        FROM raw_clients WHERE client_id IS NOT NULL""",
    sv_products=f"""
        SELECT product_id, {tr('product_name')}, {up('product_type')},
               {code_of('product_type', rules.PRODUCT_CATEGORY, 'OTHER')} AS product_category, {up('currency')},
               ifnull(active, FALSE) AS active, 'bronze.products' AS source_system
        FROM raw_products WHERE product_id IS NOT NULL""",
    sv_contracts=f"""
        SELECT contract_id, client_id, product_id, {tr('contract_number')}, start_date, end_date,
               ifnull(end_date, {AS_OF}) - start_date AS contract_duration_days, contract_amount, interest_rate, status,
               {code_of('status', rules.CONTRACT_STATUS, 'UNKNOWN')} AS status_normalized, monthly_payment, created_date,
               ifnull(end_date < {AS_OF}, FALSE) AS is_expired, end_date - {AS_OF} AS days_to_expiry,
               'bronze.contracts' AS source_system, year(start_date) AS start_year
        FROM raw_contracts WHERE contract_id IS NOT NULL""",
    sv_accounts=f"""
        SELECT account_id, client_id, contract_id, {tr('account_number')}, account_type,
               {code_of('account_type', rules.ACCOUNT_TYPE, 'OTHER')} AS account_type_normalized, {up('currency')},
               open_date, close_date, ifnull(close_date, {AS_OF}) - open_date AS account_age_days, status,
               {code_of('status', rules.ACCOUNT_STATUS, 'UNKNOWN')} AS status_normalized, branch_code,
               upper(trim(status)) = 'ACTIVE' AND ifnull(close_date >= {AS_OF}, TRUE) AS is_active,
               'bronze.accounts' AS source_system, year(open_date) AS open_year
        FROM raw_accounts WHERE account_id IS NOT NULL""",
    sv_client_products=f"""
        SELECT relationship_id, client_id, product_id, relationship_type,
               upper(trim(relationship_type)) AS relationship_type_normalized, start_date, end_date,
               ifnull(end_date, {AS_OF}) - start_date AS relationship_duration_days, status,
               upper(trim(status)) = 'ACTIVE' AND ifnull(end_date >= {AS_OF}, TRUE) AS is_active,
               'bronze.client_products' AS source_system
        FROM raw_client_products
        WHERE relationship_id IS NOT NULL AND client_id IS NOT NULL AND product_id IS NOT NULL""",
    sv_transactions=f"""
        SELECT transaction_id, trim(transaction_uuid) AS transaction_uuid, from_account_id, to_account_id,
               {tr('from_account_number', 'to_account_number')}, transaction_type,
               {code_of('transaction_type', rules.TRANSACTION_TYPE, 'OTHER')} AS transaction_type_normalized, amount,
               abs(amount) AS amount_abs, {up('currency')}, transaction_date,
               CAST(transaction_date AS DATE) AS transaction_date_only, hour(transaction_date) AS transaction_hour,
               {tr('description')}, status, {code_of('status', rules.TRANSACTION_STATUS, 'UNKNOWN')} AS status_normalized,
               category, {code_of('category', rules.TRANSACTION_CATEGORY, 'OTHER')} AS category_normalized,
               {tr('merchant_name')}, from_account_id IS NOT NULL AND to_account_id IS NOT NULL AS is_internal_transfer,
               abs(amount) > 10000 OR hour(transaction_date) <= 4 AS is_suspicious,
               'bronze.transactions' AS source_system, year(transaction_date) AS transaction_year,
               month(transaction_date) AS transaction_month
        FROM raw_transactions
        WHERE transaction_id IS NOT NULL AND amount IS NOT NULL AND transaction_date IS NOT NULL""",
    sv_account_balances=f"""
        SELECT balance_id, account_id, current_balance, available_balance,
               current_balance - available_balance AS reserved_amount, {up('currency')}, last_updated,
               ifnull(credit_limit, 0) AS credit_limit,
               CASE WHEN credit_limit > 0
                    THEN TRY_CAST({half_up(cents('current_balance') + ' * 100', cents('credit_limit'))} AS DECIMAL(5,2))
                    ELSE 0 END AS credit_utilization,
               CASE WHEN current_balance < 0 THEN 'NEGATIVE' WHEN current_balance = 0 THEN 'ZERO'
                    ELSE {band('current_balance', rules.BALANCE_BAND)} END AS balance_category,
               'bronze.account_balances' AS source_system
        FROM raw_account_balances WHERE balance_id IS NOT NULL""",
    sv_cards=f"""
        SELECT card_id, client_id, account_id, '****-****-****-' || right(card_number, 4) AS card_number_masked,
               {tr('card_holder_name')}, expiry_date, card_type, upper(trim(card_type)) AS card_type_normalized,
               {up('card_level')}, status, {code_of('status', rules.CARD_STATUS, 'UNKNOWN')} AS status_normalized,
               issue_date, {AS_OF} - issue_date AS card_age_days, ifnull(expiry_date < {AS_OF}, FALSE) AS is_expired,
               expiry_date - {AS_OF} AS days_to_expiry, 'bronze.cards' AS source_system
        FROM raw_cards WHERE card_id IS NOT NULL""",
    sv_branches=f"""
        SELECT branch_id, {up('branch_code')}, {tr('branch_name', 'address', 'city', 'state')},
               {code_of('state', rules.STATE_CODE, None)} AS state_code, {tr('zip_code')}, phone, {DIGITS},
               {tr('manager_name')}, opening_date, {AS_OF} - opening_date AS branch_age_days,
               'bronze.branches' AS source_system
        FROM raw_branches WHERE branch_id IS NOT NULL""",
    sv_employees=f"""
        SELECT employee_id, branch_id, {tr('first_name', 'last_name')},
               trim(first_name) || ' ' || trim(last_name) AS full_name, lower(trim(email)) AS email, {DOMAIN}, phone,
               {DIGITS}, position, upper(trim(position)) AS position_normalized, department,
               upper(trim(department)) AS department_normalized, hire_date, {AS_OF} - hire_date AS tenure_days,
               CAST({half_up(f'({AS_OF} - hire_date) * 100', '36525')} AS DECIMAL(6,2)) AS tenure_years, salary,
               {band('salary', rules.SALARY_BAND, 'UNKNOWN')} AS salary_category, status,
               upper(trim(status)) AS status_normalized, upper(trim(status)) = 'ACTIVE' AS is_active,
               'bronze.employees' AS source_system
        FROM raw_employees WHERE employee_id IS NOT NULL""",
    sv_loans=f"""
        SELECT loan_id, contract_id, loan_amount, outstanding_balance, loan_amount - outstanding_balance AS paid_amount,
               CASE WHEN loan_amount > 0
                    THEN {half_up(cents('loan_amount - outstanding_balance') + ' * 100', cents('loan_amount'))}
                    ELSE 0 END AS payment_progress,
               interest_rate, term_months, remaining_months, term_months - remaining_months AS elapsed_months,
               next_payment_date, next_payment_amount, delinquency_status,
               {likes('delinquency_status', rules.DELINQUENCY, 'UNKNOWN')} AS delinquency_status_normalized,
               NOT ifnull(upper(trim(delinquency_status)) IN ('CURRENT', 'NONE'), FALSE) AS is_delinquent,
               collateral_value, loan_to_value_ratio,
               {band('loan_to_value_ratio', rules.LTV_BAND, op='<=')} AS ltv_category, 'bronze.loans' AS source_system
        FROM raw_loans WHERE loan_id IS NOT NULL""",
    sv_credit_applications=f"""
        SELECT application_id, client_id, application_date, requested_amount, ifnull(approved_amount, 0) AS approved_amount,
               CASE WHEN requested_amount > 0
                    THEN {half_up('CAST(ifnull(approved_amount, 0) AS BIGINT) * 100', 'requested_amount')}
                    ELSE 0 END AS approval_rate,
               purpose, upper(trim(purpose)) AS purpose_normalized, status,
               {code_of('status', rules.APPLICATION_STATUS, 'UNKNOWN')} AS status_normalized, decision_date,
               decision_date - application_date AS processing_days, interest_rate_proposed, {tr('reason_for_rejection')},
               IF(reason_for_rejection IS NULL, NULL, {likes('reason_for_rejection', rules.REJECTION_REASON, 'OTHER')}) AS rejection_category,
               officer_id, ifnull(upper(trim(status)) IN ('APPROVED', 'ACCEPTED'), FALSE) AS is_approved,
               ifnull(upper(trim(status)) IN ('REJECTED', 'DECLINED', 'DENIED'), FALSE) AS is_rejected,
               'bronze.credit_applications' AS source_system, year(application_date) AS application_year
        FROM raw_credit_applications WHERE application_id IS NOT NULL""",
)
