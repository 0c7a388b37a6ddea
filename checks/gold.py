"""Gold tables and their load checks."""

from __future__ import annotations

from coinloft import rules

from .base import AS_OF, SINCE, band, cents, half_up, mean, region_of
from .core import VIEWS, check

YEAR = f"year({AS_OF})"
SEGMENT = (
    "CASE WHEN annual_income > 150000 AND credit_score > 750 THEN 'VIP'"
    " WHEN annual_income > 100000 AND credit_score > 700 THEN 'PREMIUM'"
    " WHEN annual_income > 50000 AND credit_score > 650 THEN 'REGULAR' ELSE 'BASIC' END"
)


def years_since(day: str) -> str:
    return half_up(f"({AS_OF} - {day}) * 100", "36525")


# literal joins, row by row: the twins do not pre-aggregate
VIEWS.update(
    ax_client_accounts="""
        SELECT client_id, count(*) AS total_accounts, count(*) FILTER (is_active) AS active_accounts,
               count(*) FILTER (account_type_normalized = 'CHECKING') AS checking_accounts,
               count(*) FILTER (account_type_normalized = 'SAVINGS') AS savings_accounts,
               count(*) FILTER (account_type_normalized = 'LOAN') AS loan_accounts
        FROM sv_accounts GROUP BY client_id""",
    ax_client_products="""
        SELECT client_id, count(DISTINCT product_id) AS total_products
        FROM sv_client_products WHERE is_active GROUP BY client_id""",
    ax_client_contracts="SELECT client_id, count(*) AS total_contracts FROM sv_contracts GROUP BY client_id",
    ax_client_cards="""
        SELECT client_id, count(*) AS total_cards, count(*) FILTER (NOT is_expired) AS active_cards
        FROM sv_cards GROUP BY client_id""",
    ax_loans_owned="SELECT l.*, c.client_id FROM sv_loans l JOIN sv_contracts c USING (contract_id)",
    ax_client_loans="""
        SELECT client_id, count(*) AS total_loans, count(*) FILTER (NOT is_delinquent) AS active_loans,
               sum(loan_amount) AS total_loan_amount, sum(outstanding_balance) AS total_outstanding_balance,
               sum(next_payment_amount) AS total_loan_payment, count(*) FILTER (is_delinquent) AS delinquent_loans
        FROM ax_loans_owned GROUP BY client_id""",
    ax_balances_owned="""
        SELECT ab.*, a.client_id, a.branch_code, a.account_type_normalized
        FROM sv_account_balances ab JOIN sv_accounts a USING (account_id)""",
    ax_moves_owned="""
        SELECT t.*, a.client_id, a.branch_code FROM sv_transactions t
        JOIN sv_accounts a ON t.from_account_id = a.account_id WHERE t.status_normalized = 'COMPLETED'""",
    ax_client_moves=f"""
        SELECT client_id, count(*) AS transactions_30d, sum(amount) AS transaction_volume_30d,
               {mean('amount')} AS avg_transaction_30d,
               count(*) FILTER (transaction_type_normalized = 'DEPOSIT') AS deposits_30d,
               count(*) FILTER (transaction_type_normalized = 'WITHDRAWAL') AS withdrawals_30d,
               count(*) FILTER (transaction_type_normalized = 'TRANSFER') AS transfers_30d,
               count(*) FILTER (is_suspicious) AS suspicious_activities,
               CAST(max(transaction_date) AS DATE) AS last_transaction_date
        FROM ax_moves_owned WHERE transaction_date >= {SINCE} GROUP BY client_id""",
    gd_dim_client=f"""
        SELECT client_id AS client_key, client_id, first_name, last_name, full_name, email, email_domain, phone,
               birth_date, age, {band('age', rules.AGE_BAND)} AS age_group, registration_date,
               {AS_OF} - registration_date AS customer_tenure_days,
               {years_since('registration_date')} AS customer_tenure_years, address, city, country,
               {region_of('country', rules.COUNTRY_REGION)} AS region, risk_category, credit_score,
               credit_score_category, employment_status, annual_income, income_category,
               {SEGMENT} AS client_segment, NULL AS client_lifetime_value,
               ifnull(total_accounts, 0) AS total_accounts, ifnull(active_accounts, 0) AS total_active_accounts,
               ifnull(total_products, 0) AS total_products, ifnull(total_contracts, 0) AS total_contracts,
               ifnull(total_cards, 0) AS total_cards, ifnull(total_loans, 0) AS total_loans,
               registration_date AS effective_date, NULL AS end_date, TRUE AS is_current
        FROM sv_clients
        LEFT JOIN ax_client_accounts USING (client_id) LEFT JOIN ax_client_products USING (client_id)
        LEFT JOIN ax_client_contracts USING (client_id) LEFT JOIN ax_client_cards USING (client_id)
        LEFT JOIN ax_client_loans USING (client_id)""",
    gd_dim_product=f"""
        SELECT product_id AS product_key, product_id, product_name, product_type, product_category, currency, active,
               (SELECT count(DISTINCT cp.client_id) FROM sv_client_products cp WHERE cp.product_id = p.product_id) AS total_clients,
               (SELECT count(*) FROM sv_contracts c WHERE c.product_id = p.product_id) AS total_contracts,
               ifnull((SELECT sum(c.contract_amount) FROM sv_contracts c WHERE c.product_id = p.product_id), 0) AS total_revenue,
               {AS_OF} AS effective_date, NULL AS end_date, active AS is_current
        FROM sv_products p""",
    gd_dim_branch=f"""
        SELECT branch_id AS branch_key, branch_id, branch_code, branch_name, address, city, state, state_code, zip_code,
               {region_of('state_code', rules.STATE_REGION)} AS region, phone, manager_name, opening_date, branch_age_days,
               (SELECT count(*) FROM sv_employees e WHERE e.branch_id = b.branch_id AND e.is_active) AS total_employees,
               (SELECT count(*) FROM sv_accounts a WHERE a.branch_code = b.branch_code) AS total_accounts,
               (SELECT count(DISTINCT client_id) FROM sv_accounts a WHERE a.branch_code = b.branch_code) AS total_clients,
               opening_date AS effective_date, NULL AS end_date, TRUE AS is_current
        FROM sv_branches b""",
    ax_days="""
        SELECT CAST(unnest(generate_series(
                 (SELECT date_trunc('year', min(transaction_date_only)) FROM sv_transactions),
                 (SELECT date_trunc('year', max(transaction_date_only)) + INTERVAL 1 YEAR - INTERVAL 1 DAY FROM sv_transactions),
                 INTERVAL 1 DAY)) AS DATE) AS d""",
    gd_dim_date="""
        SELECT CAST(strftime(d, '%Y%m%d') AS INT) AS date_key, d AS date_value, year(d) AS year, quarter(d) AS quarter,
               'Q' || quarter(d) || ' ' || year(d) AS quarter_name, month(d) AS month, monthname(d) AS month_name,
               left(monthname(d), 3) AS month_short, weekofyear(d) AS week_of_year, day(d) AS day_of_month,
               dayofweek(d) + 1 AS day_of_week, dayname(d) AS day_name, left(dayname(d), 3) AS day_short,
               dayofweek(d) IN (0, 6) AS is_weekend,
               strftime(d, '%m%d') IN ('0101', '0704', '1225') AS is_holiday,
               MAP {'0101': 'New Year Day', '0704': 'Independence Day', '1225': 'Christmas'}[strftime(d, '%m%d')] AS holiday_name,
               NOT (dayofweek(d) IN (0, 6) OR strftime(d, '%m%d') IN ('0101', '0704', '1225')) AS is_business_day,
               year(d) AS fiscal_year, quarter(d) AS fiscal_quarter, month(d) AS fiscal_month
        FROM ax_days""",
    gd_dim_account=f"""
        SELECT account_id AS account_key, account_id, account_number, account_type_normalized AS account_type,
               status_normalized AS account_status, client_id, contract_id, branch_code, currency,
               open_date AS opening_date, {years_since('open_date')} AS account_age_years,
               (SELECT count(*) FROM sv_transactions t WHERE t.from_account_id = a.account_id) AS total_transactions,
               (SELECT count(*) FROM sv_cards c WHERE c.account_id = a.account_id) AS total_cards,
               open_date AS effective_date, close_date AS end_date, is_active AS is_current
        FROM sv_accounts a""",
    gd_fact_transactions_daily=f"""
        SELECT transaction_date_only AS transaction_date, ifnull(a.client_id, -1) AS client_id,
               t.from_account_id AS account_id, ifnull(a.branch_code, 'UNKNOWN') AS branch_code,
               transaction_type_normalized AS transaction_type, category_normalized AS category, t.currency,
               count(*) AS transaction_count, sum(amount) AS total_amount, {mean('amount')} AS avg_amount,
               min(amount) AS min_amount, max(amount) AS max_amount,
               count(*) FILTER (t.status_normalized = 'COMPLETED') AS successful_count,
               count(*) FILTER (t.status_normalized = 'FAILED') AS failed_count,
               count(*) FILTER (t.status_normalized = 'PENDING') AS pending_count,
               count(*) FILTER (t.status_normalized = 'CANCELLED') AS cancelled_count,
               {half_up("count(*) FILTER (t.status_normalized = 'COMPLETED') * 100", 'count(*)')} AS success_rate,
               bool_or(is_suspicious) AS has_suspicious_transactions,
               count(*) FILTER (is_suspicious) AS suspicious_transaction_count,
               transaction_year AS year, transaction_month AS month
        FROM sv_transactions t LEFT JOIN sv_accounts a ON t.from_account_id = a.account_id
        GROUP BY transaction_date_only, a.client_id, t.from_account_id, a.branch_code, transaction_type_normalized,
                 category_normalized, t.currency, transaction_year, transaction_month""",
    ax_closing="""
        SELECT account_id, CAST(last_updated AS DATE) AS day, arg_max(current_balance, (last_updated, balance_id)) AS closing
        FROM sv_account_balances WHERE last_updated IS NOT NULL GROUP BY ALL""",
    gd_fact_account_balance_daily="""
        SELECT CAST(last_updated AS DATE) AS snapshot_date, account_id, client_id, account_type_normalized AS account_type,
               branch_code, currency, current_balance, available_balance, reserved_amount, credit_limit,
               credit_utilization, balance_category,
               now.closing - (SELECT p.closing FROM ax_closing p WHERE p.account_id = o.account_id AND p.day <= now.day - 1
                              ORDER BY p.day DESC LIMIT 1) AS balance_change_daily,
               now.closing - (SELECT p.closing FROM ax_closing p WHERE p.account_id = o.account_id AND p.day <= now.day - 7
                              ORDER BY p.day DESC LIMIT 1) AS balance_change_weekly,
               now.closing - (SELECT p.closing FROM ax_closing p WHERE p.account_id = o.account_id AND p.day <= now.day - 30
                              ORDER BY p.day DESC LIMIT 1) AS balance_change_monthly,
               year(last_updated) AS year, month(last_updated) AS month
        FROM ax_balances_owned o JOIN ax_closing now USING (account_id)
        WHERE last_updated IS NOT NULL AND now.day = CAST(last_updated AS DATE)""",
    gd_fact_loan_performance=f"""
        SELECT loan_id, contract_id, client_id, {AS_OF} AS snapshot_date, loan_amount, outstanding_balance, paid_amount,
               payment_progress, interest_rate, term_months, remaining_months, elapsed_months, next_payment_date,
               next_payment_amount, next_payment_date - {AS_OF} AS days_to_next_payment, NULL AS total_payments_made,
               NULL AS missed_payments, NULL AS late_payments, NULL AS on_time_payment_rate,
               delinquency_status_normalized AS delinquency_status, is_delinquent, NULL AS days_past_due,
               collateral_value, loan_to_value_ratio, ltv_category, NULL AS default_probability,
               {YEAR} AS year, month({AS_OF}) AS month
        FROM ax_loans_owned""",
    ax_client_balances=f"""
        SELECT client_id, sum(current_balance) AS total_balance, {mean('current_balance')} AS avg_balance
        FROM ax_balances_owned GROUP BY client_id""",
    gd_client_360_view=f"""
        SELECT client_id, {AS_OF} AS snapshot_date, full_name, email, phone, age, {band('age', rules.AGE_BAND)} AS age_group,
               city, country, risk_category, credit_score, credit_score_category, annual_income, income_category,
               {SEGMENT} AS client_segment,
               {', '.join(f'ifnull({c}, 0) AS {c}' for c in (
                   'total_accounts', 'active_accounts', 'checking_accounts', 'savings_accounts', 'loan_accounts',
                   'total_balance', 'avg_balance', 'total_products', 'total_contracts', 'total_cards', 'active_cards',
                   'total_loans', 'active_loans', 'total_loan_amount', 'total_outstanding_balance', 'total_loan_payment',
                   'delinquent_loans', 'transactions_30d', 'transaction_volume_30d', 'avg_transaction_30d',
                   'deposits_30d', 'withdrawals_30d', 'transfers_30d', 'suspicious_activities'))},
               last_transaction_date, ifnull({AS_OF} - last_transaction_date, 999) AS days_since_last_transaction,
               CASE WHEN transactions_30d >= 20 THEN 'DAILY' WHEN transactions_30d >= 4 THEN 'WEEKLY'
                    WHEN transactions_30d >= 1 THEN 'MONTHLY' ELSE 'INACTIVE' END AS transaction_frequency,
               {', '.join(f'NULL AS {c}' for c in (
                   'channel_preference', 'customer_lifetime_value', 'total_revenue', 'total_fees_paid',
                   'profitability_score', 'risk_score', 'fraud_alerts'))},
               {YEAR} AS snapshot_year, month({AS_OF}) AS snapshot_month
        FROM sv_clients
        LEFT JOIN ax_client_accounts USING (client_id) LEFT JOIN ax_client_balances USING (client_id)
        LEFT JOIN ax_client_products USING (client_id) LEFT JOIN ax_client_contracts USING (client_id)
        LEFT JOIN ax_client_cards USING (client_id) LEFT JOIN ax_client_loans USING (client_id)
        LEFT JOIN ax_client_moves USING (client_id)""",
    ax_product_clients=f"""
        SELECT product_id, count(DISTINCT client_id) AS total_clients,
               count(DISTINCT client_id) FILTER (is_active) AS active_clients,
               count(DISTINCT client_id) FILTER (start_date >= {SINCE}) AS new_clients_mtd,
               count(DISTINCT client_id) FILTER (end_date >= {SINCE} AND end_date < {AS_OF}) AS churned_clients_mtd
        FROM sv_client_products GROUP BY product_id""",
    ax_contract_income="""
        SELECT *, CAST(contract_amount * interest_rate AS DECIMAL(22,4)) / 100 AS income,
               CAST(contract_amount * 100 AS HUGEINT) * CAST(interest_rate * 100 AS HUGEINT) AS income_units FROM sv_contracts""",
    ax_product_contracts=f"""
        SELECT product_id, count(*) AS total_contracts, count(*) FILTER (status_normalized = 'ACTIVE') AS active_contracts,
               sum(contract_amount) AS total_contract_value, {mean('contract_amount')} AS avg_contract_value,
               {half_up(f"ifnull(sum(income_units) FILTER (created_date >= {SINCE}), 0)", '1000000', 4)} AS total_revenue_mtd,
               {half_up(f"ifnull(sum(income_units) FILTER (year(created_date) = {YEAR}), 0)", '1000000', 4)} AS total_revenue_ytd
        FROM ax_contract_income GROUP BY product_id""",
    gd_product_performance_summary=f"""
        SELECT product_id, {AS_OF} AS report_date, product_name, product_type, product_category,
               {', '.join(f'ifnull({c}, 0) AS {c}' for c in (
                   'total_clients', 'new_clients_mtd', 'churned_clients_mtd', 'active_clients', 'total_contracts',
                   'active_contracts', 'total_contract_value', 'avg_contract_value', 'total_revenue_mtd',
                   'total_revenue_ytd'))},
               CASE WHEN total_clients > 0 THEN {half_up('active_clients * 100', 'total_clients')} ELSE 0 END AS retention_rate,
               {half_up('new_clients_mtd * 100', '(total_clients - new_clients_mtd)')} AS client_growth_rate,
               NULL AS revenue_growth_rate,
               {half_up('ifnull(total_clients, 0) * 100', '(SELECT sum(total_clients) FROM ax_product_clients)')} AS market_share,
               {YEAR} AS year, month({AS_OF}) AS month
        FROM sv_products LEFT JOIN ax_product_clients USING (product_id) LEFT JOIN ax_product_contracts USING (product_id)""",
    ax_branch_staff=f"""
        SELECT branch_id, count(*) AS total_employees, count(*) FILTER (is_active) AS active_employees,
               {half_up(f"sum({cents('tenure_years')})", 'count(tenure_years) * 100', 1)} AS avg_employee_tenure_years
        FROM sv_employees GROUP BY branch_id""",
    ax_branch_accounts=f"""
        SELECT branch_code, count(*) AS total_accounts, count(*) FILTER (is_active) AS active_accounts,
               count(*) FILTER (open_date >= {SINCE}) AS new_clients_mtd, count(DISTINCT client_id) AS total_clients,
               count(DISTINCT client_id) FILTER (is_active) AS active_clients
        FROM sv_accounts GROUP BY branch_code""",
    ax_branch_balances=f"""
        SELECT branch_code, sum(current_balance) AS total_deposits, {mean('current_balance')} AS avg_account_balance
        FROM ax_balances_owned GROUP BY branch_code""",
    ax_branch_loans="""
        SELECT a.branch_code, sum(l.loan_amount) AS total_loans_issued
        FROM ax_loans_owned l JOIN sv_accounts a ON a.client_id = l.client_id GROUP BY a.branch_code""",
    ax_branch_moves=f"""
        SELECT branch_code, sum(amount) AS total_transaction_volume,
               ifnull(sum({cents('amount')}) FILTER (transaction_date >= {SINCE}), 0) / 100000.0 AS total_revenue_mtd
        FROM ax_moves_owned GROUP BY branch_code""",
    ax_branch_approvals=f"""
        SELECT branch_code, {half_up('count(*) FILTER (is_approved) * 100', 'count(*) FILTER (is_approved OR is_rejected)')} AS loan_approval_rate
        FROM (SELECT DISTINCT branch_code, client_id FROM sv_accounts) JOIN sv_credit_applications USING (client_id)
        GROUP BY branch_code""",
    ax_branch_numbers=f"""
        SELECT branch_id, branch_code, {AS_OF} AS report_date, branch_name, city, state,
               {region_of('state_code', rules.STATE_REGION)} AS region, manager_name,
               {', '.join(f'ifnull({c}, 0) AS {c}' for c in (
                   'total_employees', 'active_employees', 'avg_employee_tenure_years', 'total_clients', 'new_clients_mtd',
                   'active_clients', 'total_accounts', 'active_accounts', 'total_deposits', 'total_loans_issued',
                   'total_transaction_volume', 'total_revenue_mtd', 'avg_account_balance'))},
               NULL AS total_fees_collected, loan_approval_rate, NULL AS customer_satisfaction_score, NULL AS nps_score,
               {YEAR} AS year, month({AS_OF}) AS month
        FROM sv_branches LEFT JOIN ax_branch_staff USING (branch_id) LEFT JOIN ax_branch_accounts USING (branch_code)
        LEFT JOIN ax_branch_balances USING (branch_code) LEFT JOIN ax_branch_loans USING (branch_code)
        LEFT JOIN ax_branch_moves USING (branch_code) LEFT JOIN ax_branch_approvals USING (branch_code)""",
    ax_branch_ranked=f"""
        SELECT *, {half_up(cents('total_deposits'), 'total_employees * 100')} AS per_head FROM ax_branch_numbers""",
    gd_branch_performance_dashboard="""
        SELECT * EXCLUDE (per_head), rank() OVER (ORDER BY total_revenue_mtd DESC NULLS LAST) AS revenue_rank,
               rank() OVER (ORDER BY total_clients DESC NULLS LAST) AS customer_rank,
               rank() OVER (ORDER BY per_head DESC NULLS LAST) AS efficiency_rank
        FROM ax_branch_ranked""",
    gd_financial_kpi_summary=f"""
        SELECT {AS_OF} AS report_date, metric_category, c.total_clients, c.active_clients, a.total_accounts, a.active_accounts,
               l.total_loans AS total_assets, d.total_deposits AS total_liabilities,
               l.total_loans - d.total_deposits AS net_assets, d.total_deposits, l.total_loans,
               r.mtd AS total_revenue_mtd, r.ytd AS total_revenue_ytd, x.n AS total_transactions,
               x.volume AS total_transaction_volume, x.mean AS avg_transaction_value, x.rate AS transaction_success_rate,
               l.late AS total_delinquent_loans, l.rate AS delinquency_rate, l.npl AS total_npl_amount,
               NULL AS provision_coverage_ratio, c.growth AS client_growth_rate, NULL AS revenue_growth_rate,
               NULL AS loan_growth_rate, NULL AS deposit_growth_rate, {YEAR} AS year, month({AS_OF}) AS month
        FROM (VALUES ('DEPOSITS'), ('LOANS'), ('TRANSACTIONS'), ('REVENUE')) v(metric_category),
             (SELECT count(*) AS total_clients, count(*) FILTER (is_active) AS active_clients,
                     {half_up(f'count(*) FILTER (registration_date >= {SINCE}) * 100',
                              f'(count(*) - count(*) FILTER (registration_date >= {SINCE}))')} AS growth FROM sv_clients) c,
             (SELECT count(*) AS total_accounts, count(*) FILTER (is_active) AS active_accounts FROM sv_accounts) a,
             (SELECT ifnull(sum(current_balance), 0) AS total_deposits FROM ax_balances_owned
              WHERE current_balance > 0 AND account_type_normalized <> 'LOAN') d,
             (SELECT count(*) FILTER (is_delinquent) AS late, {half_up('count(*) FILTER (is_delinquent) * 100', 'count(*)')} AS rate,
                     sum(outstanding_balance) AS total_loans,
                     sum(outstanding_balance) FILTER (delinquency_status_normalized IN ('DELINQUENT_90', 'DELINQUENT_120_PLUS')) AS npl
              FROM sv_loans) l,
             (SELECT {half_up(f"ifnull(sum(income_units) FILTER (created_date >= {SINCE}), 0)", '1000000', 4)} AS mtd,
                     {half_up(f"ifnull(sum(income_units) FILTER (year(created_date) = {YEAR}), 0)", '1000000', 4)} AS ytd FROM ax_contract_income) r,
             (SELECT count(*) AS n, sum(amount) AS volume, {mean('amount')} AS mean,
                     {half_up("count(*) FILTER (status_normalized = 'COMPLETED') * 100", 'count(*)')} AS rate FROM sv_transactions) x""",
)

for _name in (
    "dim_client", "dim_product", "dim_branch", "dim_date", "dim_account", "fact_transactions_daily",
    "fact_account_balance_daily", "fact_loan_performance", "client_360_view", "product_performance_summary",
    "branch_performance_dashboard", "financial_kpi_summary",
):

    def _register(name):
        @check(name, f"SELECT * FROM gd_{name}")
        def run(lake):
            return lake.gold[name]

    _register(_name)
