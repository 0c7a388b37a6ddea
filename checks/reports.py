"""Analytical queries over stage and gold. The twins join row by row."""

from __future__ import annotations

from coinloft.plans import reports

from .base import cents, half_up, mean
from .core import check


def ratio3(x: str) -> str:
    return half_up(f"sum(CAST({x} * 1000 AS BIGINT))", f"(count({x}) * 1000)", 3)


check("aq_client_base", f"""
    SELECT risk_category, employment_status, count(*) AS client_count, {mean('credit_score')} AS avg_credit_score,
           {mean('annual_income')} AS avg_annual_income, sum(annual_income) AS total_annual_income,
           count(*) FILTER (credit_score > 700) AS high_credit_clients,
           {half_up('count(*) FILTER (credit_score > 700) * 100', 'count(*)')} AS high_credit_percentage
    FROM raw_clients GROUP BY ALL""")(lambda k: reports.client_base(k.stage))

check("aq_monthly_activity", f"""
    SELECT year(transaction_date) AS year, month(transaction_date) AS month, category, transaction_type,
           count(*) AS transaction_count, sum(amount) AS total_amount, {mean('amount')} AS avg_amount,
           count(DISTINCT from_account_id) AS unique_accounts
    FROM raw_transactions WHERE status = 'COMPLETED' GROUP BY ALL""")(lambda k: reports.monthly_activity(k.stage))

check("aq_product_effectiveness", f"""
    SELECT product_name, product_type, count(DISTINCT c.client_id) AS client_count,
           count(DISTINCT k.contract_id) AS contract_count, sum(k.contract_amount) AS total_contract_amount,
           {mean('k.contract_amount')} AS avg_contract_amount, sum(k.monthly_payment) AS total_monthly_payments,
           count(DISTINCT a.account_id) AS account_count
    FROM raw_products p LEFT JOIN raw_contracts k ON k.product_id = p.product_id
    LEFT JOIN raw_clients c ON c.client_id = k.client_id LEFT JOIN raw_accounts a ON a.contract_id = k.contract_id
    WHERE p.active GROUP BY ALL""")(lambda k: reports.product_effectiveness(k.stage))

check("aq_loan_risk", f"""
    SELECT delinquency_status, count(*) AS loan_count, sum(loan_amount) AS total_loan_amount,
           sum(outstanding_balance) AS total_outstanding, {mean('l.interest_rate')} AS avg_interest_rate,
           {half_up(f"sum({cents('outstanding_balance')}) * 100", f"sum({cents('loan_amount')})")} AS outstanding_percentage,
           {ratio3('loan_to_value_ratio')} AS avg_ltv,
           count(*) FILTER (outstanding_balance * 10 > loan_amount * 8) AS high_risk_loans
    FROM raw_loans l JOIN raw_contracts USING (contract_id) GROUP BY ALL""")(lambda k: reports.loan_risk(k.stage))

check("aq_balance_distribution", f"""
    SELECT account_type, status, count(*) AS account_count, sum(current_balance) AS total_balance,
           {mean('current_balance')} AS avg_balance, min(current_balance) AS min_balance,
           max(current_balance) AS max_balance, sum(credit_limit) AS total_credit_limit,
           count(*) FILTER (current_balance < 0) AS negative_balance_count
    FROM raw_accounts JOIN raw_account_balances USING (account_id) WHERE status = 'ACTIVE'
    GROUP BY ALL""")(lambda k: reports.balance_distribution(k.stage))

BRANCH_JOIN = """
    FROM raw_branches b LEFT JOIN raw_accounts a USING (branch_code) LEFT JOIN raw_clients c USING (client_id)
    LEFT JOIN raw_employees e ON e.branch_id = b.branch_id LEFT JOIN raw_account_balances ab USING (account_id)
    LEFT JOIN raw_cards k ON k.account_id = a.account_id
    LEFT JOIN raw_transactions t ON t.from_account_id = a.account_id AND t.status = 'COMPLETED'"""
check("aq_branch_comparison", f"""
    SELECT b.branch_code, b.city, b.state, count(DISTINCT a.account_id) AS total_accounts,
           count(DISTINCT c.client_id) AS total_clients, count(DISTINCT e.employee_id) AS total_employees,
           sum(ab.current_balance) AS total_deposits, {mean('ab.current_balance')} AS avg_account_balance,
           count(DISTINCT k.card_id) AS cards_issued, sum(t.amount) AS total_transaction_volume
    {BRANCH_JOIN} GROUP BY ALL""")(lambda k: reports.branch_comparison(k.stage))

check("aq_branch_comparison_safe", f"""
    SELECT b.branch_code, b.city, b.state,
           (SELECT count(DISTINCT account_id) FROM raw_accounts a WHERE a.branch_code = b.branch_code) AS total_accounts,
           (SELECT count(DISTINCT client_id) FROM raw_accounts a JOIN raw_clients USING (client_id) WHERE a.branch_code = b.branch_code) AS total_clients,
           (SELECT count(*) FROM raw_employees e WHERE e.branch_id = b.branch_id) AS total_employees,
           (SELECT sum(current_balance) FROM raw_account_balances JOIN raw_accounts a USING (account_id) WHERE a.branch_code = b.branch_code) AS total_deposits,
           (SELECT {mean('current_balance')} FROM raw_account_balances JOIN raw_accounts a USING (account_id) WHERE a.branch_code = b.branch_code) AS avg_account_balance,
           (SELECT count(*) FROM raw_cards JOIN raw_accounts a USING (account_id) WHERE a.branch_code = b.branch_code) AS cards_issued,
           (SELECT sum(amount) FROM raw_transactions t JOIN raw_accounts a ON t.from_account_id = a.account_id
             WHERE t.status = 'COMPLETED' AND a.branch_code = b.branch_code) AS total_transaction_volume
    FROM raw_branches b""")(lambda k: reports.branch_comparison(k.stage, fanout_safe=True))

check("aq_credit_applications", f"""
    SELECT purpose, status, count(*) AS application_count, {mean('requested_amount')} AS avg_requested_amount,
           {mean('approved_amount')} AS avg_approved_amount, sum(requested_amount) AS total_requested,
           sum(approved_amount) AS total_approved,
           {half_up("count(*) FILTER (status = 'APPROVED') * 100", 'count(*)')} AS approval_rate,
           {mean('interest_rate_proposed')} AS avg_proposed_rate
    FROM raw_credit_applications GROUP BY ALL""")(lambda k: reports.credit_application_stats(k.stage))

check("aq_monthly_clients", f"""
    SELECT year(transaction_date) AS year, month(transaction_date) AS month,
           count(DISTINCT from_account_id) AS active_accounts, count(DISTINCT c.client_id) AS active_clients,
           count(*) AS total_transactions, sum(amount) AS transaction_volume, {mean('amount')} AS avg_transaction_size,
           count(DISTINCT category) AS unique_categories
    FROM raw_transactions t JOIN raw_accounts a ON a.account_id = t.from_account_id JOIN raw_clients c USING (client_id)
    WHERE t.status = 'COMPLETED' GROUP BY ALL""")(lambda k: reports.monthly_clients(k.stage))

check("aq_segmentation", f"""
    SELECT risk_category, employment_status,
           CASE WHEN annual_income < 50000 THEN 'Low Income' WHEN annual_income <= 100000 THEN 'Medium Income'
                ELSE 'High Income' END AS income_segment,
           count(*) AS client_count, {mean('credit_score')} AS avg_credit_score, {mean('annual_income')} AS avg_income,
           count(DISTINCT a.account_id) AS accounts_per_client, {mean('current_balance')} AS avg_balance,
           count(DISTINCT loan_id) AS total_loans,
           count(*) FILTER (starts_with(delinquency_status, 'DELINQUENT')) AS delinquent_loans
    FROM raw_clients c LEFT JOIN raw_accounts a ON a.client_id = c.client_id
    LEFT JOIN raw_account_balances ab ON ab.account_id = a.account_id
    LEFT JOIN raw_contracts k ON k.client_id = c.client_id LEFT JOIN raw_loans l ON l.contract_id = k.contract_id
    GROUP BY ALL""")(lambda k: reports.segmentation(k.stage))

check("aq_cards", f"""
    SELECT card_type, card_level, k.status AS card_status, count(DISTINCT card_id) AS card_count,
           count(DISTINCT k.client_id) AS unique_clients, {mean('credit_score')} AS avg_client_credit_score,
           sum(credit_limit) AS total_credit_limit, sum(current_balance) AS total_balance,
           count(DISTINCT transaction_id) AS total_transactions,
           sum(CASE WHEN t.status = 'COMPLETED' THEN amount ELSE 0 END) AS total_spent,
           {mean("CASE WHEN t.status = 'COMPLETED' THEN amount END")} AS avg_transaction_amount,
           count(DISTINCT category) AS spending_categories
    FROM raw_cards k JOIN raw_clients c ON c.client_id = k.client_id JOIN raw_accounts a ON a.account_id = k.account_id
    JOIN raw_account_balances ab ON ab.account_id = a.account_id
    LEFT JOIN raw_transactions t ON t.from_account_id = a.account_id GROUP BY ALL""")(
    lambda k: reports.card_usage(k.stage))

# --- over gold; the month is one the data covers ------------------------------------
Y, M = 2001, 10
check("gq_volume_by_segment", f"""
    SELECT client_segment, transaction_type, transaction_date, sum(transaction_count) AS total_transactions,
           sum(total_amount) AS total_volume,
           {half_up("sum(CAST(round(avg_amount * 100) AS BIGINT))", '(count(avg_amount) * 100)')} AS avg_transaction_size,
           {half_up("sum(CAST(round(success_rate * 100) AS BIGINT))", '(count(success_rate) * 100)')} AS avg_success_rate
    FROM gd_fact_transactions_daily JOIN gd_dim_client USING (client_id) WHERE year = {Y} AND month = {M}
    GROUP BY ALL""")(lambda k: reports.volume_by_segment(k.gold, Y, M))

check("gq_top_branches", f"""
    SELECT branch_id, branch_name, region, total_employees, active_employees, total_clients, total_accounts,
           total_deposits, total_loans_issued,
           {half_up("CAST(round(total_revenue_mtd * 100000) AS BIGINT)", '100000')} AS revenue_mtd,
           avg_account_balance AS avg_balance, {half_up(cents('total_deposits'), 'total_employees * 100')} AS deposits_per_employee
    FROM gd_branch_performance_dashboard WHERE total_employees > 0
    ORDER BY total_revenue_mtd DESC, branch_id LIMIT 10""")(lambda k: reports.top_branches({"branch_performance_dashboard": k.gold["branch_performance"]}))

check("gq_vip_360", """
    SELECT client_id, full_name, client_segment, age, city, credit_score, credit_score_category, total_accounts,
           active_accounts, total_balance, total_cards, active_cards, total_loans, active_loans, total_loan_amount,
           total_outstanding_balance AS outstanding_balance, transactions_30d, transaction_volume_30d AS volume_30d,
           days_since_last_transaction, channel_preference
    FROM gd_client_360_view WHERE client_segment = 'VIP' ORDER BY total_balance DESC, client_id LIMIT 20""")(
    lambda k: reports.vip_360(k.gold))

check("gq_product_compare", f"""
    SELECT product_id, product_name, product_type, product_category, total_clients, active_clients, total_contracts,
           active_contracts, total_contract_value, avg_contract_value,
           {half_up("CAST(round(total_revenue_mtd * 10000) AS BIGINT)", '10000')} AS revenue_mtd,
           {half_up("CAST(round(total_revenue_ytd * 10000) AS BIGINT)", '10000')} AS revenue_ytd,
           retention_rate, client_growth_rate FROM gd_product_performance_summary""")(
    lambda k: reports.product_compare(k.gold))

check("gq_balance_trends", f"""
    SELECT snapshot_date, account_type, branch_code, count(DISTINCT account_id) AS account_count,
           sum(current_balance) AS total_balance, {mean('current_balance')} AS avg_balance,
           sum(available_balance) AS total_available, {mean('credit_utilization')} AS avg_credit_utilization,
           sum(balance_change_daily) AS daily_change
    FROM gd_fact_account_balance_daily WHERE year = {Y} AND month = {M} GROUP BY ALL""")(
    lambda k: reports.balance_trends(k.gold, Y, M))

check("gq_segment_summary", f"""
    SELECT client_segment, count(*) AS client_count, {half_up('sum(credit_score)', 'count(credit_score)', 0)} AS avg_credit_score,
           {mean('total_balance')} AS avg_balance, {half_up('sum(transactions_30d)', 'count(*)', 1)} AS avg_monthly_transactions
    FROM gd_client_360_view GROUP BY ALL""")(lambda k: reports.segment_summary(k.gold))

check("gq_monthly_volume", f"""
    SELECT year, month, sum(transaction_count) AS total_transactions, sum(total_amount) AS total_volume,
           {half_up("sum(CAST(round(avg_amount * 100) AS BIGINT))", '(count(avg_amount) * 100)')} AS avg_transaction_amount
    FROM gd_fact_transactions_daily GROUP BY ALL ORDER BY year DESC, month DESC LIMIT 12""")(
    lambda k: reports.monthly_volume(k.gold))

check("gq_product_top", f"""
    SELECT product_id, product_name, product_type, total_clients, active_clients, total_contract_value AS total_value,
           {half_up("CAST(round(total_revenue_mtd * 10000) AS BIGINT)", '10000')} AS monthly_revenue
    FROM gd_product_performance_summary ORDER BY total_contract_value DESC, product_id LIMIT 10""")(
    lambda k: reports.product_top(k.gold))

check("gq_branch_top", """
    SELECT branch_id, branch_name, city, total_accounts, total_clients, total_deposits, revenue_rank AS performance_rank
    FROM gd_branch_performance_dashboard ORDER BY revenue_rank, branch_id LIMIT 10""")(lambda k: reports.branch_top(k.gold))

check("gq_suspicious_total", f"""
    SELECT count(*) AS total_suspicious, sum(amount) AS total_suspicious_amount, {mean('amount')} AS avg_suspicious_amount
    FROM sv_transactions WHERE is_suspicious""")(lambda k: reports.suspicious_total(k.silver["transactions"]))
