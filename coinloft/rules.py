"""Business rules as data. Code lists, cut points, weights and
patterns below are part of the table definitions and must not drift."""

from __future__ import annotations

from decimal import Decimal

RULES_VERSION = "1.2.0"

# --- synonyms -> standard code (compared after upper(trim())) ---------------

PRODUCT_CATEGORY = {
    "CREDIT": ["LOAN", "MORTGAGE", "CREDIT_CARD", "CREDIT_LINE"],
    "DEPOSIT": ["CHECKING", "SAVINGS", "DEPOSIT"],
    "INVESTMENT": ["INVESTMENT", "MUTUAL_FUND", "RETIREMENT"],
}
CONTRACT_STATUS = {
    "ACTIVE": ["ACTIVE", "ACTIVATED", "OPEN"],
    "CLOSED": ["CLOSED", "TERMINATED", "COMPLETED"],
    "SUSPENDED": ["SUSPENDED", "FROZEN"],
    "PENDING": ["PENDING", "PENDING_ACTIVATION"],
}
ACCOUNT_TYPE = {
    "CHECKING": ["CHECKING", "CURRENT", "CHK"],
    "SAVINGS": ["SAVINGS", "SAV", "DEPOSIT"],
    "LOAN": ["CREDIT", "LOAN", "LENDING"],
    "INVESTMENT": ["INVESTMENT", "INV"],
}
ACCOUNT_STATUS = {
    "ACTIVE": ["ACTIVE", "OPEN"],
    "CLOSED": ["CLOSED", "TERMINATED"],
    "SUSPENDED": ["SUSPENDED", "FROZEN"],
    "DORMANT": ["DORMANT", "INACTIVE"],
}
TRANSACTION_TYPE = {
    "DEPOSIT": ["DEPOSIT", "DEP", "CREDIT"],
    "WITHDRAWAL": ["WITHDRAWAL", "WD", "DEBIT"],
    "TRANSFER": ["TRANSFER", "TRF", "XFER"],
    "PAYMENT": ["PAYMENT", "PAY", "PMT"],
    "FEE": ["FEE", "CHARGE"],
}
TRANSACTION_STATUS = {
    "COMPLETED": ["COMPLETED", "SUCCESS", "SUCCESSFUL"],
    "PENDING": ["PENDING", "PROCESSING", "IN_PROGRESS"],
    "FAILED": ["FAILED", "DECLINED", "REJECTED"],
    "CANCELLED": ["CANCELLED", "CANCELED", "REVERSED"],
}
TRANSACTION_CATEGORY = {
    "GROCERIES": ["GROCERIES", "GROCERY", "FOOD"],
    "DINING": ["RESTAURANT", "DINING", "FOOD_DINING"],
    "TRANSPORTATION": ["TRANSPORT", "TRANSPORTATION", "TRAVEL"],
    "UTILITIES": ["UTILITIES", "UTILITY", "BILLS"],
    "ENTERTAINMENT": ["ENTERTAINMENT", "LEISURE"],
    "SHOPPING": ["SHOPPING", "RETAIL"],
    "HEALTHCARE": ["HEALTHCARE", "HEALTH", "MEDICAL"],
    "INSURANCE": ["INSURANCE", "INS"],
    "SALARY": ["SALARY", "INCOME", "PAYROLL"],
}
CARD_STATUS = {
    "ACTIVE": ["ACTIVE", "ACTIVATED"],
    "BLOCKED": ["BLOCKED", "FROZEN", "SUSPENDED"],
    "EXPIRED": ["EXPIRED", "INACTIVE"],
    "CANCELLED": ["CANCELLED", "CLOSED"],
}
APPLICATION_STATUS = {
    "APPROVED": ["APPROVED", "ACCEPTED"],
    "REJECTED": ["REJECTED", "DECLINED", "DENIED"],
    "PENDING": ["PENDING", "UNDER_REVIEW", "IN_REVIEW"],
    "WITHDRAWN": ["WITHDRAWN", "CANCELLED"],
}
STATE_CODE = {
    "CA": ["CALIFORNIA", "CA"],
    "TX": ["TEXAS", "TX"],
    "NY": ["NEW YORK", "NY"],
    "FL": ["FLORIDA", "FL"],
    "IL": ["ILLINOIS", "IL"],
}
COUNTRY_REGION = {
    "NORTH_AMERICA": ["US"],
    "EUROPE": ["UK", "DE", "FR", "IT", "ES"],
}
STATE_REGION = {
    "WEST": ["CA", "WA", "OR", "NV", "AZ"],
    "SOUTH": ["TX", "OK", "LA", "AR"],
    "NORTHEAST": ["NY", "NJ", "PA", "MA", "CT"],
    "MIDWEST": ["IL", "MI", "OH", "IN", "WI"],
}

# --- the looser code lists of the second rule set; other values pass through --

LOOSE_PRODUCT_CATEGORY = {
    "LENDING": ["LOAN", "CREDIT"],
    "DEPOSITS": ["SAVINGS", "CHECKING"],
    "CARDS": ["CARD", "DEBIT", "CREDIT_CARD"],
}
LOOSE_ACCOUNT_TYPE = {
    "CHECKING": ["CHECKING", "CURRENT"],
    "SAVINGS": ["SAVINGS", "DEPOSIT"],
    "LOAN": ["LOAN", "CREDIT"],
}
LOOSE_ACCOUNT_STATUS = {
    "ACTIVE": ["ACTIVE", "OPEN"],
    "CLOSED": ["CLOSED", "TERMINATED"],
    "SUSPENDED": ["SUSPENDED", "BLOCKED", "FROZEN"],
    "DORMANT": ["DORMANT", "INACTIVE"],
}
LOOSE_TRANSACTION_TYPE = {
    "DEPOSIT": ["DEPOSIT", "CREDIT"],
    "WITHDRAWAL": ["WITHDRAWAL", "DEBIT"],
    "TRANSFER": ["TRANSFER", "P2P"],
    "PAYMENT": ["PAYMENT", "PURCHASE"],
}
LOOSE_TRANSACTION_STATUS = {
    "COMPLETED": ["COMPLETED", "SUCCESS", "SUCCESSFUL"],
    "PENDING": ["PENDING", "PROCESSING"],
    "FAILED": ["FAILED", "ERROR"],
    "CANCELLED": ["CANCELLED", "CANCELED"],
}
LOOSE_TRANSACTION_CATEGORY = {
    "SALARY": ["SALARY", "INCOME"],
    "SHOPPING": ["SHOPPING", "RETAIL"],
    "FOOD_DINING": ["FOOD", "GROCERIES", "RESTAURANT"],
    "TRANSPORT": ["TRANSPORT", "TRANSPORTATION"],
    "ENTERTAINMENT": ["ENTERTAINMENT", "LEISURE"],
}

# --- ordered LIKE rules ------------------------------------------------------

DELINQUENCY = [
    ("%CURRENT%", "CURRENT"),
    ("%30%", "DELINQUENT_30"),
    ("%60%", "DELINQUENT_60"),
    ("%90%", "DELINQUENT_90"),
    ("%120%", "DELINQUENT_120_PLUS"),
]
REJECTION_REASON = [
    ("%CREDIT%SCORE%", "LOW_CREDIT_SCORE"),
    ("%INCOME%", "INSUFFICIENT_INCOME"),
    ("%DEBT%", "HIGH_DEBT_RATIO"),
    ("%EMPLOYMENT%", "EMPLOYMENT_ISSUES"),
]

# --- bands: (exclusive upper bound, label) ..., then the label above all -----

CREDIT_SCORE_BAND = ([(580, "POOR"), (670, "FAIR"), (740, "GOOD"), (800, "VERY_GOOD")], "EXCELLENT")
INCOME_BAND = (
    [(30000, "LOW"), (60000, "LOWER_MIDDLE"), (100000, "MIDDLE"), (150000, "UPPER_MIDDLE")],
    "HIGH",
)
LOOSE_INCOME_BAND = ([(30000, "LOW"), (75000, "MEDIUM"), (150000, "HIGH")], "VERY_HIGH")
SALARY_BAND = ([(40000, "LOW"), (70000, "MEDIUM"), (100000, "HIGH")], "VERY_HIGH")
BALANCE_BAND = ([(1000, "LOW"), (10000, "MEDIUM"), (100000, "HIGH")], "VERY_HIGH")
AGE_BAND = (
    [(25, "18-24"), (35, "25-34"), (45, "35-44"), (55, "45-54"), (65, "55-64")],
    "65+",
)
# (inclusive upper bound, label) ...
LTV_BAND = (
    [(Decimal("0.60"), "LOW_RISK"), (Decimal("0.80"), "MEDIUM_RISK"), (Decimal("0.95"), "HIGH_RISK")],
    "VERY_HIGH_RISK",
)
# (inclusive lower bound, label) ..., then the label below all
SCORE_BUCKET = (
    [
        (Decimal("0.9"), "Excellent (0.9-1.0)"),
        (Decimal("0.8"), "Good (0.8-0.9)"),
        (Decimal("0.7"), "Fair (0.7-0.8)"),
    ],
    "Poor (<0.7)",
)
FREQUENCY_BAND = ([(20, "DAILY"), (4, "WEEKLY"), (1, "MONTHLY")], "INACTIVE")
RISK_SCORE_BAND = (
    [(750, "LOW_RISK"), (600, "MEDIUM_RISK"), (400, "HIGH_RISK")],
    "VERY_HIGH_RISK",
)
CHURN_BAND = ([(70, "HIGH"), (40, "MEDIUM")], "LOW")
GRADE_BAND = ([(90, "A"), (80, "B"), (70, "C"), (60, "D")], "F")

# (income above, score above, segment) in order, then the rest
SEGMENTS = [(150000, 750, "VIP"), (100000, 700, "PREMIUM"), (50000, 650, "REGULAR")]
SEGMENT_REST = "BASIC"

# --- data quality ------------------------------------------------------------

CLIENT_WEIGHTS = {
    "first_name": Decimal("0.10"),
    "last_name": Decimal("0.10"),
    "email": Decimal("0.15"),
    "phone": Decimal("0.15"),
    "birth_date": Decimal("0.10"),
    "address": Decimal("0.10"),
    "city": Decimal("0.10"),
    "credit_score": Decimal("0.10"),
    "annual_income": Decimal("0.10"),
}
EMAIL_PATTERN = r"^[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}$"
PHONE_PATTERN = r"^\d{10,15}$"
SCORE_RANGE = (300, 850)
SENSITIVE_TABLES = "(clients|accounts|transactions|credit_applications)"

# (field, rule, argument, severity)
CLIENT_RULES = [
    ("client_id", "required", None, "critical"),
    ("first_name", "required", None, "major"),
    ("last_name", "required", None, "major"),
    ("email", "required", None, "critical"),
    ("email", "regex", EMAIL_PATTERN, "major"),
    ("phone", "regex", PHONE_PATTERN, "minor"),
    ("credit_score", "range", SCORE_RANGE, "major"),
    ("annual_income", "not_negative", None, "major"),
]
TRANSACTION_RULES = [
    ("transaction_id", "required", None, "critical"),
    ("from_account_id", "required", None, "critical"),
    ("amount", "required", None, "critical"),
    ("transaction_date", "required", None, "critical"),
    ("amount", "not_zero", None, "major"),
    ("amount", "min", Decimal("0.01"), "major"),
    ("status", "in_list", ["COMPLETED", "PENDING", "FAILED", "CANCELLED"], "minor"),
    ("transaction_type", "in_list", ["DEPOSIT", "WITHDRAWAL", "TRANSFER", "PAYMENT"], "minor"),
]
THRESHOLDS = {
    "min_score": {"development": "0.70", "staging": "0.80", "production": "0.90", "default": "0.85"},
    "max_null_rate": "0.10",
    "max_duplicate_rate": "0.02",
    "min_rows": {"clients": 1000, "products": 10, "transactions": 5000, "accounts": 1000, "branches": 10},
}
SUSPICIOUS_AMOUNT = 10000
NIGHT_HOURS = (0, 4)
HOLIDAYS = [(1, 1, "New Year Day"), (7, 4, "Independence Day"), (12, 25, "Christmas")]
CANARY_STAGES = [("canary_1", 5), ("canary_2", 25), ("canary_3", 50), ("full_rollout", 100)]
CANARY_ERROR_LIMIT = "0.05"
