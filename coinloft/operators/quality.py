"""Data-quality scores, rules, quarantine and gates."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import rules
from ..functions import clean


def dq_score(weights: Mapping[str, Decimal]) -> Column:
    """Sum of the weights of the fields that are set, in decimals."""
    zero = F.lit(Decimal("0.00"))
    total = zero
    for field, weight in weights.items():
        total = total + F.when(F.col(field).isNotNull(), F.lit(weight)).otherwise(zero)
    return total.cast("decimal(3,2)")


def client_issues(email: str = "email") -> dict[str, Column]:
    """Issue code to condition, in report order."""
    low, high = rules.SCORE_RANGE
    score, income, mail = F.col("credit_score"), F.col("annual_income"), F.col(email)
    return {
        "missing_first_name": F.col("first_name").isNull(),
        "missing_last_name": F.col("last_name").isNull(),
        "missing_email": mail.isNull(),
        "invalid_email_format": ~mail.contains("@"),
        "missing_phone": F.col("phone").isNull(),
        "missing_birth_date": F.col("birth_date").isNull(),
        "missing_credit_score": score.isNull(),
        "invalid_credit_score": ~score.between(low, high),
        "missing_annual_income": income.isNull(),
        "negative_income": income < 0,
    }


SHORT_ISSUES = ("missing_first_name", "missing_last_name", "missing_email", "missing_phone", "missing_credit_score")


def dq_issues(conditions: Mapping[str, Column], separator: str = "; ", keep_empty: bool = False) -> Column:
    return clean.first_of(conditions, separator, keep_empty)


def violation(field: str, rule: str, argument) -> Column:
    """True where a value breaks the rule. A missing value only breaks ``required``."""
    c = F.col(field)
    tests = {
        "required": lambda: c.isNull(),
        "not_null": lambda: c.isNull(),
        "regex": lambda: ~c.rlike(argument),
        "range": lambda: ~c.between(*argument),
        "min": lambda: c < F.lit(argument),
        "not_negative": lambda: c < 0,
        "not_zero": lambda: c == 0,
        "in_list": lambda: ~c.isin(*argument),
        "allowed_values": lambda: ~c.isin(*argument),
    }
    return clean.is_true(tests[rule]())


def _flagged(df: DataFrame, rule_set: Sequence[tuple]) -> Column:
    return F.array(
        *[
            F.when(
                violation(field, rule, argument),
                F.struct(F.lit(field).alias("field"), F.lit(rule).alias("rule"), F.lit(severity).alias("severity")),
            )
            for field, rule, argument, severity in rule_set
        ]
    )


def dq_rules_eval(df: DataFrame, key: str, rule_set: Sequence[tuple]) -> DataFrame:
    """One row per broken rule and record: a narrow pass, no shuffle."""
    broken = F.filter(_flagged(df, rule_set), lambda v: v.isNotNull())
    return df.select(key, F.explode(broken).alias("v")).select(
        key, "v.field", "v.rule", "v.severity", F.lit(rules.RULES_VERSION).alias("rules_version")
    )


def dq_split_quarantine(df: DataFrame, rule_set: Sequence[tuple]) -> tuple[DataFrame, DataFrame]:
    """(good, quarantined). Records that break a critical rule are set aside with their reasons."""
    critical = [r for r in rule_set if r[3] == "critical"]
    reasons = F.concat_ws(
        "; ", *[F.when(violation(f, rule, arg), f"{f}:{rule}") for f, rule, arg, _ in critical]
    )
    marked = df.withColumn("quarantine_reason", reasons)
    good = marked.where(F.col("quarantine_reason") == "").drop("quarantine_reason")
    return good, marked.where(F.col("quarantine_reason") != "")


def dq_summary(df: DataFrame, score: str = "dq_score") -> DataFrame:
    c = F.col(score)
    return df.agg(
        F.count("*").alias("total_records"),
        F.round(F.avg(c), 3).alias("avg_dq_score"),
        F.min(c).alias("min_dq_score"),
        F.max(c).alias("max_dq_score"),
        F.count_if(c >= F.lit(Decimal("0.9"))).alias("excellent_quality"),
        F.count_if((c >= F.lit(Decimal("0.8"))) & (c < F.lit(Decimal("0.9")))).alias("good_quality"),
        F.count_if(c < F.lit(Decimal("0.8"))).alias("poor_quality"),
    )


def dq_buckets(df: DataFrame, score: str = "dq_score") -> DataFrame:
    band = clean.at_least(score, rules.SCORE_BUCKET)
    return df.groupBy(band.alias("quality_category")).agg(
        F.count("*").alias("client_count"), F.round(F.avg(score), 3).alias("avg_score")
    )


def dq_issue_frequency(df: DataFrame, issues: str = "dq_issues", score: str = "dq_score") -> DataFrame:
    return (
        df.where(F.col(score) < 1)
        .groupBy(issues)
        .agg(
            F.count("*").alias("issue_count"),
            F.round(F.avg(score), 3).alias("avg_dq_score"),
            F.min(score).alias("min_dq_score"),
        )
    )


def dq_issue_explode(df: DataFrame, issues: str = "dq_issues", separator: str = "; ") -> DataFrame:
    each = df.where(F.col(issues) != "").select(F.explode(F.split(issues, separator)).alias("issue"))
    return each.groupBy("issue").agg(F.count("*").alias("record_count"))


def worst_quality(df: DataFrame, key: str, threshold="0.8", k: int | None = 10) -> DataFrame:
    """Records below the threshold, lowest score first, ties by key. ``k=None`` returns them all."""
    low = df.where(F.col("dq_score") < F.lit(Decimal(threshold)))
    return low if k is None else low.orderBy("dq_score", key).limit(k)


def dq_threshold_gate(
    df: DataFrame, table: str, key: str, score: str, fields: Sequence[str], limits: Mapping = rules.THRESHOLDS,
    environment: str = "default",
) -> DataFrame:
    """One row: measured quality of a table against its limits, with PASS or FAIL."""
    nulls = sum((F.count_if(F.col(f).isNull()) for f in fields[1:]), F.count_if(F.col(fields[0]).isNull()))
    measured = df.agg(
        F.count("*").alias("row_count"),
        F.round(F.avg(score), 3).alias("avg_score"),
        clean.exact_ratio(nulls, F.count("*") * len(fields), 4).alias("null_rate"),
        clean.exact_ratio(F.count(key) - F.count_distinct(key), F.count("*"), 4).alias("duplicate_rate"),
    )
    passed = {
        "score_ok": F.col("avg_score") >= F.lit(Decimal(limits["min_score"][environment])),
        "null_ok": F.col("null_rate") <= F.lit(Decimal(limits["max_null_rate"])),
        "duplicate_ok": F.col("duplicate_rate") <= F.lit(Decimal(limits["max_duplicate_rate"])),
        "rows_ok": F.col("row_count") >= limits["min_rows"].get(table, 0),
    }
    checks = {name: clean.is_true(test) for name, test in passed.items()}
    return measured.select(
        F.lit(table).alias("table_name"), "*", *[c.alias(n) for n, c in checks.items()],
        F.when(clean.all_of(checks.values()), "PASS").otherwise("FAIL").alias("gate_status"),
    )


def temporal_checks(df: DataFrame, key: str, checks: Mapping[str, Column]) -> DataFrame:
    """One row per record and failed date check."""
    hits = F.array(*[F.when(clean.is_true(test), F.lit(name)) for name, test in checks.items()])
    return df.select(key, F.explode(F.filter(hits, lambda h: h.isNotNull())).alias("check_name"))
