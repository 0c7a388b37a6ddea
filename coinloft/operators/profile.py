"""Profiles of tables, columns, layers and texts, and the quality dashboard."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import rules
from ..functions import clean
from .ranking import exact_percentiles


def _missing(column: str) -> Column:
    return F.col(column).isNull() | (F.col(column) == "")


def profile_table(
    tables: Mapping[str, tuple[DataFrame, str, Sequence[Column], str]], names: Sequence[str]
) -> DataFrame:
    """Totals, duplicates, counted defects, mean and deviation per table, stacked.

    Each table gives (frame, key, defect conditions, measured column); ``names``
    name the defect counts.
    """
    out = None
    for table, (df, key, defects, measure) in tables.items():
        one = df.agg(
            F.count("*").alias("total_records"),
            F.count_distinct(key).alias("unique_ids"),
            *[F.count_if(clean.is_true(d)).alias(n) for n, d in zip(names, defects)],
            clean.exact_ratio(F.sum(measure), F.count(measure)).alias("average"),
            F.round(F.stddev(measure), 2).alias("deviation"),
        ).select(
            F.lit(table).alias("table_name"), "total_records", "unique_ids",
            (F.col("total_records") - F.col("unique_ids")).alias("duplicate_count"), *names, "average", "deviation",
        )
        out = one if out is None else out.unionByName(one)
    return out


def client_defects() -> list[Column]:
    score = F.col("credit_score")
    return [_missing("email"), _missing("phone"), (score < 300) | (score > 850)]


def transaction_defects() -> list[Column]:
    known = ["COMPLETED", "PENDING", "FAILED", "CANCELLED"]
    amount = F.col("amount")
    return [amount.isNull() | (amount <= 0), F.col("transaction_date").isNull(), ~F.col("status").isin(*known)]


def profile_layers(layers: Mapping[str, DataFrame], table: str, key: str, columns: Sequence[str]) -> DataFrame:
    out = None
    for layer, df in layers.items():
        one = df.agg(
            F.count("*").alias("total_records"), F.count_distinct(key).alias("unique_keys"),
            F.count_if(F.col(key).isNull()).alias("null_keys"),
            *[F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in columns],
        ).select(F.lit(layer).alias("layer"), F.lit(table).alias("table_name"), "*")
        out = one if out is None else out.unionByName(one)
    return out


def profile_columns(
    df: DataFrame, numeric: Sequence[str], text: Sequence[str], formats: Mapping[str, str] | None = None
) -> DataFrame:
    """NULLs, distinct values, extremes, mean, deviation, quartiles and format mismatches per column.

    Columns are unpivoted to (column, value) and counted per distinct value
    first, so distinct counts and quartiles of all columns share one shuffle.
    """
    formats = formats or {}
    every = [*numeric, *text]
    bad = {c: clean.is_true(~F.col(c).rlike(formats[c])) if c in formats else F.lit(False) for c in every}
    cell = F.explode(F.array(*[
        F.struct(
            F.lit(c).alias("column_name"),
            F.col(c).cast("string").alias("label"),
            (F.col(c).cast("decimal(26,8)") if c in numeric else F.lit(None).cast("decimal(26,8)")).alias("number"),
            bad[c].alias("mismatch"),
        )
        for c in every
    ]))
    cells = df.select(cell.alias("c")).select("c.*")
    counted = cells.groupBy("column_name", "label", "number").agg(
        F.count("*").alias("n"), F.count_if("mismatch").alias("mismatch")
    )
    n, x = F.col("n"), F.col("number")
    known = F.when(F.col("label").isNotNull(), n)
    basics = counted.groupBy("column_name").agg(
        F.sum("n").alias("row_count"),
        F.coalesce(F.sum(F.when(F.col("label").isNull(), n)), F.lit(0)).alias("null_count"),
        F.count("label").alias("distinct_count"),
        F.sum("mismatch").alias("format_mismatches"),
        F.min(F.when(x.isNull(), F.col("label"))).alias("min_text"),
        F.max(F.when(x.isNull(), F.col("label"))).alias("max_text"),
        F.min(x).alias("min_number"),
        F.max(x).alias("max_number"),
        clean.exact_ratio(F.sum(x * n.cast("decimal(11,0)")), F.sum(F.when(x.isNotNull(), known))).alias("mean"),
    )
    quartiles = exact_percentiles(
        cells.where(x.isNotNull()), ["column_name"], "number", {"q1": 0.25, "median": 0.5, "q3": 0.75}
    )
    spread = cells.groupBy("column_name").agg(F.round(F.stddev(x.cast("double")), 2).alias("deviation"))
    return basics.join(spread, "column_name").join(quartiles, "column_name", "left")


def profile_text(df: DataFrame, key: str, text: str) -> DataFrame:
    """Empty texts, length figures and exact copies over whole texts, as one row."""
    body = F.coalesce(F.col(text), F.lit(""))
    copies = df.groupBy(F.sha2(body, 256).alias("digest"), F.length(body).alias("size")).agg(
        F.count("*").alias("n"), F.count_if(F.trim(body) == "").alias("empty")
    )
    n, size = F.col("n"), F.col("size")
    return copies.agg(
        F.sum(n).alias("total_records"),
        F.sum("empty").alias("empty_records"),
        F.min(size).alias("min_length"),
        F.max(size).alias("max_length"),
        clean.exact_ratio(F.sum(size * n), F.sum(n)).alias("avg_length"),
        F.count("*").alias("distinct_texts"),
        F.sum(n - 1).alias("duplicate_records"),
        F.max(n).alias("largest_group"),
    )


def data_quality_dashboard(
    tables: Mapping[str, tuple[DataFrame, str, Sequence[str], Column]], as_of: dt.date, run_ts: dt.datetime,
    database: str = "silver", stamp: str = "load_timestamp",
) -> DataFrame:
    """One row per table: volume, completeness, duplicates, format defects, score and grade.

    Each table gives (frame, key, critical columns, invalid-format condition).
    """
    out = None
    for table, (df, key, critical, invalid) in tables.items():
        complete = clean.all_of(F.col(c).isNotNull() for c in critical)
        nulls = F.lit(0)
        for c in critical:
            nulls = nulls + F.count_if(F.col(c).isNull())
        one = df.agg(
            F.count("*").alias("total_records"),
            F.count_if(F.to_date(stamp) == F.lit(as_of)).alias("new_records_today"),
            F.count_if(complete).alias("complete_records"),
            (F.count(key) - F.count_distinct(key)).alias("duplicate_records"),
            nulls.alias("null_critical_fields"),
            F.count_if(clean.is_true(invalid)).alias("invalid_format_records"),
        ).withColumn("table_name", F.lit(table))
        out = one if out is None else out.unionByName(one)
    total = F.col("total_records").cast("decimal(20,0)")
    part = lambda c: F.coalesce(F.try_divide(F.col(c).cast("decimal(20,0)"), total), F.lit(0))
    points = (
        part("complete_records") * 50 + (F.lit(1) - part("duplicate_records")) * 30
        + (F.lit(1) - part("invalid_format_records")) * 20
    )
    none = F.lit(None).cast("bigint")
    shaped = out.select(
        F.lit(as_of).alias("report_date"), "table_name", F.lit(database).alias("database_name"), "total_records",
        "new_records_today", none.alias("updated_records_today"), none.alias("deleted_records_today"), "complete_records",
        (F.col("total_records") - F.col("complete_records")).alias("incomplete_records"),
        clean.percent("complete_records", "total_records").cast("decimal(5,2)").alias("completeness_rate"),
        "duplicate_records", clean.percent("duplicate_records", "total_records").cast("decimal(5,2)").alias("duplicate_rate"),
        "null_critical_fields", "invalid_format_records", F.round(points, 2).cast("decimal(5,2)").alias("data_quality_score"),
    )
    counts = ["incomplete_records", "duplicate_records", "invalid_format_records"]
    return shaped.select(
        "*", clean.at_least("data_quality_score", rules.GRADE_BAND).alias("data_quality_grade"),
        F.col("incomplete_records").alias("critical_issues"), F.col("duplicate_records").alias("major_issues"),
        F.col("invalid_format_records").alias("minor_issues"),
        F.to_json(F.struct(*counts)).alias("issue_details"), F.lit(run_ts).alias("created_timestamp"),
        F.lit(as_of.year).alias("year"), F.lit(as_of.month).alias("month"),
    )
