"""Pairs of a Spark query and its SQL twin, and the common output types."""

from __future__ import annotations

import json
import re
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from coinloft.plans.lake import Lake

SPARK: dict[str, Callable[[Lake], DataFrame]] = {}
SQL: dict[str, str] = {}
STAMPS = ("load_timestamp", "process_timestamp", "created_timestamp", "updated_timestamp")
TYPES_FILE = Path(__file__).with_name("types.json")


def check(name: str, sql: str | None = None):
    def add(fn):
        assert name not in SPARK, name
        SPARK[name] = fn
        if sql:
            SQL[name] = sql
        return fn

    return add


def publish(df: DataFrame) -> DataFrame:
    """Run stamps dropped; whole numbers, doubles, texts and flags only, so that both engines compare."""
    out = []
    for field in df.schema.fields:
        if field.name in STAMPS:
            continue
        c = F.col(f"`{field.name}`")
        if isinstance(field.dataType, (T.DecimalType, T.FloatType)):
            c = c.cast("double")
        elif isinstance(field.dataType, T.IntegralType):
            c = c.cast("bigint")
        elif isinstance(field.dataType, (T.DateType, T.TimestampType, T.TimestampNTZType)):
            c = c.cast("string")
        out.append(c.alias(field.name))
    return df.select(*out)


def runner(name: str) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return publish(SPARK[name](Lake(spark, sf_dir)))

    run.__name__ = name
    return run


# --- SQL side ----------------------------------------------------------------

VIEWS: dict[str, str] = {}


def _needed(sql: str, seen: dict[str, None]) -> None:
    """View names in the text, innermost first."""
    for name in re.findall(r"\b(?:raw|br|sv|gd|ax)_\w+", sql):
        if name in VIEWS and name not in seen:
            _needed(VIEWS[name], seen)
            seen[name] = None


def with_views(sql: str) -> str:
    seen: dict[str, None] = {}
    _needed(sql, seen)
    if not seen:
        return sql
    parts = ",\n".join(f"{name} AS MATERIALIZED ({VIEWS[name]})" for name in seen)
    return f"WITH {parts}\n{sql}" if not sql.lstrip().upper().startswith("WITH ") else (
        f"WITH {parts},\n{sql.lstrip()[5:]}"
    )


SQL_TYPE = {"bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}


def typed(name: str) -> str:
    """The twin with every column cast to the type its query publishes."""
    sql = with_views(SQL[name])
    known = json.loads(TYPES_FILE.read_text()) if TYPES_FILE.exists() else {}
    if name not in known:
        return sql
    casts = ", ".join(f'CAST("{c}" AS {SQL_TYPE[t]}) AS "{c}"' for c, t in known[name].items())
    return f"SELECT {casts} FROM ({sql}) AS result"
