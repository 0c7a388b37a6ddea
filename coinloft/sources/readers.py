"""Typed readers and layer tables."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import cut_lineage

CORRUPT = "_corrupt_record"
CSV = {
    "header": "true", "sep": ",", "quote": '"', "escape": "\\", "encoding": "UTF-8", "mode": "PERMISSIVE",
    "columnNameOfCorruptRecord": CORRUPT,
}
FORMATS = ("parquet", "csv", "json", "orc", "avro")


def _schema(schema: str | T.StructType) -> T.StructType:
    return T.StructType.fromDDL(schema) if isinstance(schema, str) else schema


def read_csv_typed(spark: SparkSession, path: str, schema: str | T.StructType) -> DataFrame:
    """Declared columns plus ``_corrupt_record``; empty fields are NULL."""
    full = T.StructType([*_schema(schema).fields, T.StructField(CORRUPT, T.StringType())])
    return spark.read.schema(full).options(**CSV).csv(path)


def validate_records(spark: SparkSession, path: str, schema: str | T.StructType) -> tuple[DataFrame, DataFrame]:
    """(good, rejects). The files are parsed once, into the shared folder."""
    rows = cut_lineage(read_csv_typed(spark, path, schema), "validated")
    return rows.where(F.col(CORRUPT).isNull()).drop(CORRUPT), rows.where(F.col(CORRUPT).isNotNull())


def read_any_format(spark: SparkSession, path: str, fmt: str, schema: str | T.StructType | None = None) -> DataFrame:
    if fmt not in FORMATS:
        raise ValueError(f"format {fmt!r} is not one of {FORMATS}")
    reader = spark.read.format(fmt)
    if schema is not None:
        reader = reader.schema(_schema(schema))
    if fmt == "csv":
        reader = reader.options(**{k: v for k, v in CSV.items() if k != "columnNameOfCorruptRecord"})
    try:
        return reader.load(path)
    except Exception as error:
        if fmt == "avro" and "avro" in str(error).lower():
            raise RuntimeError("reading Avro needs the spark-avro package on the class path") from error
        raise


def format_compare(frames: Mapping[str, DataFrame]) -> DataFrame:
    """Row count per storage format."""
    out = None
    for name, df in frames.items():
        one = df.agg(F.count("*").alias("row_count")).select(F.lit(name).alias("format"), "row_count")
        out = one if out is None else out.unionByName(one)
    return out


def read_table(spark: SparkSession, root: str, layer: str, name: str) -> DataFrame:
    """A layer table by path, or by catalog name when ``root`` is empty."""
    return spark.read.parquet(f"{root}/{layer}/{name}") if root else spark.table(f"{layer}.{name}")


def partitioned_read(df: DataFrame, slices: Mapping[str, int]) -> DataFrame:
    """Compare partition columns to constants, so that only matching folders are listed and read."""
    for column, value in slices.items():
        df = df.where(F.col(column) == value)
    return df
