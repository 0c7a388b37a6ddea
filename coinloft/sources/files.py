"""A stage over a folder that holds the twelve declared tables as files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import source_schema
from .readers import read_any_format


class FileStage:
    """``{folder}/{table}`` (or ``{table}.{fmt}``) per table. CSV and JSON are read by the declared types; other formats are cast to them."""

    def __init__(self, spark: SparkSession, folder: str, fmt: str = "parquet", suffix: bool = False):
        self.spark, self.folder, self.fmt, self.suffix = spark, folder.rstrip("/"), fmt, suffix

    def source(self, name: str) -> DataFrame:
        path = f"{self.folder}/{name}" + (f".{self.fmt}" if self.suffix else "")
        return read_any_format(self.spark, path, self.fmt, source_schema(name) if self.fmt in ("csv", "json") else None)

    def table(self, name: str) -> DataFrame:
        """The declared columns in their order; columns that are not declared are left out, missing ones raise."""
        return self.source(name).select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in source_schema(name).fields])
