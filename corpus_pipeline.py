"""Documents to training shards: quality, near copies, benchmark passages, source mix, shards."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from coinloft.llm import leaks, mixing, near, quality, sharding
from coinloft.llm.queries import ship, table
from coinloft.session import work_folder

# A learned model decides in the first stage, which SQL cannot express; tests compare with a brute-force version.
ORACLE_SQL: str | None = None


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose quality score is at least 0.3. Null and empty texts are scored like any others."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    ship(spark)
    return near.keep_one(docs)


def no_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark passage."""
    return leaks.without_leaks(docs, table(spark, sf_dir, "benchmark"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix of sources takes it."""
    ship(spark)
    return mixing.mixed_rows(docs)


def in_shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix in 40 shards of nearly equal bytes, with size, text_crc32, shard and slot."""
    ship(spark)
    return sharding.in_shards(docs)


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
STAGES: list[tuple[str, Stage]] = [
    ("quality", good_quality),
    ("near_copies", one_of_each),
    ("decontamination", no_benchmark),
    ("mixing", mixed),
    ("sharding", in_shards),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage's rows are written to the shared folder and read by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = work_folder(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
