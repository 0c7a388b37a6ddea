"""The registered queries opN_<name> and their SQL twins."""

from __future__ import annotations

import io
import os
import tempfile
import zipfile
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from coinloft.llm import chats, language, leaks, licences, manifest, mixing, near, neighbours, phrases, quality, secrets, sharding, toxicity

_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package's code to the executors, once per application."""
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    package = Path(__file__).resolve().parents[1]
    data = io.BytesIO()
    with zipfile.ZipFile(data, "w", zipfile.ZIP_DEFLATED) as z:
        for f in sorted(package.rglob("*.py")):
            z.write(f, f.relative_to(package.parent))
    folder = tempfile.mkdtemp(prefix="coinloft-code-")
    path = os.path.join(folder, "coinloft_code.zip")
    Path(path).write_bytes(data.getvalue())
    spark.sparkContext.addPyFile(path)  # Spark copies it to each executor
    _shipped.add(app)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_near_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near.near_copies(table(spark, sf_dir, "documents"))


def op3_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.scanned(table(spark, sf_dir, "documents"))


def op4_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.sharded(table(spark, sf_dir, "documents"))


def op5_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op6_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op7_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest(table(spark, sf_dir, "embeddings"))


def op8_chats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chats.digests(chats.with_trap(table(spark, sf_dir, "conversations")))


def op9_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.languages(table(spark, sf_dir, "documents"))


def op10_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaks.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op11_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest.verified(table(spark, sf_dir, "documents"))


def op12_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op13_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_quality, op2_near_copies, op3_licences, op4_shards, op5_mix, op6_secrets, op7_neighbours, op8_chats, op9_language, op10_leaks,
        op11_manifest, op12_toxicity, op13_phrases,
    )
}
# the others have learned models, seeded draws, iterated joins or digests that SQL lacks; their tests compare with brute force
SQL: dict[str, str] = {"op3_licences": licences.twin(), "op5_mix": mixing.twin(), "op8_chats": chats.twin(), "op11_manifest": manifest.twin(), "op13_phrases": phrases.twin()}
