"""Writers and upkeep of partitioned tables kept as folders of Parquet files."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterator, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from functools import reduce
from operator import and_, or_
from urllib.parse import unquote

from pyspark import inheritable_thread_target
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..session import SETTINGS


def _spread(df: DataFrame, partition_cols: Sequence[str]) -> DataFrame:
    """Cluster rows by output partition.

    Without this every task writes a small file into every partition. The
    rebalance hint lets AQE split a hot partition over many tasks and join small
    ones, both towards the advisory partition size.
    """
    return df.hint("rebalance", *partition_cols) if partition_cols else df


ADVISORY = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
FILE_MB = 64  # of a written file as it is shuffled, Spark's own default


@contextmanager
def _file_size(spark: SparkSession, target_mb: int | None) -> Iterator[None]:
    """The size that AQE joins and splits partitions to. Without a target the size for files, unless the session's owner has set one."""
    before = spark.conf.get(ADVISORY, None)
    if target_mb is None and before not in (None, SETTINGS[ADVISORY]):
        yield
        return
    spark.conf.set(ADVISORY, f"{target_mb or FILE_MB}MB")
    try:
        yield
    finally:
        spark.conf.set(ADVISORY, before) if before else spark.conf.unset(ADVISORY)


def _write(
    df: DataFrame, path: str, mode: str, partition_cols: Sequence[str], overwrite: str, target_mb: int | None = None, spread: bool = True
) -> None:
    writer = (_spread(df, partition_cols) if spread else df).write.mode(mode)
    if mode == "overwrite":
        writer = writer.option("partitionOverwriteMode", overwrite)
    if partition_cols:
        writer = writer.partitionBy(*partition_cols)
    with _file_size(df.sparkSession, target_mb):
        writer.parquet(path)


def exists(spark, path: str) -> bool:
    """The folder holds data of an earlier write."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder, if it is there."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def write_append(df: DataFrame, path: str, partition_cols: Sequence[str] = ()) -> None:
    _write(df, path, "append", partition_cols, "static")


def write_full_refresh(df: DataFrame, path: str, partition_cols: Sequence[str] = ()) -> None:
    """Replace the whole table."""
    _write(df, path, "overwrite", partition_cols, "static")


def write_partition_overwrite(df: DataFrame, path: str, partition_cols: Sequence[str], spread: bool = True) -> None:
    """Replace only the partitions present in ``df``. Rows that are clustered already need not be spread again."""
    _write(df, path, "overwrite", partition_cols, "dynamic", spread=spread)


def write_orc_copy(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("compression", "snappy").orc(path)


def write_bucketed(df: DataFrame, table: str, key: str, buckets: int = 32, path: str | None = None) -> None:
    """A catalog table bucketed and sorted by its join key: joins on that key need no shuffle."""
    writer = df.write.mode("overwrite").bucketBy(buckets, key).sortBy(key)
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(table)


def export_csv(df: DataFrame, path: str, order: Sequence[str], single_file: bool = False) -> None:
    """Sorted CSV with header. Files are ranges in order; ``single_file`` is for small extracts only."""
    ordered = df.orderBy(*order)
    out = ordered.coalesce(1) if single_file else ordered
    out.write.mode("overwrite").option("header", True).csv(path)


NULL_FOLDER = "__HIVE_DEFAULT_PARTITION__"


def _stored_partitions(df: DataFrame, path: str, cols: Sequence[str]) -> list[Row] | None:
    """A row per partition with its values, folder and bytes; None unless ``df`` is read from a table stored by these columns elsewhere."""
    file, size = F.col("_metadata.file_path").alias("stored_file"), F.col("_metadata.file_size").alias("stored_size")
    if not df.inputFiles():
        return None
    try:
        files = df.select(*cols, file, size)
    except AnalysisException:  # not from one table
        return None
    above = r"((?:/[^/]*){%d})/[^/]*$" % len(cols)
    folders = files.distinct().groupBy(
        *cols, F.regexp_extract("stored_file", above, 1).alias("stored_folder"), F.regexp_replace("stored_file", above, "").alias("stored_root")
    ).agg(F.sum("stored_size").alias("stored_bytes")).collect()  # partitions, not rows
    place = lambda p: unquote(p).split(":", 1)[-1].strip("/")
    target = place(str(df.sparkSession._jvm.org.apache.hadoop.fs.Path(path)))
    for r in folders:
        names, values = zip(*(part.partition("=")[::2] for part in unquote(r["stored_folder"]).strip("/").split("/")))
        own = all(v == NULL_FOLDER if r[c] is None else unquote(v) == str(r[c]) for c, v in zip(cols, values))
        root = place(r["stored_root"])
        if list(names) != list(cols) or not own or f"{target}/".startswith(f"{root}/") or f"{root}/".startswith(f"{target}/"):
            return None
    return folders if len({r["stored_folder"] for r in folders}) == len({tuple(r[c] for c in cols) for r in folders}) == len(folders) else None


def compact_partitions(df: DataFrame, path: str, partition_cols: Sequence[str], target_mb: int = 256) -> None:
    """Rewrite the table into a new folder with files of about the target size.

    A stored table's rows lie in their partitions' folders already: each folder's files are read by as many tasks as files of the
    target size come of them and written to the folder of the same name, so no row is shuffled, nor sorted by its partition.
    Rows that are not stored by these columns are clustered first.
    """
    spark, cols = df.sparkSession, list(partition_cols)
    partitions = _stored_partitions(df, path, cols)
    if not partitions:
        _write(df, path, "overwrite", cols, "static", target_mb)
        return
    remove(spark, path)

    def pack(part: Row) -> None:
        own = reduce(and_, [F.col(c).eqNullSafe(F.lit(part[c])) for c in cols])
        files = max(1, -(-part["stored_bytes"] // (target_mb << 20)))
        df.where(own).drop(*cols).coalesce(files).write.parquet(f"{path}{unquote(part['stored_folder'])}")

    with ThreadPoolExecutor(spark.sparkContext.defaultParallelism) as pool:
        list(pool.map(inheritable_thread_target(spark)(pack), partitions))


def compact_in_place(spark: SparkSession, path: str, partition_cols: Sequence[str], target_mb: float = 256) -> int:
    """Rewrite only the partitions that would have at most half as many files of the target size; returns how many.

    Files are packed into bins of about the target size, in order of name, by the sizes that the listing gives: a file
    larger than that is a bin of its own. Partitions not concerned are neither read nor written, and their files keep
    their names. Until the write is committed the old files stand, so a run that breaks off changes nothing.
    """
    target = int(target_mb * (1 << 20))
    cols, file = list(partition_cols), F.col("_metadata.file_path").alias("compact_file")
    # a listing: no file's content is read
    listed = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(path).select(*cols, file, F.col("_metadata.file_size").alias("compact_size"))
    before = F.sum("compact_size").over(W.partitionBy(*cols).orderBy("compact_file").rowsBetween(W.unboundedPreceding, -1))
    bins = listed.withColumn("compact_bin", F.floor(F.coalesce(before, F.lit(0)) / F.lit(target)))
    worth = bins.groupBy(*cols).agg(F.count("*").alias("files"), F.count_distinct("compact_bin").alias("bins")).where("files >= 2 * bins").select(*cols)
    worth = worth.collect()  # partitions, not rows
    if not worth:
        return 0
    rows = spark.read.parquet(path)
    touched = reduce(or_, [reduce(and_, [F.col(c).eqNullSafe(F.lit(r[c])) for c in cols]) for r in worth])
    packed = rows.where(touched).select("*", file).join(bins.select("compact_file", "compact_bin"), "compact_file")
    packed = packed.repartition(*cols, "compact_bin").select(*rows.columns)
    packed.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*cols).parquet(path)
    return len(worth)


def collect_statistics(df: DataFrame, exact: bool = False) -> DataFrame:
    """Row count, NULLs, distinct values and extremes per column.

    One pass when distinct values are estimated. The exact form counts
    (column, value) pairs in one shuffle of its own.
    """
    stats = df.agg(
        F.count("*").alias("rows"),
        *[
            F.struct(
                F.count_if(F.col(c).isNull()).alias("nulls"),
                F.min(c).cast("string").alias("low"),
                F.max(c).cast("string").alias("high"),
                (F.lit(0) if exact else F.approx_count_distinct(c)).alias("ndv"),
            ).alias(f"s_{c}")
            for c in df.columns
        ],
    )
    each = F.explode(
        F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(f"s_{c}").alias("s")) for c in df.columns])
    )
    out = stats.select("rows", each.alias("e")).select(
        "e.column_name", F.col("rows").alias("row_count"), F.col("e.s.nulls").alias("null_count"),
        F.col("e.s.ndv").alias("distinct_count"), F.col("e.s.low").alias("min_value"), F.col("e.s.high").alias("max_value"),
    )
    if not exact:
        return out
    cell = F.explode(
        F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("v")) for c in df.columns])
    )
    pairs = df.select(cell.alias("c")).select("c.*").distinct()
    counted = pairs.groupBy("column_name").agg(F.count("v").alias("distinct_count"))
    return out.drop("distinct_count").join(counted, "column_name")


def analyze_table(spark, table: str) -> None:
    """Catalog statistics for the optimizer."""
    spark.sql(f"ANALYZE TABLE {table} COMPUTE STATISTICS FOR ALL COLUMNS")


def partition_counts(df: DataFrame, partition_cols: Sequence[str]) -> DataFrame:
    """Partitions with their row counts. On a partitioned Parquet read only footers and folder names are needed."""
    return df.groupBy(*partition_cols).agg(F.count("*").alias("row_count"))


def list_partitions(df: DataFrame, partition_cols: Sequence[str]) -> DataFrame:
    return df.select(*partition_cols).distinct()


# --- retention --------------------------------------------------------------------


def _expired(as_of: dt.date, months: int, year: str, month: str) -> Column:
    """The month started before the cutoff of ``months`` * 30 days."""
    cutoff = as_of - dt.timedelta(days=months * 30)
    return F.make_date(F.col(year), F.col(month), F.lit(1)) < F.lit(cutoff)


def _old_year(as_of: dt.date, months: int, year: str) -> Column:
    """The year lies before the year that was current ``months`` months ago."""
    total = as_of.year * 12 + as_of.month - 1 - months
    return F.col(year) < total // 12


def retention_plan(
    df: DataFrame, as_of: dt.date, months: int = 24, year: str = "transaction_year", month: str = "transaction_month"
) -> DataFrame:
    """Partitions due for removal, with their row counts."""
    return partition_counts(df.where(_expired(as_of, months, year, month)), [year, month])


def archive_partitions(df: DataFrame, as_of: dt.date, months: int = 24, year: str = "transaction_year", month: str = "transaction_month") -> DataFrame:
    """Rows to copy to the archive, with the archive's partition columns."""
    return df.where(_old_year(as_of, months, year)).withColumn("archive_year", F.col(year)).withColumn(
        "archive_month", F.col(month)
    )


def purge_partitions(df: DataFrame, as_of: dt.date, months: int = 24, year: str = "transaction_year") -> DataFrame:
    """Rows that stay."""
    return df.where(~_old_year(as_of, months, year))


def drop_expired_partitions(spark, table: str, as_of: dt.date, months: int = 24, year: str = "transaction_year") -> None:
    """The catalog form: the partitions listed are dropped one by one, no rows are read."""
    first = (as_of.year * 12 + as_of.month - 1 - months) // 12
    for row in spark.sql(f"SHOW PARTITIONS {table}").collect():  # one row per partition
        spec = dict(part.split("=", 1) for part in row.partition.split("/"))
        if spec[year].isdigit() and int(spec[year]) < first:
            one = ", ".join(f"`{c}` = '{v}'" for c, v in spec.items())
            spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION ({one})")


# --- reports over several tables ----------------------------------------------------


def union_all_report(frames: Mapping[str, DataFrame], label: str = "table_name", **literals: Mapping[str, str]) -> DataFrame:
    """Row counts stacked, each with its label. ``literals``: column -> label -> text."""
    out = None
    for name, df in frames.items():
        one = df.agg(F.count("*").alias("record_count")).select(
            F.lit(name).alias(label), "record_count", *[F.lit(texts[name]).alias(c) for c, texts in literals.items()]
        )
        out = one if out is None else out.unionByName(one)
    return out


def custom_sort_order(df: DataFrame, column: str, values: Sequence[str]) -> DataFrame:
    """Order by the position of the value in a list; others come last."""
    position = F.array_position(F.array(*[F.lit(v) for v in values]), F.col(column))
    return df.withColumn("sort_position", F.when(position == 0, len(values) + 1).otherwise(position)).orderBy("sort_position")


def source_preflight(frames: Mapping[str, DataFrame]) -> DataFrame:
    counted = union_all_report(frames)
    return counted.withColumn("status", F.when(F.col("record_count") > 0, "OK").otherwise("ERROR: No data"))


def layer_reconcile(entities: Mapping[str, tuple[DataFrame, DataFrame, DataFrame, DataFrame]]) -> DataFrame:
    """Counts through stage, bronze, silver and gold per entity, with PASS or a warning."""
    out = None
    for name, layers in entities.items():
        counts = [df.agg(F.count("*")).scalar() for df in layers]
        row = layers[0].sparkSession.range(1).select(
            F.lit(name).alias("entity"),
            *[c.alias(f"{layer}_count") for c, layer in zip(counts, ("stage", "bronze", "silver", "gold"))],
        )
        out = row if out is None else out.unionByName(row)
    fine = (F.col("bronze_count") == F.col("stage_count")) & (F.col("silver_count") <= F.col("bronze_count"))
    return out.withColumn("validation_status", F.when(fine, "PASS").otherwise("WARNING: Check data flow"))


def scalar_row(frames: Mapping[str, DataFrame]) -> DataFrame:
    """One row of row counts, each a scalar subquery."""
    spark = next(iter(frames.values())).sparkSession
    return spark.range(1).select(*[df.agg(F.count("*")).scalar().alias(name) for name, df in frames.items()])


def freshness(layers: Mapping[str, tuple[DataFrame, str]]) -> DataFrame:
    """Rows and newest stamp per layer."""
    out = None
    for name, (df, stamp) in layers.items():
        one = df.agg(F.count("*").alias("row_count"), F.max(stamp).alias("newest")).select(
            F.lit(name).alias("layer"), "row_count", "newest"
        )
        out = one if out is None else out.unionByName(one)
    return out
