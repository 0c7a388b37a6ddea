import datetime as dt
import random
from collections import Counter

import numpy as np
import pytest
from conftest import AS_OF
from pyspark.sql import functions as F

from coinloft.operators import aggs, history, joins, ledger, tables
from coinloft.operators.ranking import exact_percentiles, global_rank, value_positions
from coinloft.plans import gold
from coinloft.session import work_folder
from coinloft.sources import readers

RNG = random.Random(5)


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows share one key, a third one value; values span many ranges and signs."""
    rows = []
    for i in range(3000):
        key = "hot" if i % 3 == 0 else f"k{i % 40}"
        value = 7.25 if i % 3 == 1 else round(RNG.uniform(-5e6, 5e9) if i % 2 else RNG.uniform(-10, 10), 2)
        rows.append((i, key, None if i % 50 == 0 else value))
    return spark.createDataFrame(rows, "id BIGINT, key STRING, value DOUBLE").withColumn("value", F.col("value").cast("decimal(14,2)"))


def test_value_positions_count_every_row_ahead(skewed):
    values = [r.value for r in skewed.collect() if r.value is not None]
    counts = Counter(values)
    for r in value_positions(skewed, [], "value").collect():
        assert r.n == counts[r.value]
        assert r.before == sum(n for v, n in counts.items() if v < r.value)


def test_percentiles_match_numpy(skewed):
    points = {"p0": 0.0, "q1": 0.25, "p50": 0.5, "p99": 0.99, "p100": 1.0}
    groups = {}
    for r in skewed.collect():
        if r.value is not None:
            groups.setdefault(r.key, []).append(float(r.value))
    out = exact_percentiles(skewed, ["key"], "value", points).collect()
    assert len(out) == len(groups)
    for r in out:
        for name, p in points.items():
            assert r[name] == pytest.approx(np.percentile(groups[r.key], p * 100), rel=1e-12, abs=1e-9)
    whole = exact_percentiles(skewed, [], "value", points).first()
    flat = [v for g in groups.values() for v in g]
    assert whole.p50 == pytest.approx(np.percentile(flat, 50))


def test_global_rank_matches_brute_force(skewed):
    ranked = global_rank(skewed, "id", {"r": "value"}).collect()
    values = [r.value for r in ranked if r.value is not None]
    for r in ranked:
        want = 1 + (sum(v > r.value for v in values) if r.value is not None else len(values))
        assert r.r == want


def test_outliers(skewed):
    values = np.array([float(r.value) for r in skewed.collect() if r.value is not None])
    q1, q3 = np.percentile(values, [25, 75])
    out = aggs.outliers_iqr(skewed, "value").first()
    assert out.total_records == len(values)
    assert out.outlier_count == int(((values < q1 - 1.5 * (q3 - q1)) | (values > q3 + 1.5 * (q3 - q1))).sum())


def test_fanout_totals_equal_the_literal_joins(spark):
    base = spark.createDataFrame([(i, i % 3) for i in range(20)], "k INT, g INT")
    a = spark.createDataFrame([(RNG.randrange(25), RNG.randrange(100)) for _ in range(120)] + [(3, 1)] * 60, "k INT, x INT")
    b = spark.createDataFrame([(RNG.randrange(25), RNG.randrange(100)) for _ in range(90)] + [(3, 2)] * 40, "k INT, y INT")
    got = aggs.fanout_join_agg(base, ["g"], {"a": (a, "k", "x"), "b": (b, "k", "y")})
    literal = base.join(a, "k", "left").join(b, "k", "left").groupBy("g").agg(
        F.count("x").alias("a_rows"), F.sum("x").alias("a_total"), F.count("y").alias("b_rows"), F.sum("y").alias("b_total"))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, literal.collect()))


def test_filtered_left_join_equals_the_on_clause(spark):
    left = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c"), (3, "d"), (None, "e")], "k INT, l STRING")
    right = spark.createDataFrame([(1, 5), (1, 50), (3, 60), (9, 70)], "k INT, v INT")
    got = joins.left_join_on_filter(left, right, "k", F.col("v") > 10)
    want = left.join(right, (left.k == right.k) & (right.v > 10), "left").select(left.k, "l", "v")
    key = lambda rows: sorted(map(str, map(tuple, rows)))
    assert key(got.select("k", "l", "v").collect()) == key(want.collect())


def test_ledger(spark):
    accounts = spark.createDataFrame(
        [(1, "SAVINGS", dt.date(2024, 1, 1), 100), (2, "CREDIT", dt.date(2024, 1, 1), 100), (3, "LOAN", dt.date(2024, 1, 1), 5)],
        "account_id BIGINT, account_type STRING, open_date DATE, opening_balance INT",
    )
    tx = spark.createDataFrame(
        [(1, 2, 500, "COMPLETED"), (2, 1, 50, "COMPLETED"), (2, 2, 10, "COMPLETED"), (1, 2, 999, "FAILED"), (None, 1, 1, "COMPLETED")],
        "from_account_id BIGINT, to_account_id BIGINT, amount INT, status STRING",
    ).withColumn("transaction_date", F.lit(dt.datetime(2024, 2, 1)).cast("timestamp_ntz"))
    out = {r.account_id: r.current_balance for r in ledger.ledger_balance(accounts, tx).collect()}
    assert out == {1: 349, 2: 540, 3: 5}  # savings: |100 - 500 + 50 + 1|; a self transfer only debits


def test_balance_change_looks_back_over_missing_days(spark):
    rows = [(1, dt.date(2024, 1, 1), 10), (1, dt.date(2024, 1, 5), 30), (1, dt.date(2024, 1, 6), 35), (1, dt.date(2024, 3, 1), 100)]
    df = spark.createDataFrame(rows, "k INT, day DATE, v INT")
    out = {r.day: r for r in ledger.balance_change(df, "k", "day", "v", {"d1": 1, "d7": 7, "d30": 30}).collect()}
    assert out[dt.date(2024, 1, 1)].d1 is None
    assert out[dt.date(2024, 1, 6)].d1 == 5 and out[dt.date(2024, 1, 6)].d7 is None
    last = out[dt.date(2024, 3, 1)]
    assert (last.d1, last.d7, last.d30) == (65, 65, 65)


def test_scd2(spark):
    ddl = "k INT, city STRING, effective_date DATE, end_date DATE, is_current BOOLEAN"
    old, day = dt.date(2020, 1, 1), AS_OF
    current = spark.createDataFrame(
        [(1, "A", old, None, True), (2, "B", old, None, True), (3, None, old, None, True), (4, "D", old, None, True),
         (1, "Z", dt.date(2019, 1, 1), old, False)], ddl)
    incoming = spark.createDataFrame([(1, "A"), (2, "X"), (3, None), (5, "E")], "k INT, city STRING")
    out = sorted((r.k, str(r.city), r.effective_date, str(r.end_date), r.is_current)
                 for r in history.scd2_merge(current, incoming, "k", ["city"], day).collect())
    assert out == sorted([
        (1, "Z", dt.date(2019, 1, 1), str(old), False), (1, "A", old, "None", True), (2, "B", old, str(day), False),
        (2, "X", day, "None", True), (3, "None", old, "None", True), (4, "D", old, "None", True), (5, "E", day, "None", True)])
    again = history.scd2_merge(history.scd2_merge(current, incoming, "k", ["city"], day), incoming, "k", ["city"], day)
    assert again.count() == len(out)


def test_cdc(spark):
    base = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "k INT, v STRING")
    changes = spark.createDataFrame([(1, "x", "U", 1), (1, "y", "U", 2), (2, None, "D", 1), (4, "n", "U", 1), (5, "q", "U", 1), (5, None, "D", 2)],
                                    "k INT, v STRING, op STRING, seq INT")
    out = history.cdc_apply(base, changes, "k", ["seq"])
    assert sorted(map(tuple, out.collect())) == [(1, "y"), (3, "c"), (4, "n")]


def test_partition_overwrite_is_idempotent_and_local(spark):
    path = work_folder(spark, "t")
    df = spark.range(100).select("id", (F.col("id") % 5).alias("p"), F.lit(1).alias("v"))
    tables.write_full_refresh(df, path, ["p"])
    for _ in range(2):
        tables.write_partition_overwrite(df.where("p = 3").withColumn("v", F.lit(2)), path, ["p"])
    out = spark.read.parquet(path)
    assert out.count() == 100 and out.where("v = 2").count() == 20 and out.where("v = 2 AND p <> 3").count() == 0


def test_pruned_read(spark):
    path = work_folder(spark, "t")
    tables.write_full_refresh(spark.range(100).select("id", (F.col("id") % 5).alias("p")), path, ["p"])
    spark.conf.set("spark.sql.maxPlanStringLength", "100000")
    plan = readers.partitioned_read(spark.read.parquet(path), {"p": 3})._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(p" in plan


def test_retention_keeps_and_drops_everything_once(spark):
    df = spark.createDataFrame([(y, m) for y in range(2020, 2026) for m in range(1, 13)], "transaction_year INT, transaction_month INT")
    kept, gone = tables.purge_partitions(df, AS_OF).count(), tables.archive_partitions(df, AS_OF).count()
    assert kept + gone == df.count() and gone == 36
    plan = tables.retention_plan(df, AS_OF).collect()
    assert max((r.transaction_year, r.transaction_month) for r in plan) == (2023, 2)


def test_empty_csv_fields_are_null_and_bad_rows_are_kept_apart(spark, tmp_path):
    file = tmp_path / "products.csv"
    file.write_text('product_id,product_name,product_type,currency,active\n1,"A, B",CARD,USD,True\n2,,LOAN,,False\nx,C,LOAN,USD,True\n')
    from coinloft.schemas import DDL

    good, bad = readers.validate_records(spark, str(file), DDL["products"])
    assert sorted((r.product_id, r.product_name, r.currency) for r in good.collect()) == [(1, "A, B", "USD"), (2, None, None)]
    assert bad.count() == 1 and bad.first()["_corrupt_record"].startswith("x,C")


def test_avro_without_its_package_is_a_clear_error(spark, tmp_path):
    with pytest.raises(RuntimeError, match="spark-avro"):
        readers.read_any_format(spark, str(tmp_path), "avro")


def test_calendar(spark):
    bounds = spark.sql("SELECT DATE '2020-01-01' AS first_day, DATE '2027-12-31' AS last_day")
    out = gold.dim_date(gold.calendar_days(bounds))
    assert out.count() == 2922
    row = out.where("date_key = 20250704").first()
    assert (row.quarter_name, row.month_short, row.day_name, row.is_holiday, row.is_business_day) == ("Q3 2025", "Jul", "Friday", True, False)
    assert out.where("is_holiday").count() == 24


def test_work_folder_uses_the_named_shared_folder(spark):
    assert work_folder(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))


def test_a_hot_key_on_the_right_of_a_filtered_left_join_is_split(spark):
    """With thresholds scaled down to the fixture, AQE splits the hot key and the rows stay whole."""
    low = {
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB",
        "spark.sql.shuffle.partitions": "16", "spark.sql.maxPlanStringLength": "1000000",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    before = {k: spark.conf.get(k, None) for k in low}
    try:
        for k, v in low.items():
            spark.conf.set(k, v)
        left = spark.range(0, 2000).select(F.col("id").alias("k"))
        key = F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 1500)
        right = spark.range(0, 60000, 1, 8).select(key.alias("k"), F.col("id").alias("v"), F.sha2(F.col("id").cast("string"), 256).alias("pad"))
        out = joins.left_join_on_filter(left, right, "k", F.col("v") >= 0)
        rows = out.collect()
        plan = out._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)
    assert "skew=true" in plan
    assert sum(r.v is not None for r in rows) == 60000
    assert {r.k for r in rows} == set(range(2000))


def test_reduce_tasks_are_small_and_files_are_not(spark, tmp_path):
    from coinloft import session

    key, rows = tables.ADVISORY, spark.range(100).withColumn("p", F.col("id") % 2)
    assert session.SETTINGS[key] == "16MB"
    seen, before = [], spark.conf.get(key)
    for value in ("16MB", "5MB"):
        spark.conf.set(key, value)
        try:
            for target in (None, 256):
                with tables._file_size(spark, target):
                    seen.append(spark.conf.get(key))
                assert spark.conf.get(key) == value
            tables.write_full_refresh(rows, str(tmp_path / "t"), ["p"])
            tables.compact_partitions(rows, str(tmp_path / "c"), ["p"])
            assert spark.conf.get(key) == value
        finally:
            spark.conf.set(key, before)
    assert seen == ["64MB", "256MB", "5MB", "256MB"]
    assert spark.read.parquet(str(tmp_path / "t")).count() == spark.read.parquet(str(tmp_path / "c")).count() == 100


def test_scan_tasks_are_small_unless_the_owner_has_set_them(spark):
    from coinloft import session

    key, before = "spark.sql.files.maxPartitionBytes", spark.conf.get("spark.sql.files.maxPartitionBytes")
    assert before == session.SETTINGS[key] == "16MB"
    spark.conf.set(key, "128MB")
    try:  # the suite's session was built with the setting, so it counts as the owner's
        assert session.tune(spark).conf.get(key) == "128MB"
    finally:
        spark.conf.set(key, before)


def test_a_stored_table_is_compacted_without_a_shuffle(spark, tmp_path, monkeypatch):
    rows = spark.range(0, 900, numPartitions=6).select(
        "id", (F.col("id") % 3).cast("int").alias("n"), F.element_at(F.array(F.lit("a b/c%"), F.lit("x=y"), F.lit(None)), (F.col("id") % 3 + 1).cast("int")).alias("p"))
    rows = rows.withColumn("day", F.expr("date'2020-01-01' + n"))
    stored, packed = str(tmp_path / "stored"), str(tmp_path / "packed")
    rows.write.partitionBy("p", "day").parquet(stored)
    table = spark.read.parquet(stored)
    spark.range(5).write.parquet(f"{packed}/left=1")  # of an earlier run, replaced
    with monkeypatch.context() as patched:
        patched.setattr(tables, "_write", None)  # the form that shuffles
        tables.compact_partitions(table.where("id >= 0"), packed, ["p", "day"])
    got = spark.read.parquet(packed)
    assert got.columns == table.columns and got.exceptAll(table).count() == table.exceptAll(got).count() == 0
    assert len(table.inputFiles()) == 18 and len(got.inputFiles()) == 3
    moved = table.withColumn("day", F.date_add("day", 40))  # the values are not those of the folders
    for i, (df, cols) in enumerate([(moved, ["p", "day"]), (table, ["n"]), (rows, ["p"]), (table.limit(0), ["p", "day"])]):
        tables.compact_partitions(df, str(tmp_path / f"other{i}"), cols)
        if i < 3:
            other = spark.read.parquet(str(tmp_path / f"other{i}")).select(*df.columns)
            assert other.exceptAll(df).count() == df.exceptAll(other).count() == 0
    tables.compact_partitions(table, stored, ["p", "day"])  # onto itself: as before
    assert spark.read.parquet(stored).count() == 900


def test_tables_are_written_with_zstd_unless_the_owner_has_set_a_codec(spark):
    from coinloft import session

    key = "spark.sql.parquet.compression.codec"
    assert spark.conf.get(key) == session.SETTINGS[key] == "zstd"
