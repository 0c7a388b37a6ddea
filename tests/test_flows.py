import datetime as dt
from pathlib import Path

import duckdb
import pytest
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Observation
from pyspark.sql import functions as F

import checks
from checks.compare import TABLES, _rows
from checks.core import SPARK, SQL, Lake, runner, typed
from coinloft.functions import clean
from coinloft.learning import features, models
from coinloft.operators import history, profile, tables
from coinloft.plans import gold
from coinloft.plans.gates import LIMITS, GateFailed
from coinloft.plans.pipeline import Pipeline
from coinloft.schemas import DDL
from coinloft.session import work_folder
from coinloft.sources.files import FileStage
from coinloft.streaming import jobs
from coinloft.streaming.partials import Partials

FOLDER = "/root/testdata/sf0.001"
checks.all_checks()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{FOLDER}/{t}.parquet'")
    return c


HEAD = [
    "silver_clients", "silver_transactions", "fact_transactions_daily", "client_360_view", "product_performance_summary",
    "branch_performance_dashboard", "aq_branch_comparison", "aq_segmentation", "aq_cards", "data_quality_dashboard",
    "incremental_load", "stream_clean_dedup", "stream_daily_fact", "stream_upsert_gold", "churn_features",
]


@pytest.mark.parametrize("name", HEAD)
def test_against_sql(spark, con, name):
    df = runner(name)(spark, FOLDER)
    cur = con.execute(typed(name))
    cols = [d[0] for d in cur.description]
    assert _rows(df.columns, [tuple(r) for r in df.collect()]) == _rows(cols, cur.fetchall())


def test_every_twin_has_its_query():
    assert set(SQL) <= set(SPARK)


def test_pipeline_stores_all_layers(spark):
    lake = Lake(spark, FOLDER)
    pipeline = Pipeline(spark, work_folder(spark, "lake"), lake.as_of, lake.run_ts)
    counts = {r.table_name: r.record_count for r in pipeline.run(lake.source.table).collect()}
    assert counts["bronze.transactions"] == lake.stage["transactions"].count()
    silver = counts["silver.transactions"]
    assert silver <= counts["bronze.transactions"]
    fact = pipeline.read("gold", "fact_transactions_daily")
    assert fact.agg({"transaction_count": "sum"}).first()[0] == silver
    assert counts["gold.dim_client"] == counts["silver.clients"]
    assert counts["gold.dim_date"] == 2922 and counts["gold.data_quality_dashboard"] == 12


def _gate_rows(spark, root):
    return {(r.gate, r.table_name): r.status for r in spark.read.parquet(f"{root}/gates").collect()}


def test_compaction_rewrites_only_partitions_with_small_files(spark):
    """One file per partition after packing, bins by size, and the files of other partitions keep their names."""
    path = work_folder(spark, "small")
    rows = spark.range(4000).selectExpr("id", "sha2(cast(id as string), 256) AS t", "cast(id % 4 AS int) AS m", "if(id % 4 = 3, null, 'a b') AS k")
    for n in range(6):  # six files in m = 0 and m = 3 (whose k is null), one each in the others
        rows.where(f"m IN (0, 3) AND pmod(id, 24) DIV 4 = {n}").coalesce(1).write.mode("append").partitionBy("m", "k").parquet(path)
    rows.where("m IN (1, 2)").coalesce(1).write.mode("append").partitionBy("m", "k").parquet(path)

    def files():
        found = spark.read.parquet(path).groupBy("m").agg(F.collect_set("_metadata.file_path").alias("f"))
        return {r.m: set(r.f) for r in found.collect()}

    before, size = files(), spark.read.parquet(path).where("m = 0").agg(F.max("_metadata.file_size")).first()[0]
    assert [len(before[m]) for m in range(4)] == [6, 1, 1, 6]
    assert tables.compact_in_place(spark, path, ["m", "k"], size / (1 << 20) / 2) == 0  # each file fills a bin
    assert files() == before
    assert tables.compact_in_place(spark, path, ["m", "k"], size * 2.5 / (1 << 20)) == 2
    after = files()
    assert after[1] == before[1] and after[2] == before[2] and len(after[0]) <= 3 and not after[0] & before[0]
    assert tables.compact_in_place(spark, path, ["m", "k"]) in (0, 1, 2) and tables.compact_in_place(spark, path, ["m", "k"]) == 0
    assert [len(files()[m]) for m in range(4)] == [1, 1, 1, 1]
    assert sorted(map(tuple, spark.read.parquet(path).select("id", "t", "m", "k").collect())) == sorted(map(tuple, rows.collect()))


def test_a_failed_gate_stops_before_gold(spark):
    """Poor clients, an empty source and rows lost on the way to bronze each end the run; the outcome is stored."""
    lake = Lake(spark, FOLDER)
    swap = lambda **other: lambda name: other.get(name, lake.stage[name])
    blank = lake.stage["clients"]
    for c in ("email", "phone", "birth_date", "credit_score", "annual_income"):
        blank = blank.withColumn(c, F.lit(None).cast(blank.schema[c].dataType))
    small = ["clients", "products", "accounts"]
    run = lambda root, stage, **kw: Pipeline(spark, root, lake.as_of, lake.run_ts, **kw)._through_silver(stage, small)
    root = work_folder(spark, "poor")
    with pytest.raises(GateFailed, match="quality: clients"):
        run(root, swap(clients=blank))
    assert _gate_rows(spark, root)["quality", "clients"] == "FAIL" and _gate_rows(spark, root)["silver", "clients"] == "PASS"
    root = work_folder(spark, "empty")
    with pytest.raises(GateFailed, match="preflight: products"):
        run(root, swap(products=lake.stage["products"].limit(0)))
    assert not tables.exists(spark, f"{root}/bronze") and _gate_rows(spark, root)["preflight", "clients"] == "PASS"
    root = work_folder(spark, "rows")
    with pytest.raises(GateFailed, match="rows"):
        run(root, swap(), limits={**LIMITS, "min_rows": {"clients": 10**9}})
    run(work_folder(spark, "good"), swap())
    gates = Pipeline(spark, work_folder(spark, "direct"), lake.as_of, lake.run_ts).gates
    clients = lake.stage["clients"]
    n = clients.count()
    gates.bronze({"clients": 2 * n}, {"clients": clients}, swap())  # counted twice by a pass that ran again: the source decides
    with pytest.raises(GateFailed, match=f"{n} delivered, {n - 1} stored"):
        gates.bronze({"clients": n}, {"clients": clients.limit(n - 1)}, swap())
    with pytest.raises(GateFailed, match="silver"):
        gates.silver({"clients": clients}, {"clients": clients.union(clients)})
    fact = spark.createDataFrame([(3,), (4,)], "transaction_count long")
    gates.gold(fact, spark.range(7))
    with pytest.raises(GateFailed, match="gold"):
        gates.gold(fact, spark.range(8))


def _fact_rows(fact):
    kept = sorted(c for c in fact.columns if not c.endswith("_timestamp"))
    return sorted(map(str, (tuple(r) for r in fact.select(*kept).collect())))


def test_incremental_runs_equal_a_full_run(spark):
    """Late rows carry old dates; a repeated load adds nothing."""
    lake = Lake(spark, FOLDER)
    rows, late = lake.stage["transactions"], F.col("transaction_id") % 70 < 10
    part = lambda rows: lambda name: rows if name == "transactions" else lake.stage[name]
    root = work_folder(spark, "grown")
    first = Pipeline(spark, root, lake.as_of, lake.run_ts - dt.timedelta(days=1))
    first.bronze(part(rows.where(~late)))
    first.silver()
    first.gold(["fact_transactions_daily"])
    grown = Pipeline(spark, root, lake.as_of, lake.run_ts)
    counts = {r.table_name: r.record_count for r in grown.run(part(rows.where(late)), mode="incremental").collect()}
    whole = _fact_rows(lake.gold["fact_transactions_daily"])
    assert counts["bronze.transactions"] == rows.count()
    assert _fact_rows(grown.read("gold", "fact_transactions_daily")) == whole
    grown._add_transactions(rows.where(late))
    assert grown.read("bronze", "transactions").count() == rows.count()
    assert _fact_rows(grown.read("gold", "fact_transactions_daily")) == whole
    with pytest.raises(ValueError):
        grown.run(part(rows), dedup=True, mode="incremental")


def test_incremental_load_reads_touched_partitions_only(spark):
    path = work_folder(spark, "months")
    spark.sql("SELECT id, id % 4 AS m, timestamp'2025-01-01' + make_interval(0, 0, 0, id % 4) AS load_timestamp FROM range(40)").write.partitionBy("m").parquet(path)
    stored, out, seen = spark.read.parquet(path), work_folder(spark, "out"), []
    build = lambda rows: seen.append(rows) or rows
    assert history.incremental_load(stored, out, build, dt.datetime(2025, 1, 3), ["m"], ["m"])
    assert {r.m for r in spark.read.parquet(out).collect()} == {3}
    scan = next(line for line in seen[0]._jdf.queryExecution().explainString(spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")).splitlines() if "PartitionFilters" in line)
    assert "= 3" in scan
    assert not history.incremental_load(stored, out, build, dt.datetime(2025, 2, 1), ["m"], ["m"])


@pytest.mark.parametrize("fmt", ["csv", "parquet"])
def test_a_folder_of_declared_tables_is_a_stage(spark, fmt):
    lake, folder = Lake(spark, FOLDER), work_folder(spark, "declared")
    options = {"header": "true", "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false", "escape": "\\"} if fmt == "csv" else {}
    for name in DDL:
        lake.stage[name].write.options(**options).format(fmt).save(f"{folder}/{name}")
    from_files = Lake(spark, as_of=lake.as_of, run_ts=lake.run_ts, source=FileStage(spark, folder, fmt))
    for name in ("clients", "account_balances", "loans"):
        assert from_files.silver[name].count() == lake.silver[name].count()
    figures = lambda one: [str(r) for r in one.gold["fact_transactions_daily"].groupBy("year").agg(F.sum("total_amount"), F.count("*")).orderBy("year").collect()]
    assert figures(from_files) == figures(lake)


def test_models_score_every_held_out_row(spark):
    lake = Lake(spark, FOLDER)
    table = features.fraud_features(lake.silver)
    scored, metrics = models.fraud_model(table, trees=5, depth=4)
    figures = {r.metric: r.value for r in metrics.collect()}
    _, test = models.split(table, ["transaction_uuid"])
    assert scored.count() == test.count() == sum(v for k, v in figures.items() if k.startswith("label_"))
    assert 0.5 < figures["areaUnderROC"] <= 1.0 and 0 < figures["accuracy"] <= 1


def test_models_score_in_a_session_that_observed(spark):
    """A training summary holds the session, which cannot be sent to tasks after the first observed DataFrame."""
    spark.range(3).observe(Observation("seen"), F.count("*").alias("n")).collect()
    test_models_score_every_held_out_row(spark)
    texts = spark.createDataFrame([(i, "good words" if i % 2 else "bad lines") for i in range(60)], "doc_id long, text string")
    marks = texts.select("doc_id", (F.col("doc_id") % 2).alias("quality"))
    scored, _ = models.doc_classify(texts, marks)
    assert {(r.doc_id % 2, r.prediction) for r in scored.collect()} == {(0, 0.0), (1, 1.0)}


def test_training_rows_are_dealt_over_the_cores(spark):
    one_file = spark.range(40000, numPartitions=1).select("id", F.lit(1.5).alias("x"), F.lit("a").alias("code"), (F.col("id") % 2).alias("y"))
    table = models.training_table(one_file, ["id"], ["x"], ["code"], "y")
    sizes = [r["count"] for r in table.groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) == 4 and max(sizes) < 11000 and sum(sizes) == table.distinct().count() == 40000
    assert models.training_table(one_file.where("id < 0"), ["id"], ["x"], ["code"], "y").count() == 0


def test_forests_keep_the_node_of_each_row(spark):
    """Beside the rows, not found anew from the root in every pass; the trees are those of a plain forest."""
    grown = models._fraud_pipeline(4, 6, 42).getStages()[-1]
    assert grown.getCacheNodeIds()
    rows = spark.range(2000, numPartitions=3).select(
        (F.pmod(F.xxhash64("id"), F.lit(7)) % 2).cast("double").alias("label"),
        F.pmod(F.xxhash64("id"), F.lit(91)).cast("double").alias("x"), (F.col("id") % 13).cast("double").alias("y"))
    rows = VectorAssembler(inputCols=["x", "y"], outputCol="features").transform(rows)
    plain = RandomForestClassifier(numTrees=4, maxDepth=6, seed=42).fit(rows)
    trees = lambda model: [t.toDebugString.split("\n", 1)[1] for t in model.trees]
    assert trees(grown.fit(rows)) == trees(plain) and plain.totalNumNodes > 8
    large = models._fraud_pipeline(100, 6, 42, models.NODE_IDS // 100 + 1).getStages()[-1]
    assert not large.getCacheNodeIds()  # they would go to disk on every level


def test_grid_search_returns_every_point(spark):
    lake = Lake(spark, FOLDER)
    out = models.tune_grid_cv(features.fraud_features(lake.silver), trees=(2, 3), depths=(2,), min_rows=(1, 5), folds=2).collect()
    assert len(out) == 4 and sum(r.test_auc is not None for r in out) == 1


def test_the_registered_grid_search_has_every_point(spark, monkeypatch):
    given = {}
    monkeypatch.setattr(models, "tune_grid_cv", lambda table, **changed: given.update(changed))
    SPARK["tune_grid_cv"](Lake(spark, FOLDER))
    assert given == {}


WIDE = ["dim_client", "dim_account", "fact_transactions_daily", "client_360_view", "aq_branch_comparison", "aq_segmentation",
        "aq_cards", "aq_product_effectiveness", "churn_features", "left_join_on_filter", "agg_percentile"]


def _plan(spark, name):
    lake = Lake(spark, FOLDER)
    spark.conf.set("spark.sql.maxPlanStringLength", "10000000")
    return SPARK[name](lake)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", WIDE)
def test_plans_scale(spark, name):
    """No row pairs, no Python, and no broadcast beyond the measured size."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = _plan(spark, name)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    for node in ("CartesianProduct", "BroadcastNestedLoopJoin", "BroadcastExchange", "Python"):
        assert node not in plan


def test_scans_read_only_what_the_fact_needs(spark):
    plan = _plan(spark, "fact_transactions_daily")
    orders = [line for line in plan.splitlines() if "FileScan" in line and "o_orderkey" in line]
    assert orders and all("o_totalprice" not in line.split("ReadSchema")[1] for line in orders)


def test_hot_account_gives_whole_totals(spark):
    """One account holds a third of the rows; totals match the plain query over the same rows."""
    from pyspark.sql import functions as F

    lake = Lake(spark, FOLDER)
    hot = F.when(F.crc32("transaction_uuid") % 3 == 0, 7).otherwise(F.col("from_account_id")).cast("bigint")
    moved = lake.silver["transactions"].withColumn("from_account_id", hot)
    frames = {"transactions": moved, "accounts": lake.silver["accounts"]}
    from coinloft.plans import gold

    fact = gold.fact_transactions_daily(frames, lake.as_of, lake.run_ts)
    keys = ["transaction_date", "account_id", "client_id", "branch_code", "transaction_type", "category", "currency"]
    got = fact.select(*keys, "transaction_count", "total_amount", "suspicious_transaction_count")
    moved.createOrReplaceTempView("hot_tx")
    lake.silver["accounts"].createOrReplaceTempView("hot_acc")
    want = spark.sql("""
        SELECT t.transaction_date_only, t.from_account_id, coalesce(a.client_id, -1), coalesce(a.branch_code, 'UNKNOWN'),
               t.transaction_type_normalized, t.category_normalized, t.currency, count(*), sum(t.amount), count_if(t.is_suspicious)
        FROM hot_tx t LEFT JOIN hot_acc a ON t.from_account_id = a.account_id GROUP BY ALL""")
    rows = lambda df: sorted(map(str, (tuple(r) for r in df.collect())))
    assert rows(got) == rows(want)


def test_clients_keep_their_history(spark):
    """Four runs: as delivered, some moved and one new, the same again, moved back; versions follow on each other without gaps."""
    lake = Lake(spark, FOLDER)
    root, day = work_folder(spark, "versions"), lake.as_of
    base = lake.silver["clients"].where("client_id <= 40")
    moved = base.withColumn("city", F.when(F.col("client_id") % 4 == 0, "MOVED").otherwise(F.col("city")))
    moved = moved.withColumn("address", F.when(F.col("client_id") == 5, None).otherwise(F.col("address")))
    back = moved.withColumn("city", F.when(F.col("client_id") == 8, "HOME").otherwise(F.col("city"))).where("client_id <> 3")

    def run(n, clients):
        pipeline = Pipeline(spark, root, day + dt.timedelta(days=n), lake.run_ts + dt.timedelta(days=n))
        return [r.asDict() for r in pipeline.client_versions(clients).collect()]

    n = base.count()
    first = run(0, base.where("client_id <> 2"))
    assert len(first) == n - 1 and all(r["is_current"] and r["effective_date"] == min(r["registration_date"] or day, day) for r in first)
    second = run(1, moved.union(moved.where("client_id = 1")))  # a repeated row makes no version
    changed = base.where("client_id % 4 = 0").count() + base.where("client_id = 5 and address is not null").count()
    assert sum(r["is_current"] for r in second) == n and sum(not r["is_current"] for r in second) == changed
    assert {r["effective_date"] for r in second if r["client_id"] == 2} == {day + dt.timedelta(days=1)}
    key = lambda rows: sorted(map(str, (sorted(r.items()) for r in rows)))
    assert key(run(1, base)) == key(second)  # a repeated run changes nothing
    assert key(run(2, moved)) == key(second)
    last = run(3, back)
    by_client = {}
    for r in sorted(last, key=lambda r: (r["client_id"], r["effective_date"])):
        by_client.setdefault(r["client_id"], []).append(r)
    assert [r["city"] for r in by_client[8]][1:] == ["MOVED", "HOME"] and len(by_client[8]) == 3 and len(by_client[3]) == 1
    for rows in by_client.values():
        assert [r["end_date"] for r in rows] == [r["effective_date"] for r in rows[1:]] + [None]
        assert [r["is_current"] for r in rows] == [False] * (len(rows) - 1) + [True]
    stored = spark.read.parquet(f"{root}/history/clients/versions").select("run", "is_current").distinct().collect()
    assert len({r.run for r in stored if str(r.is_current) == "true"}) == 2
    with pytest.raises(ValueError):
        run(2, back)
    versions = Pipeline(spark, root, day + dt.timedelta(days=3), lake.run_ts + dt.timedelta(days=3)).client_versions(back)
    frames = {name: lake.silver[name] for name in DDL}
    dim = gold.dim_client({**frames, "clients": back}, day, lake.run_ts, versions)
    plain = gold.dim_client({**frames, "clients": moved.where("client_id = 3").union(back)}, day, lake.run_ts)
    assert dim.count() == dim.select("client_key").distinct().count() == len(last)
    days = ["effective_date"]
    assert _fact_rows(dim.where("is_current").drop(*days)) == _fact_rows(plain.drop(*days))


def _few_months(spark, files):
    """The newest transactions, in ``files`` files."""
    lake = Lake(spark, FOLDER)
    rows = lake.stage["transactions"].where("transaction_date is not null")
    newest = rows.agg(F.max("transaction_date")).first()[0].replace(day=1) - dt.timedelta(days=40)
    rows = rows.where(F.col("transaction_date") >= F.lit(newest))
    path = work_folder(spark, "landing")
    rows.repartition(files).write.parquet(path)
    return lake, path, rows.schema, spark.read.schema(rows.schema).parquet(path)


def _dealt(spark, files):
    """Transactions of the stage in ``files`` files whose dates overlap, and their silver rows."""
    lake = Lake(spark, FOLDER)
    path = work_folder(spark, "landing")
    rows = lake.stage["transactions"]
    rows.repartition(files).write.parquet(path)
    return lake, path, rows.schema, lake.silver["transactions"]


def test_streams_lose_no_row_in_several_batches(spark):
    lake, path, schema, silver = _dealt(spark, 4)
    stream = lambda: jobs.file_stream(spark, path, schema, max_files=1)
    folder = lambda n: work_folder(spark, n)
    out = folder("clean")
    jobs.stream_clean_dedup(stream(), lake.as_of, lake.run_ts, out, folder("checkpoint"))
    expected = silver.where("transaction_uuid is not null").select("transaction_uuid").distinct().count()
    assert jobs.landed(spark, out).count() == expected + silver.where("transaction_uuid is null").count()
    days = folder("days")
    jobs.stream_daily_fact(stream(), lake.as_of, lake.run_ts, folder("silver"), days, folder("checkpoint"))
    assert spark.read.parquet(days).agg({"transaction_count": "sum"}).first()[0] == silver.count()


def test_daily_totals_come_from_state_and_late_days_are_rebuilt(spark):
    """Three runs over months in order, then a file of old days: only those are rebuilt, and totals stay those of all rows."""
    lake, path, schema, silver = _dealt(spark, 1)
    rows = spark.read.schema(schema).parquet(path).withColumn("h", F.pmod(F.xxhash64("transaction_id"), F.lit(20)))
    cuts = [r[0] for r in rows.selectExpr("explode(percentile_approx(transaction_date, array(0.3, 0.6, 1.0)))").collect()]
    source, silver_at, days, checkpoint = (work_folder(spark, n) for n in ("arriving", "silver", "days", "checkpoint"))
    held = rows.where((F.col("transaction_date") <= cuts[0]) & (F.col("h") == 0))
    early = [rows.where((F.col("h") > 0) | (F.col("transaction_date") > cuts[0])).where(F.col("transaction_date") <= cuts[0])]
    early += [rows.where((F.col("transaction_date") > lo) & (F.col("transaction_date") <= hi)) for lo, hi in zip(cuts, cuts[1:])]
    rebuilt = []
    for part in [*early, held, held.limit(0)]:
        part.drop("h").coalesce(1).write.mode("append").parquet(source)
        stream = jobs.file_stream(spark, source, schema)
        rebuilt.append(jobs.stream_daily_fact(stream, lake.as_of, lake.run_ts, silver_at, days, checkpoint))
    assert rebuilt[:3] == [0, 0, 0] and rebuilt[4] == 0
    assert rebuilt[3] == held.select(F.to_date("transaction_date")).distinct().count() > 0
    key = lambda df: sorted(map(tuple, df.select("transaction_date", "transaction_type", "status", "transaction_count", "total_amount").collect()), key=repr)
    assert key(spark.read.parquet(days)) == key(jobs.daily_totals(jobs.landed(spark, silver_at)))
    assert jobs.landed(spark, silver_at).count() == silver.count()


def test_a_new_checkpoint_keeps_stored_rows(spark):
    lake, path, schema, silver = _dealt(spark, 2)
    files = sorted(r[0] for r in spark.read.parquet(path).selectExpr("_metadata.file_path").distinct().collect())
    stored, fact = work_folder(spark, "silver"), work_folder(spark, "fact")
    for one in files:
        single = work_folder(spark, "part")
        spark.read.parquet(one).write.parquet(single)
        jobs.stream_upsert_gold(jobs.file_stream(spark, single, schema), lake.silver["accounts"], lake.as_of, lake.run_ts, stored, fact, work_folder(spark, "checkpoint"))
    assert jobs.landed(spark, stored).count() == silver.count()
    assert spark.read.parquet(fact).agg({"transaction_count": "sum"}).first()[0] == silver.count()


def test_a_uuid_is_stored_once_whatever_date_it_comes_again_with(spark):
    """Redelivered in the same batch, a later run and another stream, with dates moved back and forth over months."""
    lake, path, schema, rows = _few_months(spark, 1)
    source, out, checkpoint = (work_folder(spark, n) for n in ("arriving", "silver", "checkpoint"))
    moved = lambda months: rows.withColumn("transaction_date", F.col("transaction_date") + F.expr(f"INTERVAL {months} MONTH"))
    nameless = rows.limit(5).withColumn("transaction_uuid", F.lit(None).cast("string"))
    run = lambda folder, at: jobs.stream_clean_dedup(jobs.file_stream(spark, folder, schema, max_files=2), lake.as_of, lake.run_ts, out, at)
    for part in (rows.union(rows), moved(-14), moved(9).union(nameless), nameless):
        part.coalesce(1).write.mode("append").parquet(source)
        run(source, checkpoint)
    other = work_folder(spark, "other")
    fresh = rows.limit(3).withColumn("transaction_uuid", F.concat(F.lit("new-"), "transaction_uuid"))
    moved(-30).union(fresh).coalesce(1).write.parquet(other)
    run(other, work_folder(spark, "checkpoint"))
    stored = jobs.landed(spark, out)
    named = stored.where("transaction_uuid is not null")
    uuids = rows.where("transaction_uuid is not null").select("transaction_uuid").distinct().count()
    assert named.count() == named.select("transaction_uuid").distinct().count() == uuids + 3
    assert stored.count() - named.count() == 10 + 2 * rows.where("transaction_uuid is null").count()
    first = rows.withColumn("transaction_uuid", F.trim("transaction_uuid")).join(named.select("transaction_uuid", "transaction_date"), ["transaction_uuid", "transaction_date"], "left_semi")
    assert first.select("transaction_uuid").distinct().count() == uuids  # the first that came stays


def test_partial_totals_are_folded_and_a_repeated_batch_changes_nothing(spark):
    """Five batches folded by twos, the last one run again, then another stream: always the fact of all rows, few folders."""
    lake, path, schema, rows = _few_months(spark, 6)
    files = sorted(r[0] for r in spark.read.parquet(path).selectExpr("_metadata.file_path").distinct().collect())
    source, last, stored, fact, checkpoint = (work_folder(spark, n) for n in ("arriving", "last", "silver", "fact", "checkpoint"))
    spark.read.schema(schema).parquet(*files[:5]).repartition(5).write.parquet(source)
    spark.read.schema(schema).parquet(files[5]).write.parquet(last)
    accounts = lake.silver["accounts"]

    def run(folder, at):
        stream = jobs.file_stream(spark, folder, schema, max_files=1)
        jobs.stream_upsert_gold(stream, accounts, lake.as_of, lake.run_ts, stored, fact, at, fold_every=2)

    def whole():
        rows = jobs.landed(spark, stored)
        return gold.fact_transactions_daily({"transactions": rows, "accounts": accounts}, lake.as_of, lake.run_ts)

    def months(where, *names):
        return spark.read.parquet(f"{fact}_partials/{where}").select(*names).distinct()

    run(source, checkpoint)
    assert _fact_rows(spark.read.schema(whole().schema).parquet(fact)) == _fact_rows(whole())
    assert months("deltas", "batch_id").count() == 1  # batches 0, 1 and 2, 3 are folded and their folders gone
    base = months("base", "fold", "year", "month")
    assert base.count() == base.select("year", "month").distinct().count() > 0
    for name in ("4", ".4.crc"):  # the last batch did not commit
        Path(f"{checkpoint}/commits/{name}").unlink(missing_ok=True)
    run(source, checkpoint)
    assert _fact_rows(spark.read.schema(whole().schema).parquet(fact)) == _fact_rows(whole())
    run(last, work_folder(spark, "checkpoint"))
    assert jobs.landed(spark, stored).count() == rows.count()
    assert _fact_rows(spark.read.schema(whole().schema).parquet(fact)) == _fact_rows(whole())
    totals = gold.daily_partials(jobs.landed(spark, stored))
    upgraded = work_folder(spark, "fact")  # partials that begin with rows stored before
    store = Partials(spark, f"{upgraded}_partials", totals.schema, gold.merge_partials)
    store.start(totals)
    store.start(totals)
    assert store.waiting() == 0 and spark.read.parquet(store.base).agg({"transaction_count": "sum"}).first()[0] == rows.count()


def test_expired_partitions_of_a_catalog_table_are_dropped(spark):
    rows = spark.createDataFrame([(1, 2019, 5), (2, 2020, 1), (3, 2024, 2)], "id int, transaction_year int, transaction_month int")
    rows.write.mode("overwrite").partitionBy("transaction_year", "transaction_month").saveAsTable("retained")
    tables.drop_expired_partitions(spark, "retained", dt.date(2025, 2, 1), 24)
    assert [r.id for r in spark.table("retained").collect()] == [3]
    spark.sql("DROP TABLE retained")


def test_ratios_are_exact_and_rounded_once(spark):
    """Half-way quotients, quotients just beside them, sums beyond 64 bits, tiny doubles, signs, zero and NULL divisors."""
    d = lambda x, kind: F.lit(x).cast(kind)
    row = spark.range(1).select(
        clean.percent(d("7036.90", "decimal(10,2)"), d("142958.14", "decimal(12,2)"), places=4).alias("beside_half"),  # 4.922349997...
        clean.exact_ratio(F.lit(1), F.lit(8)).alias("half"), clean.exact_ratio(F.lit(-1), F.lit(8)).alias("minus_half"),
        clean.exact_ratio(d("9223372036854775807", "bigint"), F.lit(7)).alias("long"),
        clean.exact_ratio(d("9" * 28, "decimal(28,0)"), F.lit(7)).alias("wide"),
        clean.exact_ratio(F.lit(1e-12), F.lit(4e-12)).alias("tiny"), clean.percent(F.lit(1e-12), F.lit(4e-12)).alias("tiny_percent"),
        clean.exact_ratio(F.lit(10), F.lit(-3), 0).alias("minus"), clean.exact_ratio(F.lit(1), F.lit(0)).alias("zero"),
        clean.exact_ratio(d(None, "int"), F.lit(3)).alias("null"), clean.percent(F.lit(1), F.lit(0), F.lit(0)).alias("other"),
    ).first()
    assert [str(x) for x in row[:5]] == ["4.9223", "0.13", "-0.13", "1317624576693539401.00", "1428571428571428571428571428.43"]
    assert (row.tiny, row.tiny_percent, row.zero, row["null"]) == (0.25, 25.0, None, None) and [float(row.minus), float(row.other)] == [-3, 0]
    rows = spark.createDataFrame([(1, 2.0), (2, 4.0), (2, None)], "k int, x double")
    mean = rows.agg(clean.exact_ratio(F.sum("k"), F.count("*"), 4).alias("k"), clean.exact_ratio(F.sum("x"), F.count("x")).alias("x"))
    assert dict(mean.dtypes) == {"k": "decimal(38,4)", "x": "double"} and str(mean.first().k) == "1.6667" and mean.first().x == 3.0


def test_ratios_keep_small_values(spark):
    row = spark.range(1).select(
        clean.percent(F.lit("0.004").cast("decimal(6,3)"), F.lit("0.005").cast("decimal(6,3)")).alias("a"),
        clean.percent(F.lit(0.005), F.lit(0.01)).alias("b"),
        clean.exact_ratio(F.lit("0.009").cast("decimal(6,3)"), F.lit(2), 4).alias("c"),
    ).first()
    assert [float(x) for x in row] == [80.0, 50.0, 0.0045]
    small = spark.createDataFrame([(0.005,), (0.015,), (0.01,)], "x double")
    got = {r.column_name: r for r in profile.profile_columns(small, ["x"], []).collect()}["x"]
    assert (float(got.min_number), float(got["median"]), float(got.max_number), float(got["mean"])) == (0.005, 0.01, 0.015, 0.01)


def test_a_large_delivery_lands_as_more_files(spark):
    import types

    from checks import flows

    k = types.SimpleNamespace(spark=spark, stage={"t": spark.range(1000).withColumn("v", F.col("id") % 7)})
    path, schema, parts = flows._landing(k, "t", copies=2, files=2, file_rows=100)
    per_file = spark.read.parquet(path).groupBy(F.input_file_name().alias("f")).count().collect()
    assert parts == 5 and len(per_file) == 20 and max(r["count"] for r in per_file) <= 110
    landed = spark.read.schema(schema).parquet(path).groupBy("id").count().collect()
    assert len(landed) == 1000 and {r["count"] for r in landed} == {2}
    assert flows._landing(k, "t", files=4)[2] == 1


def test_a_delivery_of_many_rows_is_not_shuffled(spark, monkeypatch):
    """Its scan's tasks write their own rows, in files of bounded size; small tables are dealt as before."""
    import types

    from checks import flows

    monkeypatch.setattr(flows, "DEALT_ROWS", 500)
    k = types.SimpleNamespace(spark=spark, stage={"t": spark.range(0, 1000, numPartitions=8).withColumn("v", F.col("id") % 7)})
    path, schema, parts = flows._landing(k, "t", copies=2, files=2, file_rows=100)
    per_file = spark.read.parquet(path).groupBy(F.input_file_name().alias("f")).agg(F.count("*").alias("n"), (F.max("id") - F.min("id")).alias("span")).collect()
    assert sorted(r["n"] for r in per_file) == 16 * [25] + 16 * [100] and all(r["span"] == r["n"] - 1 for r in per_file)
    assert parts == 8  # 32 files in four batches, as two deliveries of two files would come
    landed = spark.read.schema(schema).parquet(path).groupBy("id").count().collect()
    assert len(landed) == 1000 and {r["count"] for r in landed} == {2}


def test_streams_shuffle_delivered_columns_only(spark):
    lake, path, schema, _ = _few_months(spark, 2)
    batch = spark.read.schema(schema).parquet(path)
    whole, clustered = (jobs.clean_transactions(batch, lake.as_of, lake.run_ts, clustered=c) for c in (False, True))
    plan = clustered._jdf.queryExecution().optimizedPlan().toString()
    above, below = plan.split("RebalancePartitions")
    assert "amount_abs" in above and "amount_abs" not in below and "_normalized" not in below
    assert whole.exceptAll(clustered).count() == clustered.exceptAll(whole).count() == 0


def test_only_uuids_and_places_travel_to_the_state(spark):
    """A file of several bitmaps with repeated and missing uuids, delivered twice with other dates: the rows stored whole, each once."""
    lake, _, schema, rows = _few_months(spark, 1)
    many = rows.crossJoin(spark.range(1000).withColumnRenamed("id", "n")).limit(80000)
    many = many.withColumn("transaction_uuid", F.when(F.col("n") % 50 < 49, F.concat("transaction_uuid", F.lit(" "), F.col("n") % 300)))
    source, again, out, plain, checkpoint = (work_folder(spark, n) for n in ("arriving it's", "again", "silver", "plain", "checkpoint"))
    many.drop("n").coalesce(1).write.parquet(source)
    delivered = spark.read.schema(schema).parquet(source)
    read = []

    def files(paths):
        read.append(len(paths))
        return spark.read.schema(schema).parquet(*paths)

    def run(to, at, **given):
        jobs.stream_clean_dedup(jobs.file_stream(spark, source, schema), lake.as_of, lake.run_ts, to, at, **given)

    run(out, checkpoint, files=files)
    run(plain, work_folder(spark, "checkpoint"))
    stored = jobs.landed(spark, out)
    silver = jobs.clean_transactions(delivered, lake.as_of, lake.run_ts).drop(jobs.EVENT_TIME)
    uuids = silver.where("transaction_uuid is not null").select("transaction_uuid").distinct().count()
    nameless = silver.where("transaction_uuid is null").count()
    assert 20000 < uuids < silver.count() - nameless and nameless > 500 and silver.count() > jobs.BLOCK
    assert stored.count() == jobs.landed(spark, plain).count() == uuids + nameless
    assert stored.columns == jobs.landed(spark, plain).columns
    assert stored.exceptAll(silver.select(*stored.columns)).count() == 0
    delivered.where("transaction_uuid is not null").withColumn("transaction_date", F.col("transaction_date") + F.expr("INTERVAL 9 MONTH")).write.parquet(again)
    spark.read.schema(schema).parquet(again).coalesce(2).write.mode("append").parquet(source)
    run(out, checkpoint, files=files)
    assert jobs.landed(spark, out).count() == uuids + nameless and read == [1]  # no row of the second delivery is read again
