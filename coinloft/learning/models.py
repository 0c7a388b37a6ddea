"""Spark ML pipelines. Each returns (predictions, metrics) as DataFrames.

Features are written once to the shared folder: training passes over them many
times and must not repeat the joins, and a lost executor only re-reads files.
"""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark import SparkContext, inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import IDF, HashingTF, StandardScaler, StringIndexer, Tokenizer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import rules
from ..functions import clean
from ..session import cut_lineage, work_folder

FRAUD_CODES = ["risk_category", "account_type_normalized", "transaction_type_normalized", "category_normalized"]
FRAUD_NUMBERS = [
    "amount", "transaction_hour", "is_weekend", "age", "credit_score", "annual_income", "amount_to_income_ratio",
    "is_high_risk_client", "is_low_credit_score",
]
CREDIT_NUMBERS = [
    "age", "credit_score", "annual_income", "loan_amount", "interest_rate", "loan_to_value_ratio",
    "debt_to_income_ratio", "income_to_age_ratio", "outstanding_pct",
]
CHURN_NUMBERS = [
    "age", "credit_score", "annual_income", "customer_tenure_days", "num_accounts", "num_products", "total_balance",
    "transaction_count_90d", "days_since_last_transaction",
]


TASK_ROWS = 500_000  # of a training table, at most, that one task of a training pass goes over
WORTH_ROWS = 10_000  # that are worth a task


def _dealt(table: DataFrame) -> DataFrame:
    """The rows in files of like size, one for every core that they keep busy, more beyond ``TASK_ROWS`` a file.

    A join leaves its rows in as few files as their bytes need, and each of the hundreds of training passes would run in
    as few tasks. Rows are dealt by a hash of all columns and sorted in their file, so a retry or another run deals them out alike.
    """
    rows = table.count()  # of a written table, from the footers
    cores = table.sparkSession.sparkContext.defaultParallelism
    files = max(-(-rows // TASK_ROWS), min(cores, -(-rows // WORTH_ROWS)), 1)
    return cut_lineage(table.repartition(files, *table.columns).sortWithinPartitions(*table.columns), "dealt")


def training_table(features: DataFrame, keys: Sequence[str], numbers: Sequence[str], codes: Sequence[str], label: str) -> DataFrame:
    """Doubles without gaps, written once and dealt over the cores."""
    ready = features.select(
        *keys,
        *[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in numbers],
        *[F.coalesce(c, F.lit("UNKNOWN")).alias(c) for c in codes],
        F.col(label).cast("double").alias("label"),
    )
    return _dealt(cut_lineage(ready, "features"))


def split(df: DataFrame, keys: Sequence[str], seed: int = 42, train_pct: int = 80) -> tuple[DataFrame, DataFrame]:
    """By a hash of the key: the same row lands on the same side in every retry."""
    slot = F.pmod(F.xxhash64(F.lit(seed), *keys), F.lit(100))
    return df.where(slot < train_pct), df.where(slot >= train_pct)


def _fitted(pipeline: Pipeline, train: DataFrame) -> PipelineModel:
    """The fitted pipeline, stored and read back, without the training summaries of its models.

    A summary holds the session, which Spark cannot send to tasks once a DataFrame was observed in it.
    """
    path = work_folder(train.sparkSession, "model")
    pipeline.fit(train).write().save(path)
    return PipelineModel.load(path)


def _scored(model, test: DataFrame, keys: Sequence[str]) -> DataFrame:
    out = model.transform(test).select(
        *keys, "label", "prediction", vector_to_array("probability")[1].alias("score")
    )
    return cut_lineage(out, "predictions")


def evaluate(scored: DataFrame) -> DataFrame:
    """Metric rows: AUC of both curves, then figures from one four-row confusion matrix."""
    metrics = {}
    for name in ("areaUnderROC", "areaUnderPR"):
        metrics[name] = BinaryClassificationEvaluator(rawPredictionCol="score", labelCol="label", metricName=name).evaluate(scored)
    cells = {(r["label"], r["prediction"]): r["count"] for r in scored.groupBy("label", "prediction").count().collect()}
    n = sum(cells.values())
    classes = (0.0, 1.0)
    precision = recall = f1 = 0.0
    for c in classes:
        hit = cells.get((c, c), 0)
        actual = sum(cells.get((c, p), 0) for p in classes)
        named = sum(cells.get((a, c), 0) for a in classes)
        p, r = (hit / named if named else 0.0), (hit / actual if actual else 0.0)
        share = actual / n if n else 0.0
        precision, recall = precision + share * p, recall + share * r
        f1 += share * (2 * p * r / (p + r) if p + r else 0.0)
    metrics.update(
        accuracy=sum(cells.get((c, c), 0) for c in classes) / n if n else 0.0, weightedPrecision=precision,
        weightedRecall=recall, f1=f1,
    )
    for a in classes:
        for p in classes:
            metrics[f"label_{int(a)}_predicted_{int(p)}"] = float(cells.get((a, p), 0))
    rows = [(name, float(value)) for name, value in metrics.items()]
    return scored.sparkSession.createDataFrame(rows, "metric string, value double")


NODE_IDS = 1 << 31  # of rows times trees at work, at most, whose nodes are kept: 8 GB over all executors


def _forest(cells: int, **params) -> RandomForestClassifier:
    """A forest that keeps the node each row stands at, per tree, beside the training rows: a level's pass moves rows on by one split
    instead of sending them down from the root again. The trees are the same. Beyond ``NODE_IDS`` cells (rows times trees) the nodes
    would be written to disk on every level, and are found anew."""
    return RandomForestClassifier(cacheNodeIds=cells <= NODE_IDS, **params)


def _fraud_pipeline(trees: int, depth: int, seed: int, rows: int = 0) -> Pipeline:
    indexers = [StringIndexer(inputCol=c, outputCol=f"{c}_idx", handleInvalid="keep") for c in FRAUD_CODES]
    return Pipeline(stages=[
        *indexers,
        VectorAssembler(inputCols=[*FRAUD_NUMBERS, *[f"{c}_idx" for c in FRAUD_CODES]], outputCol="raw"),
        StandardScaler(inputCol="raw", outputCol="features"),
        _forest(rows * trees, numTrees=trees, maxDepth=depth, seed=seed),
    ])


def fraud_model(features: DataFrame, trees: int = 100, depth: int = 10, seed: int = 42) -> tuple[DataFrame, DataFrame]:
    keys = ["transaction_uuid"]
    table = training_table(features, keys, FRAUD_NUMBERS, FRAUD_CODES, "label")
    train, test = split(table, keys, seed)
    scored = _scored(_fitted(_fraud_pipeline(trees, depth, seed, train.count()), train), test, keys)
    return scored, evaluate(scored)


def _first_trees(forest: RandomForestClassificationModel, count: int) -> RandomForestClassificationModel:
    """The forest of the first ``count`` trees. Trees are grown independently, so it is a forest of that size like any other.

    It has no training summary (see ``_fitted``).
    """
    java, context = forest._java_obj, SparkContext._active_spark_context
    kept = context._gateway.new_array(context._jvm.org.apache.spark.ml.classification.DecisionTreeClassificationModel, count)
    for i, tree in enumerate(list(java.trees())[:count]):
        kept[i] = tree
    small = context._jvm.org.apache.spark.ml.classification.RandomForestClassificationModel(kept, java.numFeatures(), java.numClasses())
    return RandomForestClassificationModel(small)


def tune_grid_cv(
    features: DataFrame, trees=(50, 100, 150), depths=(5, 10, 15), min_rows=(1, 5, 10), folds: int = 3, seed: int = 42,
    parallelism: int = 8,
) -> DataFrame:
    """Mean AUC of every grid point over the folds, best first, with the best one's AUC on the held-out rows.

    Per fold the features are prepared once and written; per depth and row limit one forest of the most trees is grown, whose
    first trees are the smaller forests. Folds are key hashes, so a retry deals rows out alike.
    """
    keys = ["transaction_uuid"]
    table = training_table(features, keys, FRAUD_NUMBERS, FRAUD_CODES, "label")
    train, test = split(table, keys, seed)
    stages = _fraud_pipeline(max(trees), 5, seed).getStages()
    cells = train.count() * max(trees) * parallelism
    judge = BinaryClassificationEvaluator(labelCol="label", metricName="areaUnderROC")

    def prepared(fit_on: DataFrame, rows: DataFrame) -> DataFrame:
        # as many files as the training table has: forests of one task each would leave cores idle while the last and the final one grow
        return cut_lineage(Pipeline(stages=stages[:-1]).fit(fit_on).transform(rows).select("label", "features", "held"), "fold")

    def forest(rows: DataFrame, depth: int, least: int, count: int) -> RandomForestClassificationModel:
        return _forest(cells, numTrees=count, maxDepth=depth, minInstancesPerNode=least, seed=seed).fit(rows.where("not held"))

    fold = F.pmod(F.xxhash64(F.lit(seed + 1), *keys), F.lit(folds))
    ready = [prepared(train.where(fold != k), train.withColumn("held", fold == k)) for k in range(folds)]

    def judged(job: tuple[int, int, int]) -> dict[tuple[int, int, int], float]:
        k, depth, least = job
        grown = forest(ready[k], depth, least, max(trees))
        held = ready[k].where("held")
        return {(n, depth, least): judge.evaluate(_first_trees(grown, n).transform(held)) for n in trees}

    jobs = [(k, d, m) for d in sorted(depths, reverse=True) for m in min_rows for k in range(folds)]  # the dear ones first
    with ThreadPoolExecutor(parallelism) as pool:
        parts = list(pool.map(inheritable_thread_target(features.sparkSession)(judged), jobs))
    points = sorted({p for part in parts for p in part})
    mean = {p: sum(part[p] for part in parts if p in part) / folds for p in points}
    count, depth, least = max(points, key=lambda p: mean[p])
    whole = prepared(train, train.withColumn("held", F.lit(False)).unionByName(test.withColumn("held", F.lit(True))))
    held_out = judge.evaluate(_first_trees(forest(whole, depth, least, count), count).transform(whole.where("held")))
    rows = [(*p, float(mean[p]), float(held_out) if p == (count, depth, least) else None) for p in points]
    rows.sort(key=lambda r: -r[3])
    return features.sparkSession.createDataFrame(
        rows, "num_trees int, max_depth int, min_instances int, mean_auc double, test_auc double"
    )


def credit_risk_model(features: DataFrame, iterations: int = 100, seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """Gradient-boosted trees; the score is (1 - probability) * 1000 with its risk band."""
    spark = features.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:  # boosting cuts its lineage every ten rounds
        spark.sparkContext.setCheckpointDir(work_folder(spark, "boosting"))
    keys = ["loan_id", "client_id"]
    table = training_table(features, keys, CREDIT_NUMBERS, [], "is_delinquent")
    train, test = split(table, keys, seed)
    pipeline = Pipeline(stages=[
        VectorAssembler(inputCols=CREDIT_NUMBERS, outputCol="raw"),
        StandardScaler(inputCol="raw", outputCol="features"),
        GBTClassifier(maxIter=iterations, seed=seed, checkpointInterval=10),
    ])
    scored = _scored(pipeline.fit(train), test, keys)
    points = F.round((1 - F.col("score")) * 1000, 0)
    banded = scored.withColumn("credit_risk_score", points).withColumn(
        "risk_band", clean.at_least("credit_risk_score", rules.RISK_SCORE_BAND)
    )
    return banded, evaluate(scored)


def churn_model(features: DataFrame, seed: int = 42) -> tuple[DataFrame, DataFrame]:
    keys = ["client_id"]
    table = training_table(features, keys, CHURN_NUMBERS, [], "is_churned")
    train, test = split(table, keys, seed)
    pipeline = Pipeline(stages=[VectorAssembler(inputCols=CHURN_NUMBERS, outputCol="features"), LogisticRegression()])
    scored = _scored(_fitted(pipeline, train), test, keys)
    banded = scored.withColumn("churn_propensity_score", F.round(F.col("score") * 100, 2)).withColumn(
        "churn_risk", clean.at_least("churn_propensity_score", rules.CHURN_BAND)
    )
    return banded, evaluate(scored)


def doc_classify(documents: DataFrame, labels: DataFrame, label: str = "quality", seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """Train on the labelled whole texts, score every document."""
    texts = documents.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    marked = texts.join(labels.select("doc_id", F.col(label).cast("double").alias("label")), "doc_id", "left")
    table = cut_lineage(marked, "documents")
    train, test = split(table.where(F.col("label").isNotNull()), ["doc_id"], seed)
    pipeline = Pipeline(stages=[
        Tokenizer(inputCol="text", outputCol="words"),
        HashingTF(inputCol="words", outputCol="counts", numFeatures=1 << 16),
        IDF(inputCol="counts", outputCol="features"),
        LogisticRegression(maxIter=20, regParam=0.01),
    ])
    model = _fitted(pipeline, train)
    metrics = evaluate(_scored(model, test, ["doc_id"]))
    return _scored(model, table, ["doc_id"]), metrics
