"""Quality classifier: supervised subword embeddings under a softmax."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from coinloft.llm import subword as S

FEATURES = S.Features(bits=17, grams=(3, 4), words=True, repeats=True, raw=True)
MAX_ROWS = 3000  # labelled texts a model is fitted on
THRESHOLD = 0.3


def held_out(key: str = "doc_id"):
    """Rows whose key's CRC leaves 0 on division by 5 are never learned from; a null key is held out."""
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % 5 == 0, F.lit(True))


def fit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", label: str = "quality", max_rows: int = MAX_ROWS) -> S.Model:
    """Learn ``label`` from the texts outside the held-out fold.

    Null labels and null texts are left out. A document labelled twice is two examples. Only the text is an input.
    """
    known = labels.where(~held_out(key)).select(key, F.col(label).alias("label"))
    return S.train(S.sample_features(docs, known, key, FEATURES, max_rows), FEATURES)


def _scorer(shared, positive: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            p, count = S.score(batch.column("text"), model)
            at = model.labels.index(positive) if positive in model.labels else -1
            good = p[:, at] if at >= 0 else np.zeros(batch.num_rows)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(good, pa.float64()), pa.array(count.astype(np.int64))], [*batch.schema.names, "score", "n_features"])

    return run


def score(docs: DataFrame, model: S.Model, positive: str = "1") -> DataFrame:
    """``docs`` with ``score`` (0 to 1, higher: better) and ``n_features``; one row per input row, in one pass.

    A null or empty text has no feature and gets the score of the class shares alone. Without any example every score is
    0. Columns named score or n_features in the input are replaced.
    """
    docs = docs.drop("score", "n_features")
    schema = T.StructType([*docs.schema.fields, T.StructField("score", T.DoubleType()), T.StructField("n_features", T.LongType())])
    shared = docs.sparkSession.sparkContext.broadcast(model)  # a table of 2^17 rows, whatever the input's size
    return docs.mapInArrow(_scorer(shared, positive), schema)


def quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted, n_features per document."""
    out = score(docs.select("doc_id", "text"), fit(docs, labels))
    return out.select(
        "doc_id", held_out().alias("held_out"), "score", F.when(F.col("score") >= THRESHOLD, 1).otherwise(0).alias("predicted"),
        "n_features",
    )


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs``, with their columns, that score ``threshold`` or more."""
    names = docs.columns
    carried = docs.select(*[F.col(f"`{c}`").alias(f"c_{i}") if c != "text" else F.col("text") for i, c in enumerate(names)])
    scored = score(carried, fit(docs, labels)).where(F.col("score") >= threshold)
    return scored.select(*[F.col("text") if c == "text" else F.col(f"c_{i}").alias(c) for i, c in enumerate(names)])
