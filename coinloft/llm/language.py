"""Language identification: averaged hashed subword vectors, a linear softmax, and calibrated rejection."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from coinloft.llm import subword as S

FEATURES = S.Features(bits=16, grams=(3, 4), words=True, raw=False)
MAX_ROWS = 3000  # texts a model is fitted on
PRECISION = 0.99  # that the accepted predictions keep on the calibration texts
UNKNOWN = "und"


def fit(docs: DataFrame, usable, key: str = "doc_id", label: str = "lang", max_rows: int = MAX_ROWS, precision: float = PRECISION) -> S.Model:
    """Learn ``label`` from the rows that fulfil ``usable``; null labels and texts are left out.

    The calibration texts set the temperature and ``reject_below``: the smallest top probability above which the share of
    right predictions is at least ``precision``.
    """
    known = docs.where(usable).select(key, F.col(label).alias("label"))
    model = S.train(S.sample_features(docs, known, key, FEATURES, max_rows), FEATURES, dim=10, epochs=4)
    if "top" in model.notes:
        top, right = model.notes["top"], model.notes["right"]
        order = np.argsort(-top)
        share = np.cumsum(right[order]) / np.arange(1, len(order) + 1)
        enough = np.flatnonzero(share >= precision)
        model.reject_below = float(top[order][enough[-1]]) if len(enough) else 1.0
    return model


def _scorer(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        names = np.array([*model.labels, UNKNOWN], dtype=object)
        for batch in batches:
            p, _ = S.score(batch.column("text"), model)
            best = p.argmax(1) if p.shape[1] else np.full(batch.num_rows, len(names) - 1)
            top = p.max(1) if p.shape[1] else np.zeros(batch.num_rows)
            lettered = np.asarray(batch.column("lettered").to_numpy(zero_copy_only=False), bool)
            top, best = np.where(lettered, top, 0.0), np.where(lettered, best, len(names) - 1)
            accepted = lettered & (top >= model.reject_below)
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), pa.array(names[best], pa.string()), pa.array(top, pa.float64()), pa.array(accepted)],
                ["key", "lang_pred", "score", "accepted"],
            )

    return run


def identify(docs: DataFrame, model: S.Model, key: str = "doc_id") -> DataFrame:
    """key, lang_pred, score, accepted: one row per input row.

    ``lang_pred`` is always a learned language, the likeliest; ``accepted`` is false where its calibrated probability
    is below the rejection level. Null texts and texts without a letter give ``und``, score 0, not accepted. With no
    example at all every text is ``und``. Equal scores go to the label that sorts first.
    """
    rows = docs.select(F.col(key).alias("key"), "text", F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)).alias("lettered"))
    added = [("lang_pred", T.StringType()), ("score", T.DoubleType()), ("accepted", T.BooleanType())]
    schema = T.StructType([rows.schema["key"], *(T.StructField(*x) for x in added)])
    shared = docs.sparkSession.sparkContext.broadcast(model)  # a table of 2^16 rows, whatever the input's size
    return rows.mapInArrow(_scorer(shared), schema).withColumnRenamed("key", key)


def languages(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score, accepted; rows in the held-out fold are never learned from."""
    out_of_fit = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, F.lit(True))
    return identify(docs, fit(docs, ~out_of_fit)).select("doc_id", out_of_fit.alias("held_out"), "lang_pred", "score", "accepted")
