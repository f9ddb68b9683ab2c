"""Bounded labelled samples and monotone calibration, shared by the two classifiers."""

from __future__ import annotations

import numpy as np
from pyspark.ml.functions import array_to_vector
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratacast.llm.common import fold_of

# Rows of labelled documents that a model is fitted on, chosen by a hash of their id.
SAMPLE_ROWS = 20_000


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, folds: int, held: int, rows: int) -> DataFrame:
    """(doc_id, text, label): at most ``rows`` documents with a label outside the held-out fold.

    Null labels and ids are left out; of several labels of one id the largest
    counts, of several texts of one id each is a row. The ids are at most
    ``rows`` longs, which bounds the broadcast.
    """
    chosen = (
        labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull() & (fold_of(F.col("doc_id"), folds) != held))
        .groupBy(F.col("doc_id").alias("_label_id"))
        .agg(F.max(F.col(label)).cast("double").alias("label"))
        .orderBy(F.xxhash64("_label_id"), "_label_id")
        .limit(rows)
    )
    # Other columns of the documents may have any name, ``label`` too.
    return docs.select("doc_id", "text").join(F.broadcast(chosen), F.col("doc_id") == F.col("_label_id")).select("doc_id", "text", "label")


def isotonic(scored: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """(raw scores, calibrated scores) between which one interpolates; from columns raw and label."""
    frame = scored.select("label", array_to_vector(F.array("raw")).alias("features"))
    model = IsotonicRegression(isotonic=True).fit(frame)
    return model.boundaries.toArray(), model.predictions.toArray()


def calibrated(raw: np.ndarray, curve: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """Interpolated on the curve; a thousandth of the raw order is kept so that steps stay ranked."""
    at, value = curve
    if not len(at):
        return np.full(len(raw), 0.5)
    order = 0.5 + np.arctan(raw) / np.pi
    return np.clip(0.999 * np.interp(raw, at, value) + 0.001 * order, 0.0, 1.0)
