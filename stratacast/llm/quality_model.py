"""Quality classifier: kernel ridge regression by random Fourier features.

Statistics of a document are mapped to cosines of random projections, whose
inner products approximate a Gaussian kernel. The normal equations of ridge
regression are sums over rows, so each partition sends one matrix. Scores are
then calibrated by isotonic regression on rows the ridge has not seen.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratacast.llm.common import fold_of, fold_of_value
from stratacast.llm.labelled import SAMPLE_ROWS, calibrated, isotonic, labelled_sample
from stratacast.session import ensure_checkpoint_dir

FOLDS, HELD = 5, 0
CALIBRATION = 1
FEATURES = 256
RIDGE = 1e-2
PARTS = 8
SEED = 20240
CUT = 0.3

_CLASS = np.zeros((256, 7))
for _n, _chars in enumerate(
    (range(65, 91), range(97, 123), range(48, 58), b"#*$%&|<>", b".,;:", b"!?", range(128, 256))
):
    _CLASS[list(_chars), _n] = 1
N_STATS = 18


def text_stats(text: bytes) -> list[float]:
    """Language-independent statistics of a UTF-8 text; all zero for an empty one."""
    words = text.split()
    if not words:
        return [0.0] * N_STATS
    n = len(words)
    shares = np.bincount(np.frombuffer(text, np.uint8), minlength=256) @ _CLASS / len(text)
    lengths = np.fromiter(map(len, words), np.float64, n)
    lines = [x for x in text.split(b"\n") if x.strip()]
    stops = sum(x.rstrip().endswith((b".", b"!", b"?")) for x in lines)
    triples = set(zip(words, words[1:], words[2:], strict=False))
    vocabulary = len(set(words))
    return [
        np.log1p(n),
        np.log1p(lengths.mean()),
        np.log1p(lengths.std()),
        np.log1p(lengths.max()),
        *shares,
        np.log(vocabulary) / np.log(n) if n > 1 else 1.0,
        len(triples) / (n - 2) if n > 2 else 1.0,
        sum(map(eq, words, words[1:])) / n,
        len(set(lines)) / len(lines),
        np.log1p(n / len(lines)),
        stops / len(lines),
        len(_SENTENCE.findall(text)) / n,
    ]


_SENTENCE = re.compile(rb"[.!?]\s")


@dataclass
class QualityModel:
    mean: np.ndarray
    scale: np.ndarray
    projection: np.ndarray
    phase: np.ndarray
    weights: np.ndarray
    curve: tuple[np.ndarray, np.ndarray]

    def features(self, stats: np.ndarray) -> np.ndarray:
        x = np.clip((stats - self.mean) / self.scale, -6, 6)
        return np.hstack([np.ones((len(x), 1)), np.cos(x @ self.projection + self.phase) * np.sqrt(2 / len(self.phase))])

    def raw(self, stats: np.ndarray) -> np.ndarray:
        return self.features(stats) @ self.weights


def _stat_rows(texts: pa.Array) -> np.ndarray:
    raw = texts.cast(pa.binary()).to_pylist()
    return np.array([text_stats(t or b"") for t in raw], np.float64).reshape(len(raw), N_STATS)


def stats_of(sample: DataFrame) -> DataFrame:
    """(doc_id, label, stats) of labelled documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            stats = pa.array(_stat_rows(b.column("text")).tolist(), pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("label"), stats], ["doc_id", "label", "stats"])

    return sample.mapInArrow(run, "doc_id long, label double, stats array<double>")


def fit_quality(
    docs: DataFrame, labels: DataFrame, label: str = "quality", *, rows: int = SAMPLE_ROWS, features: int = FEATURES
) -> QualityModel:
    """Fit on at most ``rows`` labelled documents outside the held-out fold.

    One fold of them calibrates, the others give the normal equations, one
    matrix per partition of a fixed number of partitions. Without labels every
    score is 0.5; with a single class it is that class's share.
    """
    ensure_checkpoint_dir(docs.sparkSession)
    sample = labelled_sample(docs, labels, label, FOLDS, HELD, rows).withColumn("doc_id", F.col("doc_id").cast("long"))
    seen = stats_of(sample).withColumn("_fold", fold_of(F.col("doc_id"), FOLDS)).checkpoint()
    train = seen.where(F.col("_fold") != CALIBRATION)

    moments = [g(F.get("stats", k)) for k in range(N_STATS) for g in (F.avg, F.stddev_pop)]
    values = np.array([0.0 if v is None else v for v in train.agg(*moments).first()], np.float64).reshape(N_STATS, 2)
    rng = np.random.default_rng(SEED)
    model = QualityModel(
        values[:, 0],
        np.maximum(values[:, 1], 1e-3),
        rng.normal(0.0, 1 / np.sqrt(N_STATS), (N_STATS, features)),
        rng.uniform(0, 2 * np.pi, features),
        np.zeros(features + 1),
        (np.array([]), np.array([])),
    )

    def sums(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        gram, moment = np.zeros((features + 1, features + 1)), np.zeros(features + 1)
        for b in batches:
            if len(b):
                z = model.features(np.array(b["stats"].tolist()))
                gram += z.T @ z
                moment += z.T @ b["label"].to_numpy()
        yield pd.DataFrame({"gram": [gram.tobytes()], "moment": [moment.tobytes()]})

    # PARTS matrices, whatever the size of the corpus; the sample itself is bounded.
    parts = train.repartition(PARTS).mapInPandas(sums, "gram binary, moment binary").collect()
    gram = sum(np.frombuffer(p["gram"]) for p in parts).reshape(features + 1, features + 1)
    moment = sum(np.frombuffer(p["moment"]) for p in parts)
    penalty = RIDGE * np.eye(features + 1)
    penalty[0, 0] = 1e-9
    model.weights = np.linalg.solve(gram + penalty * max(1.0, gram[0, 0] / 1000), moment)

    def raw(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            if len(b):
                yield pd.DataFrame({"raw": model.raw(np.array(b["stats"].tolist())), "label": b["label"]})

    held_back = seen.where(F.col("_fold") == CALIBRATION)
    if held_back.limit(1).count():
        model.curve = isotonic(held_back.mapInPandas(raw, "raw double, label double"))
    return model


def quality_scores(docs: DataFrame, model: QualityModel) -> DataFrame:
    """doc_id, held_out, score and predicted for every row of ``docs``.

    Only the text is looked at. Null and empty texts have zero statistics and
    are scored like any other; repeated rows give repeated results; other
    columns are ignored; a null id is in no held-out fold.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids = b.column("doc_id")
            score = calibrated(model.raw(_stat_rows(b.column("text"))), model.curve)
            held = [i is not None and fold_of_value(i, FOLDS) == HELD for i in ids.to_pylist()]
            columns = [ids, pa.array(held, pa.bool_()), pa.array(score), pa.array((score >= CUT).astype(np.int32))]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "held_out", "score", "predicted"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int")


def accepted(docs: DataFrame, model: QualityModel) -> DataFrame:
    """The documents, with their own columns, that the model does not reject."""

    def keep(texts: pd.Series) -> pd.Series:
        stats = _stat_rows(pa.array(texts, pa.string()))
        return pd.Series(calibrated(model.raw(stats), model.curve) >= CUT)

    return docs.where(F.pandas_udf(keep, "boolean")(F.col("text").cast("string")))
