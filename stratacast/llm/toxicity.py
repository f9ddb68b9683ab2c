"""Toxicity by the nearest labelled examples under exact TF-IDF cosine.

Terms are words and beginnings of words that labelled documents associate with
the label; all other words together are one further term, so that one odd word
in a long text weighs little. Equal example vectors are merged into one entry
that carries its votes. Entries lie in blocks; per term the largest weight in
a block bounds what any entry of it can score, and blocks that cannot reach
the k-th best are skipped.

A second index covers all words of the examples (see ``near_examples``). The
toxic examples that are near copies of a text vote too, however few of the
chosen terms they have: a copy of a toxic example is toxic even where no term of it is
associated with the label. An example votes only if the text has all its chosen
terms, so a text is not blamed for words that only its toxic variant has.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratacast.llm.common import fold_of_value
from stratacast.llm.labelled import SAMPLE_ROWS, calibrated, isotonic, labelled_sample
from stratacast.llm.near_examples import ExampleIndex, word_hash
from stratacast.session import ensure_checkpoint_dir

FOLDS, HELD = 4, 2
PREFIXES = (4, 5, 6, 7)
MIN_SUPPORT = 8
MIN_CHI2 = 30.0
MAX_TERMS = 4096
NEIGHBOURS = 15
SHARPNESS = 8
BLOCK = 64
BACKGROUND = 1.5
CUT = 0.3
REMEMBERED = 300_000
_NO_WORDS = np.zeros(0, np.int64)
_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def word_terms(word: str) -> list[str]:
    """The word itself, marked, and its beginnings."""
    return [f"={word}", *(word[:k] for k in PREFIXES if len(word) > k)]


def text_words(text: bytes) -> list[str]:
    return _WORD.findall(text.lower().decode())


def chi2(with_1: np.ndarray, with_0: np.ndarray, n1: int, n0: int) -> np.ndarray:
    """Association of a term with the label, from document counts."""
    without_1, without_0 = n1 - with_1, n0 - with_0
    top = (n1 + n0) * (with_1 * without_0 - with_0 * without_1) ** 2
    return top / np.maximum(1.0, (with_1 + with_0) * (without_1 + without_0) * n1 * n0)


class _Chunks(dict):
    """Hashes and term numbers of the words in a run between white space, remembered up to a bound."""

    def __init__(self, terms: dict[str, int], telling: frozenset[int]) -> None:
        super().__init__()
        self.terms, self.telling = terms, telling

    def __missing__(self, chunk: bytes) -> tuple[list[int], tuple[int, ...], bool]:
        words = _WORD.findall(chunk.decode())
        found = tuple(self.terms[t] for w in words for t in word_terms(w) if t in self.terms)
        hashes = [word_hash(w) for w in words]
        value = (hashes, found, not self.telling.isdisjoint(hashes))
        if len(self) >= REMEMBERED:
            self.clear()
        self[chunk] = value
        return value


@dataclass
class Vectors:
    """Turns texts into unit vectors; the last term is the background."""

    terms: dict[str, int]
    idf: np.ndarray
    telling: frozenset[int] = frozenset()
    _chunks: _Chunks | None = field(default=None, repr=False)

    def __getstate__(self) -> dict:
        return self.__dict__ | {"_chunks": None}

    def of(self, text: bytes) -> tuple[tuple[int, ...], tuple[float, ...]]:
        """(term numbers, weights), ascending; an empty text has no terms."""
        return self.whole(text)[0]

    def whole(self, text: bytes, always: bool = True) -> tuple[tuple, np.ndarray, np.ndarray]:
        """The same, and the distinct words as ascending hashes with their counts.

        Unless ``always``, a text without any telling word gets no words.
        """
        if self._chunks is None:
            self._chunks = _Chunks(self.terms, self.telling)
        looked = [self._chunks[c] for c in text.lower().split()]
        n, found, told = 0, [], always
        for hashes, terms, telling in looked:
            n += len(hashes)
            if terms:
                found += terms
            told = told or telling
        words = [h for hashes, _, _ in looked for h in hashes] if told else []
        distinct, times = np.unique(np.array(words, np.int64), return_counts=True) if words else (_NO_WORDS, _NO_WORDS)
        if not n:
            return ((), ()), distinct, times
        counts = Counter(found)
        at = sorted(counts)
        weights = [(1 + np.log(counts[t])) * self.idf[t] for t in at]
        at.append(len(self.terms))
        weights.append(BACKGROUND * np.log1p(n))
        norm = float(np.sqrt(sum(w * w for w in weights)))
        return (tuple(at), tuple(round(float(w) / norm, 6) for w in weights)), distinct, times


@dataclass
class BlockIndex:
    """Distinct example vectors with votes, in blocks with per-term bounds."""

    n_terms: int
    votes: np.ndarray
    toxic: np.ndarray
    owners: dict
    bounds: np.ndarray
    blocks: list

    @classmethod
    def build(cls, vectors: list, labels: list, n_terms: int) -> BlockIndex:
        merged: dict = {}
        for v, label in zip(vectors, labels, strict=True):
            n, y = merged.get(v, (0, 0.0))
            merged[v] = (n + 1, y + label)
        # Neighbours in this order share their first terms, which keeps the bounds of a block tight.
        order = sorted(merged)
        n_blocks = -(-len(order) // BLOCK)
        bounds = np.zeros((n_terms + 1, n_blocks))
        blocks = []
        for b in range(n_blocks):
            dense = np.zeros((n_terms + 1, BLOCK), np.float32)
            for k, (terms, weights) in enumerate(order[b * BLOCK : (b + 1) * BLOCK]):
                dense[list(terms), k] = weights
            used = np.flatnonzero(dense.any(axis=1))
            bounds[:, b] = dense.max(axis=1)
            blocks.append(({int(t): r for r, t in enumerate(used)}, dense[used].astype(np.float64)))
        return cls(
            n_terms,
            np.array([merged[v][0] for v in order], np.float64),
            np.array([merged[v][1] for v in order], np.float64),
            {v: n for n, v in enumerate(order)},
            bounds,
            blocks,
        )

    def nearest(self, vector: tuple, k: int = NEIGHBOURS) -> tuple[np.ndarray, np.ndarray]:
        """(entries, similarities) of the k most similar entries, exactly; ties by entry number."""
        terms, weights = vector
        if not terms or not self.blocks:
            return np.array([], int), np.array([])
        q = np.array(weights)
        limit = q @ self.bounds[list(terms)]
        at, sims = np.array([], int), np.array([])
        for b in np.argsort(-limit, kind="stable"):
            if len(sims) >= k and limit[b] < sims[-1] - 1e-6:
                break
            rows, dense = self.blocks[b]
            own = [(n, rows[t]) for n, t in enumerate(terms) if t in rows]
            score = q[[n for n, _ in own]] @ dense[[r for _, r in own]] if own else np.zeros(BLOCK)
            base = b * BLOCK
            here = np.arange(base, min(base + BLOCK, len(self.votes)))
            at = np.concatenate([at, here])
            sims = np.concatenate([sims, score[: len(here)]])
            best = np.lexsort((at, -sims))[:k]
            at, sims = at[best], sims[best]
        return at, sims

    def vote(self, vector: tuple, without: float | None = None) -> tuple[float, list]:
        """(raw score, evidence); ``without`` takes one example of that label out of its own entry."""
        at, sims = self.nearest(vector)
        votes, toxic = self.votes[at].copy(), self.toxic[at].copy()
        if without is not None:
            own = at == self.owners.get(vector, -1)
            votes, toxic = votes - own, toxic - own * without
        weight = np.maximum(sims, 0.0) ** SHARPNESS * np.minimum(votes, 1.0)
        total = float(weight.sum())
        share = np.divide(toxic, votes, out=np.zeros(len(at)), where=votes > 0)
        raw = float((weight * share).sum() / total) if total > 0 else 0.0
        return raw, [(int(a), float(s), float(p)) for a, s, p in zip(at[:3], sims, share, strict=False)]


@dataclass
class NearVotes:
    """Votes of the toxic examples that are near copies of a text over all words."""

    index: ExampleIndex
    chosen: list

    def vote(self, terms: tuple, hashes: np.ndarray, counts: np.ndarray, without: float | None = None) -> float:
        """The largest similarity to a near example that may vote, else 0.

        ``without`` 1 takes one example equal to the text out, the text itself.
        """
        at, sims = self.index.near(hashes, counts)
        if not len(at):
            return 0.0
        have = set(terms)
        may = np.array([have.issuperset(self.chosen[a]) for a in at.tolist()])
        if without:
            may[np.flatnonzero(sims > 1 - 1e-6)[:1]] = False
        return float(sims[may].max(initial=0.0))


def _near_votes(examples: pa.Table, labels: np.ndarray, chosen: list) -> NearVotes:
    """The index of the toxic examples, with weights of words from the whole sample.

    Only a toxic example raises a score. Clean examples that are near one are
    scored like any text when the curve is fitted, so a copy's score says how
    often such copies are toxic.
    """
    words, counts = (examples[c].combine_chunks() for c in ("words", "counts"))
    sizes = pc.list_value_length(words).to_numpy(zero_copy_only=False)
    hashes, times = (c.flatten().to_numpy(zero_copy_only=False) for c in (words, counts))
    toxic = np.flatnonzero(labels > 0).astype(np.int32)
    return NearVotes(ExampleIndex.build(sizes, hashes, times).restricted(toxic), [chosen[k] for k in toxic.tolist()])


@dataclass
class ToxicityModel:
    vectors: Vectors
    index: BlockIndex
    curve: tuple[np.ndarray, np.ndarray]
    prior: float
    # Vectors, index and near votes, sent to every executor once for fitting and scoring.
    shared: Broadcast


def _term_counts(sample: DataFrame) -> DataFrame:
    """Documents with each term per label; partitions count before the shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pd.DataFrame]:
        counts: tuple[Counter, Counter] = (Counter(), Counter())
        for b in batches:
            for text, label in zip(b.column("text").cast(pa.binary()).to_pylist(), b.column("label").to_pylist(), strict=True):
                counts[int(label > 0)].update({t for w in set(text_words(text or b"")) for t in word_terms(w)})
        # What is rare everywhere is dropped after the sums, not here.
        for label, found in enumerate(counts):
            names, values = list(found), list(found.values())
            for at in range(0, len(names), 50_000):
                part = slice(at, at + 50_000)
                n = len(names[part])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(names[part]), pa.array([label] * n, pa.int32()), pa.array(values[part], pa.int64())],
                    ["term", "label", "n"],
                )

    found = sample.select("text", "label").mapInArrow(run, "term string, label int, n long")
    return found.groupBy("term").agg(
        F.sum(F.when(F.col("label") == 1, F.col("n")).otherwise(0)).alias("n1"),
        F.sum(F.when(F.col("label") == 0, F.col("n")).otherwise(0)).alias("n0"),
    )


def fit_toxicity(docs: DataFrame, labels: DataFrame, label: str = "toxic", *, rows: int = SAMPLE_ROWS) -> ToxicityModel:
    """Terms, example index and calibration from at most ``rows`` labelled documents.

    The held-out fold is never read. Calibration scores each example without
    its own vote. Without labels, or with one class only, no term is chosen
    and every score is the share of the label (0 without labels).
    """
    ensure_checkpoint_dir(docs.sparkSession)
    sample = labelled_sample(docs, labels, label, FOLDS, HELD, rows).withColumn("text", F.col("text").cast("string"))
    sample = sample.checkpoint()
    counts = {int(r["label"] > 0): r["n"] for r in sample.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    n1, n0 = counts.get(1, 0), counts.get(0, 0)
    # Only terms above the significance bound come to the driver, MAX_TERMS at most.
    a, b = F.col("n1").cast("double"), F.col("n0").cast("double")
    association = (n1 + n0) * F.pow(a * (n0 - b) - b * (n1 - a), 2) / F.greatest(
        F.lit(1.0), (a + b) * (n1 + n0 - a - b) * float(n1) * float(n0)
    )
    chosen = (
        _term_counts(sample)
        .where((a + b >= MIN_SUPPORT) & (a * n0 > b * n1))
        .withColumn("_chi2", association)
        .where(F.col("_chi2") >= MIN_CHI2)
        .orderBy(F.desc("_chi2"), "term")
        .limit(MAX_TERMS)
        .collect()
    )
    terms = {r["term"]: k for k, r in enumerate(chosen)}
    idf = np.array([1 + np.log((n1 + n0 + 1) / (r["n1"] + r["n0"] + 1)) for r in chosen])
    vectors = Vectors(terms, idf)

    def to_vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches:
            found = [vectors.whole(t or b"") for t in part.column("text").cast(pa.binary()).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([v[0][0] for v in found], pa.list_(pa.int32())),
                    pa.array([v[0][1] for v in found], pa.list_(pa.float64())),
                    pa.array([v[1] for v in found], pa.list_(pa.int64())),
                    pa.array([v[2] for v in found], pa.list_(pa.int32())),
                    part.column("label"),
                ],
                ["at", "weights", "words", "counts", "label"],
            )

    made = sample.select("text", "label").mapInArrow(
        to_vectors, "at array<int>, weights array<double>, words array<bigint>, counts array<int>, label double"
    )
    made = made.checkpoint()
    # Both indexes are made of the bounded sample: the vectors of at most ``rows`` documents, as arrays.
    examples = made.toArrow().combine_chunks()
    keys = list(zip(map(tuple, examples["at"].to_pylist()), map(tuple, examples["weights"].to_pylist()), strict=True))
    told = examples["label"].to_numpy()
    index = BlockIndex.build(keys, told.tolist(), len(terms))
    near = _near_votes(examples, told, [k[0] for k in keys])
    del examples

    # Made of the bounded sample; fitting the curve and scoring share one copy per executor.
    telling = Vectors(terms, idf, near.index.telling_words())
    shared = docs.sparkSession.sparkContext.broadcast((telling, index, near))

    def left_out(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        _, index, near = shared.value
        for part in batches:
            raw = []
            for at, ws, found, times, y in zip(*[part[c] for c in ("at", "weights", "words", "counts", "label")], strict=True):
                vector = (tuple(int(t) for t in at), tuple(float(w) for w in ws))
                copies = near.vote(vector[0], np.asarray(found, np.int64), np.asarray(times), without=y)
                raw.append(max(index.vote(vector, without=y)[0], copies))
            yield pd.DataFrame({"raw": raw, "label": part["label"]})

    curve = (np.array([]), np.array([]))
    if n1 and n0:
        curve = isotonic(made.mapInPandas(left_out, "raw double, label double"))
    return ToxicityModel(vectors, index, curve, n1 / max(1, n1 + n0), shared)


SCORED = "doc_id long, held_out boolean, score double, predicted int, evidence string"


def toxicity_scores(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """doc_id, held_out, score, predicted and evidence for every row of ``docs``.

    Evidence lists the nearest entries as similarity:share of toxic votes, near
    copies over all words first.
    Only the text is looked at. Null and empty texts have no vector and get
    the share of the label in the sample; repeated rows give repeated results;
    other columns are ignored; a null id is in no held-out fold.
    """

    shared, curve, prior = model.shared, model.curve, model.prior

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vectors, index, copies_of = shared.value
        known: dict = {}
        for b in batches:
            ids = b.column("doc_id")
            raw, evidence = [], []
            for text in b.column("text").cast(pa.binary()).to_pylist():
                vector, words, counts = vectors.whole(text or b"", always=False)
                if vector not in known:
                    if len(known) >= REMEMBERED:
                        known.clear()
                    known[vector] = index.vote(vector)
                score, near = known[vector]
                copies = copies_of.vote(vector[0], words, counts)
                raw.append(max(score, copies))
                told = [f"copy:{copies:.4f}"] if copies else []
                evidence.append(" ".join([*told, *(f"{s:.4f}:{p:.3f}" for _, s, p in near)]))
            score = np.array(raw, np.float64)
            if len(curve[0]):
                score = calibrated(score, curve)
            score = np.where([e == "" for e in evidence], prior, score)
            held = [i is not None and fold_of_value(i, FOLDS) == HELD for i in ids.to_pylist()]
            columns = [ids, pa.array(held, pa.bool_()), pa.array(score), pa.array((score >= CUT).astype(np.int32))]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(evidence)], [f.split()[0] for f in SCORED.split(", ")])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, SCORED)
