"""Neighbours over all words against dense cosines; votes of near copies; clashing column names."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from stratacast.llm.common import fold_of_value
from stratacast.llm.decontaminate import decontaminated
from stratacast.llm.near_duplicates import deduplicated
from stratacast.llm.near_examples import ExampleIndex, word_hash
from stratacast.llm.pii import redacted
from stratacast.llm.quality_model import fit_quality, quality_scores
from stratacast.llm.toxicity import FOLDS, HELD, fit_toxicity, toxicity_scores


def counted(rng, n_words, size):
    words, counts = np.unique(np.minimum(rng.zipf(1.3, size), n_words) if size else np.zeros(0, int), return_counts=True)
    hashes = np.array([word_hash(f"w{w}") for w in words], np.int64)
    order = np.argsort(hashes)
    return hashes[order], counts[order]


@pytest.mark.parametrize("bound", [0.3, 0.8, 0.95])
def test_neighbours_equal_dense_cosines(bound):
    rng = np.random.default_rng(5)
    texts = [counted(rng, 300, int(rng.integers(0, 80))) for _ in range(150)]
    texts += texts[:20]
    index = ExampleIndex.build(np.array([len(h) for h, _ in texts]), *(np.concatenate([t[k] for t in texts]) for k in (0, 1)))
    queries = [*texts[:60], *[counted(rng, 400, 60) for _ in range(60)], (np.zeros(0, np.int64), np.zeros(0, int))]
    n, df = len(texts), {}
    for h, _ in texts:
        for w in h.tolist():
            df[w] = df.get(w, 0) + 1

    def vector(text):
        v = {w: (1 + np.log(c)) * (1 + np.log((n + 1) / (df.get(w, 0) + 1))) for w, c in zip(*map(list, text), strict=True)}
        norm = np.sqrt(sum(x * x for x in v.values()))
        return {w: x / norm for w, x in v.items()}

    dense, found = [vector(t) for t in texts], 0
    kept = np.arange(0, 150, 3, dtype=np.int32)
    part = index.restricted(kept)
    for query in queries:
        q = vector(query)
        sims = np.array([sum(x * e.get(w, 0.0) for w, x in q.items()) for e in dense])
        at, near = index.near(*query, bound)
        clear = np.abs(sims - bound) > 1e-6
        assert set(at[clear[at]].tolist()) == set(np.flatnonzero((sims >= bound) & clear).tolist())
        assert near == pytest.approx(sims[at], abs=1e-9)
        found += len(at)
        # An index of some examples finds those of them, numbered anew.
        some, sims_of_some = part.near(*query, bound)
        inside = np.isin(at, kept)
        assert set(kept[some].tolist()) >= set(at[inside & clear[at]].tolist()) and set(kept[some].tolist()) <= set(at.tolist()) | set(np.flatnonzero(~clear).tolist())
        assert sims_of_some == pytest.approx(sims[kept[some]], abs=1e-6)
    assert found > 60


def test_a_copy_of_a_toxic_example_without_any_chosen_term_is_toxic(spark):
    """Junk texts labelled toxic share no words, so no term is chosen for them; their copies are found all the same."""
    rng = np.random.default_rng(8)
    junk = lambda k: " ".join(f"q{k}x{i}" for i in range(40))
    clean = lambda: " ".join(rng.choice([f"c{i}" for i in range(500)], 60))
    held = [i for i in range(2_000) if fold_of_value(i, FOLDS) == HELD]
    learnt = [i for i in range(2_000) if fold_of_value(i, FOLDS) != HELD]
    insult = "blorgface grumbalot snarkwit"
    docs, labels = [], []
    for n, i in enumerate(learnt[:600]):
        toxic = n % 4 == 0
        text = junk(n) if n % 8 == 0 else f"{clean()} {insult}" if toxic else clean()
        docs.append((i, text))
        labels.append((i, int(toxic)))
    copies = {held[n]: junk(8 * n) for n in range(20)}
    # The clean original of a toxic variant: near it, but without the insult.
    original = clean() + " " + clean()
    docs.append((learnt[700], f"{original} {insult}"))
    labels.append((learnt[700], 1))
    docs += [*copies.items(), (held[100], original), (held[101], clean()), (held[102], junk(999_999))]
    labels += [(i, 0) for i in held[:20]]  # labels of the held-out fold must not be read
    frame = spark.createDataFrame(docs, "doc_id long, text string").withColumn("label", F.lit("x"))
    model = fit_toxicity(frame, spark.createDataFrame(labels, "doc_id long, toxic int"))
    got = {r["doc_id"]: r for r in toxicity_scores(frame, model).collect()}
    assert all(got[i]["predicted"] == 1 and got[i]["evidence"].startswith("copy:1.0000") for i in copies)
    assert [got[held[k]]["predicted"] for k in (100, 101, 102)] == [0, 0, 0]


def test_columns_may_have_any_name(spark, small):
    docs = small["documents"].limit(60).selectExpr("*", "'l' AS label", "1 AS _gone_id", "2 AS gone_id", "3 AS _bad_id", "4 AS bad_id", "5 AS _pii", "6 AS _label_id")
    for out in (deduplicated(docs), decontaminated(docs, small["benchmark"]), redacted(docs)):
        assert out.columns == docs.columns and 0 < out.count() <= 60
    assert redacted(docs).select("_pii").distinct().collect() == [(5,)]
    assert quality_scores(docs, fit_quality(docs, small["labels"])).count() == 60
    assert toxicity_scores(docs, fit_toxicity(docs, small["labels"])).count() == 60


def test_rows_of_one_id_stay_or_go_together(spark):
    rows = [(1, "a b c d"), (1, "a b c d"), (2, "a b c d"), (2, "x y z"), (3, "other words here")]
    got = sorted(tuple(r) for r in deduplicated(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    assert [r[0] for r in got].count(1) == 2 and (3, "other words here") in got
