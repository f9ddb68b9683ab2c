"""What the trees of near duplicates and the dictionary of pieces cost as their input grows."""

import pickle
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest

from stratacast.llm import near_duplicates as nd
from stratacast.llm.pieces import SPACE, PieceModel, _encoded, piece_table, segment_dictionary
from stratacast.llm.queries import tokenizer_file
from stratacast.session import ensure_checkpoint_dir


@pytest.fixture(scope="module")
def model():
    return PieceModel.read(tokenizer_file("piece_bpe_32k.model"))


def test_nodes_grow_with_the_classes(spark, monkeypatch):
    """Unlike texts that share one shingle: each step makes at most as many rows for a class as on a fifth of them."""
    ensure_checkpoint_dir(spark)
    real, made = nd._sized, {}

    def nodes_of(n):
        docs = spark.createDataFrame(
            [(k, "to the " + " ".join(f"w{k}_{m}" for m in range(5))) for k in range(n)], "doc_id long, text string"
        )
        classes = nd.set_features(docs).selectExpr("doc_id AS class", "n_shingles AS n", "tokens").checkpoint()
        made[n] = []
        monkeypatch.setattr(nd, "_sized", lambda rows, node: made[n].append(rows.count()) or real(rows, node))
        nd.tree_leaves(classes).count()
        return made[n]

    few, many = nodes_of(300), nodes_of(1500)
    assert few[0] > 0
    assert all(m <= 5 * f for f, m in zip(few, many, strict=True)), (few, many)


def _dictionary_and_peak(spark, model, words):
    docs = spark.createDataFrame([(k, f"{w} {w} {w}") for k, w in enumerate(words)], "doc_id long, text string")
    tracemalloc.start()
    found = segment_dictionary(docs, model)
    sent = pickle.dumps(found)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    return pickle.loads(sent), peak


def test_dictionary_takes_no_objects_on_the_driver(spark, model):
    """A segment costs the driver some bytes of columns, not Python objects."""
    words = sorted({f"{a}{b}{c}" for a in ("be", "Ün", "漢", "zzq", "x1") for b in range(40) for c in ("er", "s", "", "ß")})
    words += [f"w{k}q" for k in range(20_000)]
    _, least = _dictionary_and_peak(spark, model, words[:1])
    known, peak = _dictionary_and_peak(spark, model, words)
    assert known == {s: np.asarray(model.fold(s), np.int32).tobytes() for w in words for s in [SPACE + w]}
    # What one segment takes is the table of pieces.
    assert peak - least < 100 * len(words), (least, peak)


def test_empty_dictionary(spark, model):
    docs = spark.createDataFrame([(1, "once"), (2, None)], "doc_id long, text string")
    assert pickle.loads(pickle.dumps(segment_dictionary(docs, model))) == {}


def test_workers_hold_little_of_a_batch_at_once(model):
    """A large batch is cut some texts at a time, so what a worker holds beside it does not grow with the batch."""
    texts = [" ".join(f"w{(n * k) % 500}" for k in range(1000)) for n in range(1600)]
    batch = pa.record_batch({"doc_id": pa.array(range(len(texts)), pa.int64()), "text": pa.array(texts)})
    peaks = []
    for rows in (400, 1600):
        tracemalloc.start()
        total = sum(sum(b.column("n_tokens").to_pylist()) for b in _encoded(iter([batch.slice(0, rows)]), {}, model))
        peaks.append(tracemalloc.get_traced_memory()[1])
        tracemalloc.stop()
        assert total == sum(len(model.fold(s)) for t in texts[:rows] for s in model.segments(t))
    assert peaks[1] < 1.5 * peaks[0], peaks


def test_piece_table_starts_no_python_workers(spark, model):
    table = piece_table(spark, model)
    assert "PythonRDD" not in table._jdf.queryExecution().toRdd().toDebugString()
    found = {r["piece"]: (r["id"], r["rank"], r["score"]) for r in table.collect()}
    assert found == {p: (k, rank, score) for p, (k, rank, score) in model.pieces.items()}
    assert table.count() == len(model.pieces)
    assert dict(table.dtypes) == {"piece": "string", "id": "int", "rank": "int", "score": "double"}
