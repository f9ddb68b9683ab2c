"""Near duplicates, pieces and the classifiers; the pipeline stage by stage."""

import zlib

import numpy as np
import pytest
import sentencepiece
from pyspark.sql import functions as F
from sentencepiece import sentencepiece_model_pb2 as model_pb2

import corpus_pipeline
from stratacast.llm import near_duplicates as nd
from stratacast.llm.common import fold_of_value
from stratacast.llm.pieces import PieceModel, decode_tokens, encode_segments, encode_texts, round_trip
from stratacast.llm.quality_model import accepted, fit_quality, quality_scores, text_stats
from stratacast.llm.queries import QUERIES, tokenizer_file
from stratacast.llm.toxicity import BlockIndex, fit_toxicity, toxicity_scores
from tests.llm import reference

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def bpe():
    content = tokenizer_file("piece_bpe_32k.model")
    return PieceModel.read(content), sentencepiece.SentencePieceProcessor(model_proto=content)


@pytest.fixture(scope="module")
def unigram():
    """The public pieces under another model type, with scores that have no ties in sums of few."""
    proto = model_pb2.ModelProto()
    proto.ParseFromString(tokenizer_file("piece_bpe_32k.model"))
    proto.trainer_spec.model_type = 1
    rng = np.random.default_rng(3)
    for p in proto.pieces:
        if p.type == p.NORMAL:
            p.score = float(-6 - 8 * rng.random())
    content = proto.SerializeToString()
    return PieceModel.read(content), sentencepiece.SentencePieceProcessor(model_proto=content)


def rows_of(df, *cols):
    return {r[0]: tuple(r)[1:] for r in df.select("doc_id", *cols).collect()}


def test_near_groups(small, small_docs):
    got = rows_of(nd.near_duplicates(small["documents"]), "n_shingles", "component_id", "kept")
    assert got == reference.near_groups(small_docs)


def test_near_groups_of_odd_texts(spark, odd_docs, odd_rows):
    got = rows_of(nd.near_duplicates(odd_docs.unionByName(odd_docs)), "n_shingles", "component_id", "kept")
    assert got == reference.near_groups([(r[0], r[1]) for r in odd_rows])
    assert nd.near_duplicates(odd_docs.limit(0)).count() == 0
    null_id = spark.createDataFrame([(None, "a b c"), (5, "a b c")], "doc_id long, text string")
    assert rows_of(nd.near_duplicates(null_id), "kept") == {5: (True,)}
    assert nd.deduplicated(null_id).count() == 2


def test_near_copies_that_fill_large_nodes(spark, monkeypatch):
    """A group far larger than a node, whose members are near the first text but often not near each other."""
    monkeypatch.setattr(nd, "NODE", 4)
    rng = np.random.default_rng(11)
    base = [f"w{k}" for k in range(120)]
    docs = [(0, " ".join(base))]
    for n in range(1, 90):
        words = list(base)
        for k in rng.choice(120, rng.integers(1, 9), replace=False):
            words[k] = f"x{n}_{k}"
        docs.append((n, " ".join(words)))
    docs += [(100 + n, " ".join(f"y{n}_{k}" for k in range(50))) for n in range(20)]
    got = rows_of(nd.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string")), "n_shingles", "component_id", "kept")
    assert got == reference.near_groups(docs)


def test_borderline_star_in_nodes_of_every_depth(spark):
    """Copies at similarity 0.802 to a text in their middle and to nothing else; their nodes stay large at every depth."""
    rng = np.random.default_rng(23)
    base = [f"w{k}" for k in range(201)]
    docs = [(150, " ".join(base))]
    for n in [n for n in range(400) if n != 150]:
        words = list(base)
        for k in 1 + 2 * rng.choice(99, 11, replace=False):
            words[k] = f"x{n}_{k}"
        docs.append((n, " ".join(words)))
    got = rows_of(nd.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string")), "component_id")
    assert sorted(d for d, v in got.items() if v != (0,)) == []


def test_components_of_a_long_chain(spark):
    links = spark.createDataFrame([(n, n + 1) for n in range(40)] + [(70, 60)], "a long, b long")
    got = {r["id"]: r["component"] for r in nd.components(links).collect()}
    assert got == {n: 0 for n in range(41)} | {60: 60, 70: 60}


def test_pieces_equal_the_library(small, small_docs, odd_docs, odd_rows, bpe):
    model, library = bpe
    for frame, rows in ((small["documents"], small_docs), (odd_docs, [(r[0], r[1]) for r in odd_rows])):
        got = rows_of(round_trip(frame, model), "n_tokens", "ids_crc32", "round_trip")
        for doc, text in rows:
            ids = library.encode(text or "")
            assert got[doc] == (len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()), True)
    back = rows_of(decode_tokens(encode_texts(odd_docs, model), model), "text")
    assert back == {r[0]: (r[1] or "",) for r in odd_rows}
    assert encode_texts(odd_docs.limit(0), model).count() == 0


@pytest.mark.parametrize("kind", ["bpe", "unigram"])
def test_lattice_fold_equals_the_library(spark, small_docs, bpe, unigram, kind):
    model, library = bpe if kind == "bpe" else unigram
    segments = sorted({s for _, t in small_docs[:25] for s in model.segments(t)} | {"▁日本😀x", "▁", "▁\x00"})
    found = encode_segments(spark.createDataFrame([(s,) for s in segments], "segment string"), model)
    for r in found.collect():
        assert r["ids"] == model.fold(r["segment"])
        if len(r["segment"]) > 1 and r["segment"].startswith("▁"):
            ids = library.encode(r["segment"][1:])
            # The same pieces in another order tie up to rounding, which the library settles by its own sums.
            assert r["ids"] == ids or kind == "unigram" and sorted(r["ids"]) == sorted(ids)


def test_runs_of_blanks(bpe):
    model, library = bpe
    for n in range(1, 70):
        text = "a" + " " * n + "b"
        assert [i for s in model.segments(text) for i in model.fold(s)] == library.encode(text)


def test_quality_of_held_out_rows(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    model = fit_quality(docs, labels)
    truth = {r["doc_id"]: r["quality"] for r in labels.collect()}
    got = rows_of(quality_scores(docs, model), "held_out", "score", "predicted")
    held = [(truth[d], v) for d, v in got.items() if v[0] and d in truth]
    assert all(0 <= v[1] <= 1 for v in got.values()) and len(got) == docs.count()
    assert np.mean([y == v[2] for y, v in held]) > 0.9
    kept = accepted(docs, model)
    assert kept.columns == docs.columns
    assert {r["doc_id"] for r in kept.select("doc_id").collect()} == {d for d, v in got.items() if v[2]}


def test_toxicity_of_held_out_rows(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    got = rows_of(toxicity_scores(docs, fit_toxicity(docs, labels)), "held_out", "score", "predicted")
    truth = {r["doc_id"]: r["toxic"] for r in labels.collect()}
    held = [(truth[d], v[2]) for d, v in got.items() if v[0] and d in truth]
    assert np.mean([y == p for y, p in held]) > 0.9
    assert sum(p for y, p in held if not y) <= 2


def test_models_ignore_held_out_labels(small, odd_docs):
    flipped = small["labels"].withColumn(
        "quality", F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, 1 - F.col("quality")).otherwise(F.col("quality"))
    )
    a, b = (rows_of(quality_scores(odd_docs, fit_quality(small["documents"], x)), "score") for x in (small["labels"], flipped))
    assert a == b


def test_models_without_labels(small, odd_docs, odd_rows):
    none = small["labels"].limit(0)
    quality = rows_of(quality_scores(odd_docs, fit_quality(small["documents"], none)), "held_out", "score")
    toxic = rows_of(toxicity_scores(odd_docs, fit_toxicity(small["documents"], none)), "held_out", "score", "predicted")
    assert {v[1] for v in quality.values()} == {0.5} and {v[1:] for v in toxic.values()} == {(0.0, 0)}
    assert all(quality[r[0]][0] == (fold_of_value(r[0], 5) == 0) for r in odd_rows)
    assert quality_scores(odd_docs.limit(0), fit_quality(small["documents"], none)).count() == 0


def test_stats_of_odd_texts(odd_rows):
    for r in odd_rows:
        assert np.isfinite(text_stats((r[1] or "").encode())).all()


def test_block_index_is_exact():
    rng = np.random.default_rng(2)

    def vector():
        terms = np.sort(rng.choice(40, rng.integers(1, 6), replace=False))
        w = rng.random(len(terms))
        return tuple(terms.tolist()), tuple(np.round(w / np.sqrt((w**2).sum()), 6).tolist())

    examples = [vector() for _ in range(700)]
    index = BlockIndex.build(examples, [float(n % 3 == 0) for n in range(700)], 40)
    order = sorted(set(examples))
    for _ in range(50):
        q = vector()
        at, sims = index.nearest(q, 10)
        dense = [sum(dict(zip(*q, strict=True)).get(t, 0.0) * w for t, w in zip(*v, strict=True)) for v in order]
        assert np.allclose(np.sort(dense)[::-1][:10], sims)
        assert np.allclose([dense[k] for k in at], sims)


def test_pipeline_stage_by_stage(spark, small, small_docs):
    docs = small["documents"]
    model = fit_quality(docs, small["labels"])
    good = {d for d, v in rows_of(quality_scores(docs, model), "predicted").items() if v[0]}
    texts = {d: t for d, t in small_docs if d in good}
    groups = reference.near_groups(list(texts.items()))
    texts = {d: t for d, t in texts.items() if groups[d][2]}
    found = reference.contamination(list(texts.items()), [(r[0], r[1]) for r in small["benchmark"].collect()])
    texts = {d: t for d, t in texts.items() if not found[d][4]}
    assert len(texts) < len(groups) < len(small_docs)

    frame, columns = docs, docs.columns
    for name, stage in corpus_pipeline.STAGES[:4]:
        frame = stage(spark, frame, FOLDER)
        assert frame.columns == columns, name
    clean = rows_of(frame, "text")
    assert clean.keys() == texts.keys()
    assert all(t == texts[d] or "[" in t for d, (t,) in clean.items())
    result = rows_of(corpus_pipeline.run(spark, FOLDER), "tokens")
    library = sentencepiece.SentencePieceProcessor(model_proto=tokenizer_file(corpus_pipeline.MODEL_FILE))
    assert result == {d: (library.encode(t),) for d, (t,) in clean.items()}


def test_every_operator_has_one_query():
    numbers = sorted(int(name[2:].split("_")[0]) for name in QUERIES)
    assert numbers == list(range(1, 11))
