"""SentencePiece encoding and decoding over a relational lattice.

A text is cut where no piece can cross. The distinct segments are exploded
into their bounded-length substrings, which are equi-joined to the piece
table; the joined edges are grouped by segment and folded into its pieces by
one higher-order ``aggregate``: Viterbi for unigram models, and for BPE models
the merges in order of score, because the best-scoring path is not what a BPE
model encodes. Frequent segments are encoded that way once for the corpus; the
few occurrences of all others are folded by the same rule beside the text.
"""

from __future__ import annotations

import re
import string
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import pairwise, repeat
from operator import add

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from sentencepiece import sentencepiece_model_pb2 as model_pb2

from stratacast.llm.token_files import ChunkEncoder, slices

SPACE = "▁"
BREAKS = "\n\t\r"
# Segments that the corpus-wide dictionary may hold, each of at most so many characters.
DICTIONARY_ROWS = 200_000
DICTIONARY_CHARS = 32
UNKNOWN_PENALTY = 10.0
# Up to this length the best neighbours are merged one after another; beyond it edges are sorted instead.
LONG = 64
# Bytes of text that a worker cuts at once; a chunk between blanks takes some ten times its length until it is looked up.
CUT_AT_ONCE = 1 << 20
# A vocabulary beyond this is not broadcast; pieces are short strings.
MAX_PIECES = 1_000_000
EDGES = "array<struct<rank:int,s:int,e:int,id:int,score:double>>"


@dataclass
class PieceModel:
    """The normal pieces with ids, scores and ranks (equal scores rank equally), and the byte pieces."""

    kind: str
    pieces: dict[str, tuple[int, int, float]]
    byte_ids: list[int]
    texts: list[bytes]
    longest: int
    least_score: float
    breaks: str
    odd: frozenset[str] = frozenset()
    ranks: dict[str, int] = field(default_factory=dict)
    # Characters that are neighbours in some piece; between any others no piece crosses.
    neighbours: frozenset[str] = frozenset()

    @classmethod
    def read(cls, content: bytes) -> PieceModel:
        """From a model file's content: byte fallback, a dummy prefix and no normalisation are required."""
        proto = model_pb2.ModelProto()
        proto.ParseFromString(content)
        kind = {1: "unigram", 2: "bpe"}.get(proto.trainer_spec.model_type)
        spec = proto.normalizer_spec
        if kind is None or not proto.trainer_spec.byte_fallback:
            raise ValueError("a unigram or BPE model with byte fallback is needed")
        if spec.precompiled_charsmap or spec.remove_extra_whitespaces or not spec.add_dummy_prefix:
            raise ValueError("a model with a dummy prefix and identity normalisation is needed")
        normal = [(p.piece, k, p.score) for k, p in enumerate(proto.pieces) if p.type == p.NORMAL]
        if len(normal) > MAX_PIECES:
            raise ValueError(f"more than {MAX_PIECES} pieces")
        if any(SPACE in p.lstrip(SPACE) for p, _, _ in normal):
            raise ValueError("pieces that cross from text into a blank are not supported")
        ranks = {s: r for r, s in enumerate(sorted({s for _, _, s in normal}, reverse=True))}
        joined = {c for p, _, _ in normal if len(p) > 1 for c in p}
        texts = [b""] * len(proto.pieces)
        byte_ids = [0] * 256
        for k, p in enumerate(proto.pieces):
            if p.type == p.BYTE:
                byte_ids[int(p.piece[3:5], 16)] = k
                texts[k] = bytes([int(p.piece[3:5], 16)])
            elif p.type == p.NORMAL:
                texts[k] = p.piece.replace(SPACE, " ").encode()
        model = cls(
            kind,
            {p: (k, ranks[s], s) for p, k, s in normal},
            byte_ids,
            texts,
            max(len(p) for p, _, _ in normal),
            min(s for _, _, s in normal),
            "".join(c for c in BREAKS if c not in joined),
        )
        model.neighbours = frozenset(x + y for p in model.pieces for x, y in pairwise(p))
        if kind == "bpe":
            model.ranks = {p: rank for p, (_, rank, _) in model.pieces.items()}
            model.odd = frozenset(p for p, (k, _, _) in model.pieces.items() if model._merged_by_edges(p) != [k])
        return model

    # One pass over the edges by rank merges what a queue would: a merge offers no better one, provided that every
    # piece comes out of its own text whole. ``odd`` holds the pieces that do not (runs of blanks with equal scores);
    # segments with such a piece start again at the best edge after every merge.

    def _fallback(self, c: str) -> list[int]:
        return [self.byte_ids[b] for b in c.encode("utf-8", "replace")]

    def segments(self, text: str) -> list[str]:
        """The text, marked and cut where no piece crosses; an empty text has none."""
        if not text:
            return []
        pattern = rf"{SPACE}*[^{SPACE}{self.breaks}]+|{SPACE}+" + (f"|[{self.breaks}]" if self.breaks else "")
        return re.findall(pattern, SPACE + text.replace(" ", SPACE))

    def fold(self, segment: str) -> list[int]:
        """The ids of one segment, by merges or by the best path."""
        return self._merged(segment) if self.kind == "bpe" else self._best_path(segment)

    def _merged(self, segment: str) -> list[int]:
        if len(segment) > LONG:
            return self._merged_by_edges(segment)
        known, rank, none = self.pieces, self.ranks.get, len(self.pieces)
        if segment in known and segment not in self.odd:
            return [known[segment][0]]
        parts = list(segment)
        ranks = list(map(rank, map(add, segment, segment[1:]), repeat(none)))
        while ranks and (least := min(ranks)) < none:
            k = ranks.index(least)
            del ranks[k]
            merged = parts[k] = parts[k] + parts.pop(k + 1)
            if k < len(ranks):
                ranks[k] = rank(merged + parts[k + 1], none)
            if k:
                ranks[k - 1] = rank(parts[k - 1] + merged, none)
        out = []
        for part in parts:
            hit = known.get(part)
            out += [hit[0]] if hit else self._fallback(part)
        return out

    def _merged_by_edges(self, segment: str) -> list[int]:
        """The same for segments of any length: all edges by rank, so time grows in proportion."""
        n, known, edges = len(segment), self.pieces, []
        for s in range(n - 1):
            for e in range(s + 2, min(n, s + self.longest) + 1):
                if (hit := known.get(segment[s:e])) is not None:
                    edges.append((hit[1], s, e))
        edges.sort()
        follow = list(range(1, n + 1))
        again = bool(self.odd) and any(segment[s:e] in self.odd for _, s, e in edges)
        k = 0
        while k < len(edges):
            _, s, e = edges[k]
            middle = follow[s]
            k += 1
            # An edge merges when both its ends are cuts and one cut lies between.
            if 0 < middle < e and follow[middle] == e:
                follow[s], follow[middle] = e, 0
                if again:
                    k = 0
        out, s = [], 0
        while s < n:
            hit = known.get(segment[s : follow[s]])
            out += [hit[0]] if hit else self._fallback(segment[s])
            s = follow[s]
        return out

    def _best_path(self, segment: str) -> list[int]:
        n, known = len(segment), self.pieces
        best: list[tuple[float, int]] = [(0.0, 0)] + [(-np.inf, 0)] * n
        for e in range(1, n + 1):
            for s in range(max(0, e - self.longest), e):
                hit = known.get(segment[s:e])
                score = hit[2] if hit else self.least_score - UNKNOWN_PENALTY if e == s + 1 else -np.inf
                if best[s][0] + score > best[e][0]:
                    best[e] = (best[s][0] + score, s)
        cuts, e = [], n
        while e:
            cuts.append((best[e][1], e))
            e = best[e][1]
        out = []
        for s, e in reversed(cuts):
            hit = known.get(segment[s:e])
            out += [hit[0]] if hit else self._fallback(segment[s])
        return out

    def decode(self, ids: np.ndarray) -> str:
        raw = b"".join([self.texts[i] for i in ids])
        return raw[1:].decode("utf-8", "replace") if raw[:1] == b" " else raw.decode("utf-8", "replace")


def segment_column(text: Column, model: PieceModel) -> Column:
    """The segments of a text as an array; the same cuts as ``PieceModel.segments``."""
    marked = F.concat(F.lit(SPACE), F.replace(text, F.lit(" "), F.lit(SPACE)))
    cuts = rf"(?<=[^{SPACE}])(?={SPACE})"
    if model.breaks:
        cuts += rf"|(?<=[{model.breaks}])|(?=[{model.breaks}])"
    return F.when(text != "", F.array_remove(F.split(marked, cuts), "")).otherwise(F.array().cast("array<string>"))


def piece_table(spark: SparkSession, model: PieceModel) -> DataFrame:
    """(piece, id, rank, score), handed over as Arrow: pickled rows would start Python workers of another kind.

    Those would stay on the executors beside the workers of this subpackage.
    """
    ids, ranks, scores = zip(*model.pieces.values(), strict=True)
    columns = [pa.array(list(model.pieces), pa.string()), pa.array(ids, pa.int32()), pa.array(ranks, pa.int32()), pa.array(scores, pa.float64())]
    return spark.createDataFrame(pa.table(columns, names=["piece", "id", "rank", "score"]))


def encode_segments(segments: DataFrame, model: PieceModel) -> DataFrame:
    """(segment, ids) for distinct segments without odd pieces, by the lattice."""
    n = F.char_length("segment")
    substrings = F.flatten(
        F.transform(
            F.sequence(F.lit(0), n - 1),
            lambda s: F.transform(
                F.sequence(F.lit(1), F.least(F.lit(model.longest), n - s)),
                lambda k: F.struct(s.alias("s"), (s + k).alias("e"), F.substring("segment", s + 1, k).alias("piece")),
            ),
        )
    )
    edges = (
        segments.select("segment", F.explode(substrings).alias("_x"))
        .select("segment", "_x.*")
        .join(F.broadcast(piece_table(segments.sparkSession, model)), "piece")
        .groupBy("segment")
        .agg(F.collect_list(F.struct("rank", "s", "e", "id", "score")).cast(EDGES).alias("_edges"))
    )
    # Segments of unknown characters only have no edge.
    joined = segments.join(edges, "segment", "left").withColumn("_edges", F.coalesce("_edges", F.array().cast(EDGES)))
    cuts = _merge_cuts(model) if model.kind == "bpe" else _viterbi_cuts(model)
    joined = joined.withColumn("_cuts", cuts)
    base = model.byte_ids[0]
    if model.byte_ids != list(range(base, base + 256)):
        raise ValueError("byte pieces must be in a row")

    def ids(cut: Column) -> Column:
        hit = F.filter("_edges", lambda x: (x["s"] == cut["s"]) & (x["e"] == cut["e"]))
        code = F.hex(F.encode(F.substring("segment", cut["s"] + 1, F.lit(1)), "UTF-8"))
        octets = F.transform(
            F.sequence(F.lit(0), (F.length(code) / 2).cast("int") - 1),
            lambda k: F.conv(F.substring(code, 2 * k + 1, F.lit(2)), 16, 10).cast("int") + base,
        )
        return F.when(F.size(hit) > 0, F.transform(hit, lambda x: x["id"])).otherwise(octets)

    return joined.select("segment", F.flatten(F.transform("_cuts", ids)).alias("ids"))


def _pairs(points: Column) -> Column:
    """Neighbouring points of a sorted array as (s, e)."""
    return F.transform(
        F.slice(points, 1, F.greatest(F.size(points) - 1, F.lit(0))),
        lambda p, i: F.struct(p.alias("s"), F.get(points, i + 1).alias("e")),
    )


def _merge_cuts(model: PieceModel) -> Column:
    """Edges in order of rank, then place: each merges if exactly one cut lies strictly inside it."""
    n = F.char_length("segment")
    ordered = F.sort_array(F.filter("_edges", lambda x: x["e"] - x["s"] > 1))

    def step(cuts: Column, x: Column) -> Column:
        inside = F.size(F.filter(cuts, lambda c: (c > x["s"]) & (c < x["e"])))
        fits = F.array_contains(cuts, x["s"]) & F.array_contains(cuts, x["e"]) & (inside == 1)
        return F.when(fits, F.filter(cuts, lambda c: (c <= x["s"]) | (c >= x["e"]))).otherwise(cuts)

    return F.aggregate(ordered, F.sequence(F.lit(0), n), step, _pairs)


def _viterbi_cuts(model: PieceModel) -> Column:
    """The best path to every position in turn; unknown characters are edges of their own."""
    n = F.char_length("segment")
    single = F.transform(F.filter("_edges", lambda x: x["e"] - x["s"] == 1), lambda x: x["s"])
    unknown = F.transform(
        F.array_except(F.sequence(F.lit(0), n - 1), single),
        lambda s: F.struct((s + 1).alias("e"), s.alias("s"), F.lit(model.least_score - UNKNOWN_PENALTY).alias("score")),
    )
    known = F.transform("_edges", lambda x: F.struct(x["e"].alias("e"), x["s"].alias("s"), x["score"].alias("score")))
    kind = "array<struct<score:double,s:int>>"
    start = F.array_repeat(F.struct(F.lit(0.0).alias("score"), F.lit(-1).alias("s")), 1).cast(kind)

    def step(best: Column, x: Column) -> Column:
        offered = F.struct((F.get(best, x["s"])["score"] + x["score"]).alias("score"), x["s"].alias("s"))
        grown = F.concat(best, F.array(offered))
        better = F.concat(F.slice(best, 1, F.size(best) - 1), F.array(offered))
        return (
            F.when(F.size(best) == x["e"], grown)
            .when(offered["score"] > F.get(best, x["e"])["score"], better)
            .otherwise(best)
            .cast(kind)
        )

    # Sorted by end, then start: a position is complete before an edge leaves it.
    best = F.aggregate(F.sort_array(F.concat(known, unknown)), start, step)

    # The table of best paths is bound once, as the argument of a lambda.
    return F.get(F.transform(F.array(best), lambda b: _walk(b, n)), 0)


def _walk(best: Column, n: Column) -> Column:
    def back(points: Column, _: Column) -> Column:
        at = F.get(points, 0)
        return F.when(at > 0, F.concat(F.array(F.get(best, at)["s"]), points)).otherwise(points)

    return F.aggregate(F.sequence(F.lit(1), n), F.array(n), back, _pairs)


@dataclass
class SegmentDictionary:
    """Segments with their ids as columns (segment, ids); its pickled form is read as a dictionary.

    So the driver, which only passes it on, holds no object for each segment.
    """

    table: pa.Table

    def __reduce__(self) -> tuple:
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, self.table.schema) as stream:
            stream.write_table(self.table)
        return _known_segments, (sink.getvalue().to_pybytes(),)


def _known_segments(content: bytes) -> dict[str, bytes]:
    """Segments with their ids as 32-bit integers in bytes."""
    known: dict[str, bytes] = {}
    for b in pa.ipc.open_stream(content):
        lists = b.column("ids")
        raw, bounds = lists.values.to_numpy().tobytes(), (4 * lists.offsets.to_numpy().astype(np.int64)).tolist()
        known.update(zip(b.column("segment").to_pylist(), [raw[s:e] for s, e in pairwise(bounds)], strict=True))
    return known


def segment_dictionary(docs: DataFrame, model: PieceModel, rows: int = DICTIONARY_ROWS) -> SegmentDictionary:
    """The most frequent segments of all documents with their ids; at most ``rows`` short ones."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    has_odd = F.lit(False)
    for piece in sorted(model.odd):
        has_odd = has_odd | F.contains("segment", F.lit(piece))
    counted = (
        docs.select(F.explode(segment_column(text, model)).alias("segment"))
        .where(F.char_length("segment") <= DICTIONARY_CHARS)
        .where(~has_odd)
        .groupBy("segment")
        .agg(F.count(F.lit(1)).alias("_n"))
        .where("_n > 1")
    )
    frequent = counted.orderBy(F.desc("_n"), "segment").limit(rows).select("segment")
    return SegmentDictionary(encode_segments(frequent.repartition("segment"), model).toArrow())


TOKENS = "doc_id long, n_tokens long, tokens array<int>"


class SegmentEncoder(ChunkEncoder):
    """Maps the runs between single blanks to ids at once; each distinct run is folded once.

    A run and the blank before it are whole segments, since pieces do not
    cross into a blank. Texts with blanks in a row, at an end, or with the
    mark itself are cut segment by segment instead; those keys are tuples.
    """

    remembered = 200_000

    def __init__(self, model: PieceModel, known: dict[str, bytes]) -> None:
        self.model, self.known = model, known
        self._start([])

    def _split(self, text: str) -> list:
        if not text:
            return []
        runs = text.split(" ")
        if SPACE in text or "" in runs:
            return [(s,) for s in self.model.segments(text)]
        neighbours, closing, chunks = self.model.neighbours, string.punctuation, []
        for run in runs:
            # Where no piece crosses from a word into the punctuation behind it, both are remembered by themselves.
            if run[-1] in closing and (cut := len(run.rstrip(closing))) and run[cut - 1 : cut + 1] not in neighbours:
                chunks.append(run[:cut])
                chunks.append((run[cut:],))
            else:
                chunks.append(run)
        return chunks

    def _ids(self, key: str | tuple[str]) -> list[int]:
        out: list[int] = []
        for s in key if isinstance(key, tuple) else self.model.segments(key):
            found = self.known.get(s)
            out += self.model.fold(s) if found is None else memoryview(found).cast("i")
        return out

    def _marked(self, chunk: str | tuple[str]) -> bool:
        return False

    def _ids_of(self, chunks: list) -> tuple[np.ndarray, np.ndarray]:
        found = [self._ids(c) for c in chunks]
        lengths = np.fromiter(map(len, found), np.int64, len(found))
        return lengths, np.fromiter((i for ids in found for i in ids), np.int32, int(lengths.sum()))


def _encoded(batches: Iterator[pa.RecordBatch], known: dict, model: PieceModel) -> Iterator[pa.RecordBatch]:
    """The batch's own columns, the number of ids and the ids; a few texts at a time."""
    encoder = SegmentEncoder(model, known)
    for b in batches:
        for part in slices(b, CUT_AT_ONCE):
            ids, counts = encoder.encode([t or "" for t in part.column("text").to_pylist()])
            offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(ids, pa.int32()))
            columns = [*part.columns, pa.array(counts, pa.int64()), lists]
            yield pa.RecordBatch.from_arrays(columns, [*part.schema.names, "n_tokens", "tokens"])
    # The worker lives on: what the lists took goes back to the system.
    pa.default_memory_pool().release_unused()


def encode_texts(docs: DataFrame, model: PieceModel, rows: int = DICTIONARY_ROWS) -> DataFrame:
    """doc_id, number of ids and the ids of every row of ``docs``.

    Null and empty texts have no ids. Repeated rows give repeated results,
    other columns are ignored, an empty table gives no rows. Long texts and
    long runs without a blank are encoded whole.
    """
    shared = docs.sparkSession.sparkContext.broadcast(segment_dictionary(docs, model, rows))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in _encoded(batches, shared.value, model):
            yield b.select(["doc_id", "n_tokens", "tokens"])

    rows_of = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows_of.mapInArrow(run, TOKENS)


def round_trip(docs: DataFrame, model: PieceModel, rows: int = DICTIONARY_ROWS) -> DataFrame:
    """doc_id, n_tokens, ids_crc32 (ids as little-endian 32-bit) and whether decoding gives the text again.

    Texts that hold the mark of a blank itself come back with blanks; null
    counts as empty.
    """
    shared = docs.sparkSession.sparkContext.broadcast(segment_dictionary(docs, model, rows))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in _encoded(batches, shared.value, model):
            sums, same = [], []
            lists = b.column("tokens")
            bounds, ids = lists.offsets.to_numpy(), lists.values.to_numpy().astype("<u4")
            for text, s, e in zip(b.column("text").to_pylist(), bounds[:-1], bounds[1:], strict=True):
                sums.append(zlib.crc32(ids[s:e].tobytes()))
                same.append(model.decode(ids[s:e].tolist()) == (text or ""))
            columns = [b.column("doc_id"), b.column("n_tokens"), pa.array(sums, pa.int64()), pa.array(same, pa.bool_())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_tokens", "ids_crc32", "round_trip"])

    rows_of = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows_of.mapInArrow(run, "doc_id long, n_tokens long, ids_crc32 long, round_trip boolean")


def decode_tokens(encoded: DataFrame, model: PieceModel) -> DataFrame:
    """doc_id, text, number of ids and their checksum; null lists give empty texts.

    The marks of blanks become blanks, so a text that holds the mark itself
    comes back with blanks in its place.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, 500):
                part = b.slice(at, 500)
                texts, sums, counts = [], [], []
                for ids in part.column("tokens"):
                    values = ids.values.to_numpy().astype("<u4") if ids.is_valid else np.array([], "<u4")
                    texts.append(model.decode(values.tolist()))
                    sums.append(zlib.crc32(values.tobytes()))
                    counts.append(len(values))
                columns = [part.column("doc_id"), pa.array(texts, pa.string()), pa.array(counts, pa.int64()), pa.array(sums, pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "text", "n_tokens", "ids_crc32"])

    return encoded.select("doc_id", "tokens").mapInArrow(run, "doc_id long, text string, n_tokens long, ids_crc32 long")
