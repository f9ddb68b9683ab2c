"""Token ids as Parquet files that can be read selectively.

Documents are dealt out by ranges of their id and sorted, so every file holds
a range and page indexes over doc_id prune well. Token lists are dictionary
encoded, or delta packed where a dictionary does not pay; the numbers beside
them can be read without touching a token.
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from stratacast.session import scratch_path

END_ID = 2
# Chunks of text whose ids a worker remembers, some 200 bytes each.
REMEMBERED = 700_000
LEARNT_AT_ONCE = 500
# A piece of its own wherever it stands; put between chunks, it shows where each one's ids end.
MARK = b"0"
LAYOUT = {
    "compression": "zstd",
    "parquet.writer.version": "v2",
    "parquet.enable.dictionary": "true",
    "parquet.block.size": str(32 << 20),
    "parquet.page.size": str(256 << 10),
    "parquet.page.row.count.limit": "2000",
}
ENCODED = "doc_id long, start_in_file long, n_tokens int, tokens array<int>"
PER_DOC = "doc_id long, start_in_file long, n_tokens long, ids_crc32 long, file string"


_STOP = re.compile(rb"([.,])(?<=[a-z].)(?=[\x20\n])")


class ChunkEncoder:
    """Encodes each distinct run between white space once per worker.

    The tokenizer drops white space and no token spans it, so a text's ids are
    those of its runs in a row. Lower-casing A-Z first changes nothing, as the
    tokenizer lower-cases, and neither does a blank between a letter and a
    single full stop or comma, which are different pieces anyway; texts that
    hold a special token's mark are left as they are. Index 0 stands for the
    end of a document. When too much is remembered, what was met only once
    goes.
    """

    remembered = REMEMBERED

    def __init__(self, definition: str, end_id: int) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        self.tokenizer = Tokenizer.from_str(definition)
        self.mark = self.tokenizer.encode(MARK.decode(), add_special_tokens=False).ids
        self._start([end_id])

    def _start(self, end: list[int]) -> None:
        self.index: dict[bytes | None, int] = {None: 0}
        self.lengths = np.array([len(end)], np.int64)
        self.starts = np.array([0], np.int64)
        self.ids = np.array(end, np.int32)
        self.hits = np.zeros(1, np.int64)

    def _shrink(self) -> None:
        """Keep the chunks met most often, half of what may be remembered at most."""
        index, lengths, starts, ids, hits = self.index, self.lengths, self.starts, self.ids, self.hits
        kept = np.flatnonzero(hits > 1)
        most = self.remembered // 2
        if len(kept) > most:
            kept = np.sort(np.argpartition(-hits, most)[:most])
        kept = np.concatenate([[0], kept[kept > 0]])
        place = np.full(len(lengths), -1, np.int64)
        place[kept] = np.arange(len(kept))
        self.index = {c: n for c, k in index.items() if (n := int(place[k])) >= 0}
        self.lengths, self.hits = lengths[kept], hits[kept] // 2
        ends = np.cumsum(self.lengths)
        self.starts = ends - self.lengths
        self.ids = ids[np.arange(int(ends[-1])) + np.repeat(starts[kept] - self.starts, self.lengths)]

    def _learn(self, chunks: list) -> None:
        """Ids of chunks not met before, some at a time; chunks with the mark in them come last."""
        chunks.sort(key=self._marked)
        parts = [self._ids_of(chunks[at : at + LEARNT_AT_ONCE]) for at in range(0, len(chunks), LEARNT_AT_ONCE)]
        self._add(chunks, np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts]))

    def _marked(self, chunk: bytes) -> bool:
        return MARK in chunk

    def _ids_of(self, chunks: list) -> tuple[np.ndarray, np.ndarray]:
        """(number of ids of each chunk, all ids): encoded as one text with marks between the chunks.

        Where more marks come back than were put in, the chunks are encoded as
        a list of pieces, each by itself.
        """
        if len(self.mark) == 1:
            joined = (b" " + MARK + b" ").join(chunks).decode()
            flat = np.array(self.tokenizer.encode_batch_fast([joined], add_special_tokens=False)[0].ids, np.int32)
            marks = np.flatnonzero(flat == self.mark[0])
            if len(marks) == len(chunks) - 1:
                bounds = np.concatenate([[-1], marks, [len(flat)]])
                return np.diff(bounds) - 1, np.delete(flat, marks)
        found = self.tokenizer.encode([c.decode() for c in chunks], is_pretokenized=True, add_special_tokens=False)
        return np.bincount(np.array(found.word_ids, np.int64), minlength=len(chunks)), np.array(found.ids, np.int32)

    def _add(self, chunks: list, lengths: np.ndarray, flat: np.ndarray) -> None:
        self.index.update(zip(chunks, range(len(self.lengths), len(self.lengths) + len(chunks)), strict=True))
        self.starts = np.concatenate([self.starts, len(self.ids) + np.cumsum(lengths) - lengths])
        self.lengths = np.concatenate([self.lengths, lengths])
        self.ids = np.concatenate([self.ids, flat])
        self.hits = np.concatenate([self.hits, np.zeros(len(lengths), np.int64)])

    def _split(self, text: bytes) -> list:
        if b"<|" not in text:
            text = b" ".join(_STOP.split(text.lower()))
        return text.split()

    def encode(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts in a row, each with its end id; number of ids of each text)."""
        if len(self.index) > self.remembered:
            self._shrink()
        chunks: list[bytes | None] = []
        firsts = np.empty(len(texts), np.int64)
        for n, text in enumerate(texts):
            firsts[n] = len(chunks)
            chunks += self._split(text)
            chunks.append(None)
        get = self.index.get
        at = np.fromiter(map(get, chunks, repeat(-1)), np.int64, len(chunks))
        new = np.flatnonzero(at < 0)
        if len(new):
            self._learn(list(dict.fromkeys(chunks[k] for k in new.tolist())))
            at[new] = [get(chunks[k]) for k in new.tolist()]
        self.hits += np.bincount(at, minlength=len(self.lengths))
        lengths = self.lengths[at]
        ends = np.cumsum(lengths)
        place = np.arange(int(ends[-1])) + np.repeat(self.starts[at] - (ends - lengths), lengths)
        # Every text has its end as a chunk, so none is empty here.
        return self.ids[place], np.add.reduceat(lengths, firsts)


_ENCODERS: dict[int, ChunkEncoder] = {}


def encoder_for(definition: str, end_id: int) -> ChunkEncoder:
    """This worker's encoder; it lives as long as the worker."""
    key = hash((definition, end_id))
    if key not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[key] = ChunkEncoder(definition, end_id)
    return _ENCODERS[key]


def slices(batch: pa.RecordBatch, most: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Parts of a batch of about ``most`` bytes, one row at least."""
    step = max(1, int(batch.num_rows * most / max(batch.nbytes, 1)))
    for at in range(0, batch.num_rows, step):
        yield batch.slice(at, step)


def encode_documents(docs: DataFrame, tokenizer_json: str, end_id: int = END_ID) -> DataFrame:
    """doc_id, start within its partition, number of ids, ids; in ascending doc_id order.

    ``tokenizer_json`` is the definition itself, so executors need no file.
    A null text is empty and yields the end id alone. Null ids come first,
    rows that repeat an id follow each other by text. Other columns are
    ignored; an empty table gives no rows. Very long texts are encoded one at
    a time.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, at = encoder_for(tokenizer_json, end_id), 0
        for batch in batches:
            for part in slices(batch):
                ids, counts = encoder.encode(part.column("text").cast(pa.binary()).to_pylist())
                ends = np.cumsum(counts)
                offsets = np.concatenate([[0], ends]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"),
                        pa.array(at + ends - counts, pa.int64()),
                        pa.array(counts, pa.int32()),
                        pa.ListArray.from_arrays(pa.array(offsets), pa.array(ids, pa.int32())),
                    ],
                    names=["doc_id", "start_in_file", "n_tokens", "tokens"],
                )
                at += int(ends[-1])

    text = F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")
    ordered = (
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), text)
        .repartitionByRange("doc_id")
        .sortWithinPartitions("doc_id", "text")
    )
    return ordered.mapInArrow(run, ENCODED)


def write_token_files(docs: DataFrame, tokenizer_json: str, path: str, end_id: int = END_ID) -> None:
    """One task writes one file, so starts within the partition are starts within the file."""
    encoded = encode_documents(docs, tokenizer_json, end_id)
    encoded.write.options(**LAYOUT).option("maxRecordsPerFile", 0).mode("errorifexists").parquet(path)


def read_token_files(files: DataFrame) -> DataFrame:
    """doc_id, start in the whole corpus, number of ids and their checksum, from written files.

    Files are put in the order of their least id; their totals, one row a
    file, are summed up to give the place where each file starts.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("tokens")
            ids = lists.values.to_numpy(zero_copy_only=False).astype("<u4", copy=False)
            bounds = lists.offsets.to_numpy()
            sums = [zlib.crc32(ids[a:b]) for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("start_in_file"),
                    pa.array(np.diff(bounds), pa.int64()),
                    pa.array(sums, pa.int64()),
                    batch.column("file"),
                ],
                names=["doc_id", "start_in_file", "n_tokens", "ids_crc32", "file"],
            )

    name = F.col("_metadata.file_name").alias("file")
    # The numbers beside the lists are enough for totals: no token is read for them.
    totals = files.select(name, "doc_id", "n_tokens").groupBy("file").agg(
        F.min(F.coalesce("doc_id", F.lit(-(1 << 63)))).alias("least"), F.sum("n_tokens").alias("total")
    )
    before = Window.orderBy("least", "file").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("file", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("offset"))
    documents = files.select("doc_id", "start_in_file", "tokens", name).mapInArrow(run, PER_DOC)
    return documents.join(F.broadcast(offsets), "file").select(
        "doc_id", (F.col("offset") + F.col("start_in_file")).alias("start"), "n_tokens", "ids_crc32"
    )


def token_output(docs: DataFrame, tokenizer_json: str, end_id: int = END_ID, path: str | None = None) -> DataFrame:
    """Write the token files and return what is read back from them."""
    spark = docs.sparkSession
    path = path or scratch_path(spark, "tokens")
    write_token_files(docs, tokenizer_json, path, end_id)
    return read_token_files(spark.read.parquet(path))
