"""How far the sources of a language differ in the terms they use.

Every group, a source within a language, gives each kept term a share in
billionths with one count added. Two groups are compared by a task that holds
the sorted (term id, share) arrays of both and merges them: each id of the
shorter array is looked up in the longer one, and the terms of both, of one
side only and of neither are priced both ways. The terms of a language are
dealt into blocks, so an array has a bounded length whatever the vocabulary,
and the sums over blocks are added up by Spark. Pair tasks are tiled: a task
co-groups ``TILE`` groups with ``TILE`` others, so that an array travels once
per tile instead of once per partner.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stratacast.llm.common import whole_text
from stratacast.session import broadcast_if_small, ensure_checkpoint_dir

# Lower-cased bytes of UTF-8: ASCII letters and everything beyond ASCII.
TERM = re.compile(rb"[a-z\x80-\xff]+")
UNIT = 1_000_000_000
MIN_DOCS = 3
TOP_TERMS = 200
BLOCK_TERMS = 20_000
TILE = 8
# Different terms that a worker counts before it hands them on, and the text size from which terms are read one by one.
HELD_TERMS = 200_000
LARGE_TEXT = 4_000_000
PARTIAL = "lang string, source string, term string, n long, docs long"


def _terms(text: bytes) -> Counter[bytes]:
    text = text.lower()  # of bytes: A-Z only
    if len(text) > LARGE_TEXT:
        return Counter(m.group() for m in TERM.finditer(text))
    return Counter(TERM.findall(text))


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Occurrences and documents per language, source and term, combined before the shuffle."""
    groups: dict[tuple[str, str], tuple[Counter, Counter]] = defaultdict(lambda: (Counter(), Counter()))
    schema = pa.schema([("lang", pa.string()), ("source", pa.string()), ("term", pa.string()), ("n", pa.int64()), ("docs", pa.int64())])

    def handed_on() -> Iterator[pa.RecordBatch]:
        for (lang, source), (n, docs) in groups.items():
            size = len(n)
            if size:
                names = pa.array(n.keys(), pa.binary()).cast(pa.string())
                columns = [pa.repeat(lang, size), pa.repeat(source, size), names, pa.array(n.values(), pa.int64())]
                yield pa.RecordBatch.from_arrays([*columns, pa.array((docs[t] for t in n), pa.int64())], schema=schema)
        groups.clear()

    held = 0
    for batch in batches:
        rows = zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True)
        for lang, source, text in rows:
            found = _terms(text.as_buffer().to_pybytes())
            n, docs = groups[lang, source]
            held -= len(n)
            n.update(found)
            docs.update(found.keys())
            held += len(n)
            if held > HELD_TERMS:
                yield from handed_on()
                held = 0
    yield from handed_on()


def term_counts(docs: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """(lang, source, term, n, lang_n, first): the terms that ``min_docs`` documents of their language have.

    ``first`` marks one row per language and term. One exchange serves the
    counts of groups and those of the language.
    """
    read = docs.select("lang", "source", F.col("text").cast("binary").alias("text"))
    counts = (
        read.mapInArrow(_counted, PARTIAL)
        .repartition("lang", "term")
        .groupBy("lang", "source", "term")
        .agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    )
    term = Window.partitionBy("lang", "term")
    return (
        counts.withColumns(
            {
                "lang_n": F.sum("n").over(term),
                "_docs": F.sum("docs").over(term),
                "first": (F.min("source").over(term) == F.col("source")).cast("int"),
            }
        )
        .where(F.col("_docs") >= min_docs)
        .select("lang", "source", "term", "n", "lang_n", "first")
    )


def share(count: Column, total: Column, terms: Column) -> Column:
    """1 + floor(UNIT * (count + 1) / (total + terms)), in decimals, so exact for any count; 1 without terms."""
    wide = F.lit(UNIT).cast("decimal(10,0)") * (count + 1).cast("decimal(20,0)")
    return F.call_function("div", wide, F.greatest(total + terms, F.lit(1)).cast("decimal(20,0)")) + 1


def price(p: Column, q: Column) -> Column:
    """floor((p - q)^2 / q); shares stay below 2^31, so the square fits a long."""
    return F.call_function("div", (p - q) * (p - q), q)


def _merged(
    ids_a: np.ndarray, p_a: np.ndarray, zero_a: int, ids_b: np.ndarray, p_b: np.ndarray, zero_b: int, terms: int
) -> tuple[int, int]:
    """Sums of the prices of all terms of a block, from a to b and from b to a."""
    if len(ids_a) > len(ids_b):
        return _merged(ids_b, p_b, zero_b, ids_a, p_a, zero_a, terms)[::-1]
    # Sorted needles: each search goes on from the place of the one before.
    at = np.searchsorted(ids_b, ids_a)
    both = np.zeros(len(ids_a), dtype=bool)
    inside = at < len(ids_b)
    both[inside] = ids_b[at[inside]] == ids_a[inside]
    alone_b = np.ones(len(ids_b), dtype=bool)
    alone_b[at[both]] = False

    def both_ways(p: np.ndarray, q: np.ndarray | int) -> tuple[int, int]:
        square = (p - q) * (p - q)
        return int((square // q).sum()), int((square // p).sum())

    absent = terms - len(ids_a) - int(alone_b.sum())
    gap = (zero_a - zero_b) ** 2
    there, back = absent * (gap // zero_b), absent * (gap // zero_a)
    for f, g in (both_ways(p_a[both], p_b[at[both]]), both_ways(p_a[~both], zero_b), both_ways(p_b[alone_b], zero_a)[::-1]):
        there, back = there + f, back + g
    return there, back


def _pair_task(key: tuple, groups: pd.DataFrame) -> pd.DataFrame:
    """All pairs of a tile with a tile, each unordered pair once."""
    lang, _, low, high, tile = key
    none = np.empty(0, dtype=np.int64)
    rows = [
        (int(i), int(zero), int(terms), none if ids is None else np.asarray(ids, np.int64), none if ps is None else np.asarray(ps, np.int64))
        for i, zero, terms, ids, ps in groups.sort_values("i")[["i", "zero", "terms", "ids", "ps"]].itertuples(index=False)
    ]
    out = []
    for n, (i, zero_i, terms, ids_i, p_i) in enumerate(rows):
        for j, zero_j, _, ids_j, p_j in rows[n + 1 :]:
            if i // tile == low and j // tile == high:
                out.append((lang, i, j, *_merged(ids_i, p_i, zero_i, ids_j, p_j, zero_j, terms)))
    return pd.DataFrame(out, columns=["lang", "a", "b", "there", "back"])


def source_divergence(
    docs: DataFrame,
    *,
    min_docs: int = MIN_DOCS,
    top_terms: int = TOP_TERMS,
    block_terms: int = BLOCK_TERMS,
    tile: int = TILE,
) -> DataFrame:
    """Per group and other source of its language the divergence, and per group its most typical terms.

    ``docs`` has text, lang and source; null is empty, other columns are
    ignored whatever their names. Each row is a document: repeated rows count
    as often as they occur. Groups without terms are compared too; without a
    kept term in the language every value is 0. Ties are ranked by item in
    UTF-8 order. Very long texts are counted without a list of their terms.
    An empty table gives no rows.

    Columns: lang, source, part ("pair" or "term"), item, value, rank. The
    rank limit ``top_terms`` is that of the term report; pairs have all ranks.
    """
    ensure_checkpoint_dir(docs.sparkSession)
    docs = docs.select(*[whole_text(F.col(c)).alias(c) for c in ("lang", "source", "text")])
    kept = term_counts(docs, min_docs).checkpoint()
    sums = kept.groupBy("lang", "source").agg(F.sum("n").alias("_n"), F.sum("first").alias("_first"))
    lang = Window.partitionBy("lang")
    zero = F.lit(0).cast("long")
    # One row per group; the windows hold the groups of one language.
    groups = (
        docs.groupBy("lang", "source")
        .agg(F.count("*").alias("_rows"))
        .join(sums, ["lang", "source"], "left")
        .select(
            "lang",
            "source",
            (F.row_number().over(lang.orderBy("source")) - 1).alias("i"),
            F.coalesce("_n", zero).alias("n_group"),
            F.coalesce(F.sum("_n").over(lang), zero).alias("n_lang"),
            F.coalesce(F.sum("_first").over(lang), zero).alias("n_terms"),
            F.count("*").over(lang).alias("n_sources"),
        )
        .withColumn("blocks", F.greatest(F.lit(1), F.ceil(F.col("n_terms") / block_terms)).cast("int"))
        .checkpoint()
    )
    priced = kept.join(broadcast_if_small(groups), ["lang", "source"]).withColumns(
        {
            "p": share(F.col("n"), F.col("n_group"), F.col("n_terms")),
            "q": share(F.col("lang_n"), F.col("n_lang"), F.col("n_terms")),
            "block": F.pmod(F.xxhash64("term"), F.col("blocks")).cast("int"),
        }
    )
    by_value = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    typical = (
        priced.where("p > q")
        .select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), price(F.col("p"), F.col("q")).alias("value"))
        .withColumn("rank", F.row_number().over(by_value))
        .where(F.col("rank") <= top_terms)
    )

    # Ids count the terms of a block, so they are small and the same for all groups.
    place = Window.partitionBy("lang", "block").orderBy("term")
    numbered = priced.withColumn("id", F.dense_rank().over(place))
    arrays = (
        numbered.groupBy("lang", "block", "i")
        .agg(F.sort_array(F.collect_list(F.struct("id", "p"))).alias("_terms"), F.sum("first").alias("_first"))
        .select("lang", "block", "i", F.col("_terms.id").alias("ids"), F.col("_terms.p").alias("ps"), "_first")
    )
    block = Window.partitionBy("lang", "block")
    laid = (
        groups.select(
            "lang", "i", "n_sources", share(zero, F.col("n_group"), F.col("n_terms")).alias("zero"),
            F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"),
        )
        .join(arrays, ["lang", "block", "i"], "left")
        .withColumn("terms", F.coalesce(F.sum("_first").over(block), zero))
    )
    mine = F.floor(F.col("i") / tile).cast("int")
    others = F.sequence(F.lit(0), F.floor((F.col("n_sources") - 1) / tile).cast("int"))
    tasks = laid.withColumn("_other", F.explode(others)).select(
        "lang", "block", F.least(mine, F.col("_other")).alias("low"), F.greatest(mine, F.col("_other")).alias("high"),
        F.lit(tile).alias("tile"), "i", "zero", "terms", "ids", "ps",
    )
    merged = tasks.groupBy("lang", "block", "low", "high", "tile").applyInPandas(
        _pair_task, "lang string, a int, b int, there long, back long"
    )
    sums = merged.groupBy("lang", "a", "b").agg(F.sum("there").alias("there"), F.sum("back").alias("back"))
    ways = F.array(
        F.struct(F.col("a").alias("i"), F.col("b").alias("j"), F.col("there").alias("value")),
        F.struct(F.col("b").alias("i"), F.col("a").alias("j"), F.col("back").alias("value")),
    )
    names = groups.select("lang", "i", "source")
    pairs = (
        sums.select("lang", F.inline(ways))
        .join(names, ["lang", "i"])
        .join(names.select("lang", F.col("i").alias("j"), F.col("source").alias("item")), ["lang", "j"])
        .select("lang", "source", F.lit("pair").alias("part"), "item", "value")
        .withColumn("rank", F.row_number().over(by_value))
    )
    return pairs.unionByName(typical)
