"""Benchmark decontamination by winnowed fingerprints.

A text's k-grams are hashed; of every ``window - k + 1`` consecutive k-grams
the least hash is kept. A run of ``window`` words that a document shares with
an item therefore keeps the same fingerprint on both sides, so joining the
fingerprints finds every such run. Each joined fingerprint is then extended to
the windows around it, which are compared word by word.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratacast.llm.common import broadcast_within, item_words
from stratacast.llm.grams import POSITION_BITS, count_mark, gram_hashes, marked, unpacked, with_word_hashes
from stratacast.session import ensure_checkpoint_dir

WINDOW = 13
K = 6
# Fingerprints and ids, at most 16 bytes a row.
BROADCAST_ROWS = 1_000_000
SPANS = "array<struct<start:int,end:int>>"


def _winnow(grams: str, width: int) -> Column:
    """The least packed hash of every ``width`` neighbouring grams, leftmost among equals."""
    count = F.size(grams) - (width - 1)
    least = F.transform(
        F.sequence(F.lit(0), count - 1), lambda i: F.least(*[F.get(grams, i + j) for j in range(width)])
    )
    return F.when(count > 0, F.array_distinct(least)).otherwise(F.array().cast("array<bigint>"))


def fingerprints(
    df: DataFrame, key: str, window: int, k: int, short: list[int], count: str | None = None
) -> DataFrame:
    """(key, _print, _at, _len): winnowed prints of long runs, every print of the short lengths.

    Texts under ``window`` words hold no winnowed print. ``count`` names a
    column whose value is added per row as the print of length 0.
    """
    hashed = with_word_hashes(df).withColumn("_grams", gram_hashes("_hashes", k))
    marks = [marked(_winnow("_grams", window - k + 1), window)]
    marks += [marked(gram_hashes("_hashes", n), n) for n in short]
    if count:
        marks.append(count_mark(F.col(count)))
    return unpacked(hashed, key, F.concat(*marks))


def contamination(
    docs: DataFrame, items: DataFrame, *, window: int = WINDOW, k: int = K, min_share: int = 20
) -> DataFrame:
    """Per document: words, words inside shared windows, items met, verdict.

    ``docs`` has doc_id and text, ``items`` item_id and text; other columns are
    ignored whatever their names. A null or wordless text has no words and is
    clean. An item of fewer than ``window`` words is one window of its own
    length; an item without words or without an id matches nothing. Rows that
    repeat an id yield one row: their hits are united and the longest text
    counts. Null ids form one document. Empty tables give no rows, or no hits.

    Columns: doc_id, n_words, n_hit, n_items, items_sha256, contaminated,
    hit_spans (word spans, end exclusive, from 0).
    """
    docs = docs.select("doc_id", "text")
    item_text = items.where(F.col("item_id").isNotNull()).select(
        F.col("item_id").cast("string").alias("_item"), item_words(F.col("text")).alias("_words")
    )
    item_text = item_text.withColumn("_n", F.size("_words")).where(F.col("_n") > 0)
    # At most window - 1 values, whatever the size of the benchmark.
    short = sorted(r[0] for r in item_text.where(F.col("_n") < window).select("_n").distinct().collect())

    item_prints = (
        fingerprints(item_text.where(F.col("_n") >= window), "_item", window, k, [])
        .unionByName(
            # A short item is one gram: itself.
            with_word_hashes(item_text.where(F.col("_n") < window)).select(
                "_item",
                # The hash of an array runs over its elements in turn, as that of the grams does.
                F.shiftright(F.xxhash64("_hashes", "_n"), POSITION_BITS).alias("_print"),
                F.lit(0).alias("_at"),
                F.col("_n").alias("_len"),
            )
        )
        .select("_print", "_len")
        .distinct()
    )
    doc_words = docs.select("doc_id", item_words(F.col("text")).alias("_words")).withColumn("_n", F.size("_words"))
    # One scan gives the word counts and the prints that some item has; texts without such a print are done.
    prints = fingerprints(doc_words, "doc_id", window, k, short, count="_n")
    scanned = (
        prints.join(broadcast_within(item_prints.withColumn("_met", F.lit(True)), BROADCAST_ROWS), ["_print", "_len"], "left")
        .where(F.col("_met") | (F.col("_len") == 0))
        .groupBy("doc_id")
        .agg(
            F.max(F.when(F.col("_len") == 0, F.col("_print"))).alias("n_words"),
            F.collect_set(F.when(F.col("_met"), F.struct("_at", "_len"))).alias("_hits"),
        )
    )
    ensure_checkpoint_dir(docs.sparkSession)
    scanned = scanned.checkpoint()
    hits = scanned.where(F.size("_hits") > 0).select(F.col("doc_id").alias("_hit_id"), "_hits")
    ids = broadcast_within(hits.select("_hit_id"), BROADCAST_ROWS)
    suspects = docs.join(ids, F.col("doc_id").eqNullSafe(F.col("_hit_id")), "left_semi")

    cover = lambda h: F.when(
        h["_len"] == window,
        F.transform(
            F.sequence(F.greatest(h["_at"] - (window - k), F.lit(0)), h["_at"]),
            lambda s: F.struct(s.alias("start"), h["_len"].alias("len")),
        ),
    ).otherwise(F.array(F.struct(h["_at"].alias("start"), h["_len"].alias("len"))))
    placed = (
        suspects.join(hits, F.col("doc_id").eqNullSafe(F.col("_hit_id")))
        .select("doc_id", "_hits", item_words(F.col("text")).alias("_words"))
        .withColumn("_n", F.size("_words"))
        .withColumn("_cover", F.array_distinct(F.flatten(F.transform("_hits", cover))))
        .withColumn("_cover", F.filter("_cover", lambda c: c["start"] + c["len"] <= F.col("_n")))
        .withColumn(
            "_windows",
            F.transform(
                "_cover",
                lambda c: F.struct(c["start"], c["len"], F.array_join(F.slice("_words", c["start"] + 1, c["len"]), " ").alias("key")),
            ),
        )
        .select("doc_id", F.explode("_windows").alias("_w"))
        .select("doc_id", "_w.start", "_w.len", F.col("_w.key").alias("_key"))
    )

    item_windows = item_text.withColumn("_width", F.least("_n", F.lit(window))).select(
        "_item",
        F.explode(
            F.transform(
                F.sequence(F.lit(1), F.col("_n") - F.col("_width") + 1),
                lambda i: F.array_join(F.slice("_words", i, F.col("_width")), " "),
            )
        ).alias("_key"),
    ).distinct()
    matched = placed.join(item_windows.select("_key").distinct(), "_key").checkpoint()

    here = F.struct("start", (F.col("start") + F.col("len")).alias("end"))
    spans = matched.groupBy(F.col("doc_id").alias("_span_id")).agg(
        _united(F.sort_array(F.collect_set(here))).alias("hit_spans")
    )
    met = (
        matched.select("doc_id", "_key")
        .distinct()
        .join(item_windows, "_key")
        .groupBy(F.col("doc_id").alias("_met_id"))
        .agg(F.sort_array(F.collect_set("_item")).alias("_items"))
    )
    n_hit = F.aggregate("hit_spans", F.lit(0).cast("long"), lambda a, s: a + s["end"] - s["start"])
    return (
        scanned.select("doc_id", "n_words")
        .join(spans, F.col("doc_id").eqNullSafe(F.col("_span_id")), "left")
        .join(met, F.col("doc_id").eqNullSafe(F.col("_met_id")), "left")
        .withColumn("hit_spans", F.coalesce("hit_spans", F.array().cast(SPANS)))
        .withColumn("n_hit", n_hit)
        .select(
            "doc_id",
            "n_words",
            "n_hit",
            F.coalesce(F.size("_items"), F.lit(0)).cast("long").alias("n_items"),
            F.sha2(F.coalesce(F.array_join("_items", ","), F.lit("")), 256).alias("items_sha256"),
            ((F.col("n_hit") > 0) & (min_share * F.col("n_hit") >= F.col("n_words"))).alias("contaminated"),
            "hit_spans",
        )
    )


def _united(spans: Column) -> Column:
    """Sorted spans with overlapping and touching ones merged."""
    def step(acc: Column, s: Column) -> Column:
        last = F.element_at(acc, -1)
        grown = F.concat(
            F.slice(acc, 1, F.size(acc) - 1),
            F.array(F.struct(last["start"].alias("start"), F.greatest(last["end"], s["end"]).alias("end"))),
        )
        return F.when((F.size(acc) > 0) & (s["start"] <= F.try_element_at(acc, F.lit(-1))["end"]), grown).otherwise(
            F.concat(acc, F.array(s))
        )

    def safe(acc: Column, s: Column) -> Column:
        return F.when(F.size(acc) == 0, F.array(s)).otherwise(step(acc, s)).cast(SPANS)

    return F.aggregate(spans.cast(SPANS), F.array().cast(SPANS), safe)


def decontaminated(docs: DataFrame, items: DataFrame, **options: object) -> DataFrame:
    """The documents, with their own columns, that are not contaminated.

    Rows that share an id are one document and stay or go together. Columns may
    have any name; null texts and an empty benchmark leave everything.
    """
    bad = contamination(docs, items, **options).where("contaminated").select(F.col("doc_id").alias("bad_id"))
    return docs.alias("d").join(bad.alias("bad"), F.col("d.doc_id").eqNullSafe(F.col("bad.bad_id")), "left_anti")
