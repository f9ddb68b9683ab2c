"""Quality rules whose thresholds come from the corpus itself.

Document statistics are computed inside each row. Quantile summaries, which
merge across partitions, are taken per language and source, per language and
over all; a document fails when a statistic lies beyond the outer tenth of the
narrowest group with enough documents by more than a multiple of the distance
from there to the median. No constant takes part, but for the grain: what a
single occurrence adds to a document's own share never decides.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratacast.llm.common import PLAIN_GAP, plain_words, whole_text
from stratacast.session import ensure_checkpoint_dir

SPAN = 8
SYMBOLS = "#*$%&|<>"
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
MIN_GROUP = 200
ACCURACY = 10_000
# The outer share of a group on either side, and the distances to the median that are still inside beyond it.
TAIL = 0.1
FENCE = 3.0
STATISTICS = ("symbol_share", "dup_line_share", "mean_word", "repeat_share")
# One passage shorter than two windows that occurs twice.
ONE_REPEAT = 2 * (2 * SPAN - 1)


def _repeat_words(windows: str) -> Column:
    """Words covered by windows whose hash occurs twice or more; the column holds one hash per start.

    The sorted windows are passed as a lambda's argument, so they are made once.
    """
    placed = F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

    def twice(s: Column) -> Column:
        same = F.filter(
            s,
            lambda w, i: w["h"].eqNullSafe(F.get(s, i - 1)["h"]) | w["h"].eqNullSafe(F.get(s, i + 1)["h"]),
        )
        return F.sort_array(F.transform(same, lambda w: w["i"]))

    starts = F.get(F.transform(F.array(placed), twice), 0)
    zero = F.struct(F.lit(0).alias("n"), F.lit(0).alias("end"))
    return F.aggregate(
        starts,
        zero,
        lambda a, i: F.struct(
            (a["n"] + i + SPAN - F.greatest(i, a["end"])).cast("int").alias("n"), (i + SPAN).cast("int").alias("end")
        ),
        lambda a: a["n"],
    )


def document_stats(docs: DataFrame) -> DataFrame:
    """doc_id, lang, source and the counts the rules use; a null text has no words."""
    text = whole_text(F.col("text"))
    base = docs.select(
        "doc_id",
        "lang",
        "source",
        plain_words(F.col("text")).alias("_words"),
        F.char_length(F.regexp_replace(text, PLAIN_GAP, "")).cast("long").alias("word_chars"),
        (F.char_length(text) - F.char_length(F.translate(text, SYMBOLS, ""))).cast("long").alias("n_symbols"),
        F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")).alias("_lines"),
    )
    hashed = base.withColumn("_hashes", F.transform("_words", lambda w: F.xxhash64(w)))
    count = F.size("_hashes") - (SPAN - 1)
    windows = hashed.withColumn(
        "_windows",
        F.when(
            count > 1,
            F.transform(
                F.sequence(F.lit(0), count - 1), lambda i: F.xxhash64(*[F.get("_hashes", i + j) for j in range(SPAN)])
            ),
        ).otherwise(F.array().cast("array<bigint>")),
    )
    repeated = F.when(
        F.size(F.array_distinct("_windows")) < F.size("_windows"), _repeat_words("_windows")
    ).otherwise(F.lit(0))
    n_lines = F.size("_lines")
    return windows.select(
        "doc_id",
        "lang",
        "source",
        F.size("_words").cast("long").alias("n_words"),
        "word_chars",
        "n_symbols",
        (n_lines - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        n_lines.cast("long").alias("_n_lines"),
        repeated.cast("long").alias("n_repeat_words"),
    )


def _shares(stats: DataFrame) -> DataFrame:
    words, lines = F.greatest("n_words", F.lit(1)), F.greatest("_n_lines", F.lit(1))
    return (
        stats.withColumn("symbol_share", F.col("n_symbols") / words)
        .withColumn("dup_line_share", F.col("n_dup_lines") / lines)
        .withColumn("mean_word", F.col("word_chars") / words)
        .withColumn("repeat_share", F.col("n_repeat_words") / words)
    )


def _grain(name: str) -> Column:
    """What one occurrence adds to a statistic of the document itself."""
    if name == "dup_line_share":
        return F.lit(1.0) / F.greatest("_n_lines", F.lit(1))
    return F.lit(float(ONE_REPEAT if name == "repeat_share" else 1)) / F.greatest("n_words", F.lit(1))


def _limits(stats: DataFrame, by: list[str], level: str, accuracy: int) -> DataFrame:
    """Row count and (lower tail, median, upper tail) of every statistic; the summaries merge across partitions."""
    aggregates = [F.count(F.lit(1)).alias(f"{level}_n")]
    for name in STATISTICS:
        aggregates.append(F.percentile_approx(name, [TAIL, 0.5, 1 - TAIL], accuracy).alias(f"{level}_{name}"))
    return stats.groupBy(*[F.col(c).alias(f"{level}_{c}") for c in by]).agg(*aggregates)


def quality_rules(
    docs: DataFrame, *, min_group: int = MIN_GROUP, fence: float = FENCE, accuracy: int = ACCURACY
) -> DataFrame:
    """Counts, the fixed base rule and the adaptive verdict, one row per document row.

    ``docs`` has doc_id, text, lang and source; other columns are ignored.
    Null languages and sources form groups of their own, a null text has no
    words and fails the base rule, repeated rows are judged and counted each,
    an empty table gives no rows. Equal values at a threshold pass. Documents
    failing the base rule do not shape the thresholds. ``min_group`` is the
    least number of documents a group needs to set its own fences.

    Columns: doc_id, n_words, word_chars, n_symbols, n_dup_lines,
    n_repeat_words, base_failed, kept.
    """
    ensure_checkpoint_dir(docs.sparkSession)
    # A few numbers per document; the summaries and the verdict read them.
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    stats = _shares(document_stats(docs)).withColumn("base_failed", failed).checkpoint()
    good = stats.where(~F.col("base_failed"))
    both = _limits(good, ["lang", "source"], "both", accuracy)
    lang = _limits(good, ["lang"], "lang", accuracy)
    every = _limits(good, [], "every", accuracy)
    # Twelve numbers over all; beside them one row per language and source, and one per language.
    every = _limits(good, [], "every", accuracy).first()

    def overall(name: str) -> Column:
        found = every[f"every_{name}"]
        return F.array(*map(F.lit, found)) if found else F.lit(None).cast("array<double>")

    limits = both.join(lang, F.col("both_lang").eqNullSafe(F.col("lang_lang")))
    chosen = [
        F.when(F.col("both_n") >= min_group, F.col(f"both_{n}"))
        .when(F.col("lang_n") >= min_group, F.col(f"lang_{n}"))
        .otherwise(overall(n))
        .alias(f"_{n}")
        for n in STATISTICS
    ]
    limits = limits.select("both_lang", "both_source", *chosen)
    joined = stats.join(
        limits,
        F.col("lang").eqNullSafe(F.col("both_lang")) & F.col("source").eqNullSafe(F.col("both_source")),
        "left",
    )
    inside = F.lit(True)
    for name in STATISTICS:
        low, middle, high = (F.get(f"_{name}", k) for k in range(3))
        inside = inside & (F.col(name) <= high + fence * (high - middle) + _grain(name))
        if name == "mean_word":
            inside = inside & (F.col(name) >= low - fence * (middle - low) - _grain(name))
    return joined.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        (~F.col("base_failed") & F.coalesce(inside, F.lit(True))).alias("kept"),
    )
