"""Secrets: patterns for known forms, and a battery of randomness tests for the rest.

Three base kinds are reported wherever their pattern and length hold. Beside
them every long run of letters and digits whose characters fit an encoding is
read as that encoding's symbols and tested as a sample of independent uniform
symbols: chi-squared over the alphabet, runs around its middle, and the serial
correlation of neighbours. The three p-values become one (Fisher), and each
encoding and length band decides by its own histogram of p-values from which
value on a run counts as random, so that the estimated share of structured
runs among the reported ones stays below ``FALSE_SHARE``: short runs, whose
tests have little power, need a higher p-value than long ones.

Only built-in functions are used. Spans are code points, end exclusive.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stratacast.llm.common import whole_text

# The base kinds in their order, with the number of characters that the named group needs.
BASE = (
    (
        "assign",
        r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        1,
        8,
    ),
    # A later start inside the same run leaves a shorter match, so a length in the pattern decides alike.
    ("access", r"AKIA[A-Z0-9]{12,}", 0, 16),
    ("hex", r"(?<![0-9a-f])[0-9a-f]{32,}", 0, 32),
)
# A run of the characters that encodings use, with at most two pad characters.
RUN = r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{20,}={0,2}"
# Alphabets in code order.
_UPPER, _LOWER, _DIGITS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz", "0123456789"
ALPHABETS = {
    "hex": _DIGITS + "abcdef",
    "base32": _UPPER + "234567",
    "base62": _UPPER + _LOWER + _DIGITS,
    "base64": _UPPER + _LOWER + _DIGITS + "+/",
    "base64url": _UPPER + _LOWER + _DIGITS + "-_",
}
BINS = 200
# Runs with a p-value in the upper half are taken for random ones when their number is estimated.
UPPER_FROM = BINS // 2
FALSE_SHARE = 0.05
LEAST_P = 1e-12
SPAN = "array<struct<start:bigint,rank:int,kind:string,end:bigint>>"


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once inside a lambda."""
    return F.transform(F.array(value), use)[0]


def _sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0).cast("long"), lambda a, v: a + v)


def _starts(gaps: Column, lengths: Column) -> Column:
    """Where each match starts: the text before it, matches included.

    Sums of blocks first, then inside a block, so a text with n matches costs n^1.5 steps.
    """
    steps = F.zip_with(lengths, F.slice(gaps, 1, F.size(lengths)), lambda m, g: m + g)
    width = F.greatest(F.lit(1), F.ceil(F.sqrt(F.size(lengths))).cast("int"))

    def place(steps: Column) -> Column:
        blocks = F.transform(F.sequence(F.lit(0), F.size(steps).cast("int")), lambda b: b * width)
        before = F.transform(F.filter(blocks, lambda b: b < F.size(steps)), lambda b: _sum(F.slice(steps, 1, b)))
        inside = lambda i: F.slice(steps, i - i % width + 1, i % width)
        return _let(
            before,
            lambda sums: F.transform(
                F.sequence(F.lit(0), F.size(steps) - 1),
                lambda i: F.get(sums, F.floor(i / width).cast("int")) + _sum(inside(i)) + F.get(gaps, i),
            ),
        )

    return _let(steps, place)


def _found(docs: DataFrame, name: str, pattern: str) -> DataFrame:
    """Adds ``_<name>``, the matches, and ``_<name>_at``, their starts; a text without a match is not split."""
    docs = docs.withColumn(f"_{name}", F.regexp_extract_all("_text", F.lit(pattern), F.lit(0)))
    gaps = F.transform(F.split("_text", pattern, -1), lambda g: F.char_length(g).cast("long"))
    docs = docs.withColumn("_gaps", F.when(F.size(f"_{name}") > 0, gaps))
    lengths = F.transform(f"_{name}", lambda m: F.char_length(m).cast("long"))
    at = F.when(F.size(f"_{name}") > 0, _starts(F.col("_gaps"), lengths))
    return docs.withColumn(f"_{name}_at", F.coalesce(at, F.array().cast("array<bigint>"))).drop("_gaps")


def _base_spans(docs: DataFrame, rank: int, kind: str, pattern: str, group: int, least: int) -> DataFrame:
    docs = _found(docs, kind, pattern)
    size = F.transform(f"_{kind}", F.char_length)
    if group:
        size = F.transform(F.regexp_extract_all("_text", F.lit(pattern), F.lit(group)), F.char_length)
    docs = docs.withColumn("_size", F.when(F.size(f"_{kind}") > 0, size).otherwise(F.array().cast("array<int>")))
    spans = F.transform(
        f"_{kind}_at",
        lambda at, i: F.struct(
            at.alias("start"),
            F.lit(rank).alias("rank"),
            F.lit(kind).alias("kind"),
            (at + F.char_length(F.get(f"_{kind}", i))).alias("end"),
            F.get("_size", i).alias("size"),
        ),
    )
    kept = F.transform(
        F.filter(spans, lambda s: s["size"] >= least), lambda s: F.struct(s["start"], s["rank"], s["kind"], s["end"])
    )
    return docs.withColumn(f"_{kind}_spans", kept.cast(SPAN)).drop(f"_{kind}", f"_{kind}_at", "_size")


def encoding_of(body: Column) -> Column:
    """The narrowest encoding whose characters these are; null for words, numbers, paths and mixtures.

    Every encoding asks for letters and digits, those of two cases for both.
    """
    digit, lower, upper = body.rlike("[0-9]"), body.rlike("[a-z]"), body.rlike("[A-Z]")
    mixed = digit & lower & upper
    return (
        F.when(body.rlike("^([0-9a-f]+|[0-9A-F]+)$") & digit & (lower | upper), "hex")
        .when(body.rlike("^[A-Z2-7]+$") & digit & upper, "base32")
        .when(body.rlike("^[A-Za-z0-9]+$") & mixed, "base62")
        .when(body.rlike("^[A-Za-z0-9+/]+$") & mixed, "base64")
        .when(body.rlike("^[A-Za-z0-9_-]+$") & mixed, "base64url")
    )


def two_sided(z: Column) -> Column:
    """Probability that a standard normal value lies at least as far out; a polynomial, right to 2e-7."""
    # The coefficients of the usual rational approximation.
    def tail(x: Column, t: Column) -> Column:
        series = t * (0.254829592 + t * (-0.284496736 + t * (1.421413741 + t * (-1.453152027 + t * 1.061405429))))
        return F.greatest(F.lit(LEAST_P), F.least(F.lit(1.0), series * F.exp(-x * x)))

    return _let(F.abs(z) / F.lit(2.0**0.5), lambda x: _let(1.0 / (1.0 + 0.3275911 * x), lambda t: tail(x, t)))


def _chi_squared(body: Column, alphabet: Column, n: Column, size: Column) -> Column:
    """How far the symbol counts are from even ones, on both sides: Wilson and Hilferty's normal form."""
    squares = F.aggregate(
        F.split(alphabet, ""),
        F.lit(0).cast("long"),
        lambda a, s: _let(n - F.char_length(F.replace(body, s, F.lit(""))), lambda c: a + c * c),
    )
    spread = 2.0 / (9.0 * (size - 1))
    return two_sided((F.pow((squares * size / n - n) / (size - 1), F.lit(1.0 / 3)) - (1.0 - spread)) / F.sqrt(spread))


def _runs(codes: Column, after: Column, n: Column, size: Column) -> Column:
    """Runs of symbols of the lower and of the upper half; one half alone is no sample at all."""
    high = lambda c: c >= size / 2
    ones = _sum(F.transform(codes, lambda c: high(c).cast("long")))
    turns = _sum(F.zip_with(codes, after, lambda a, b: (high(a) != high(b)).cast("long")))
    # The last pair goes round the end.
    turns = turns - (high(F.element_at(codes, -1)) != high(F.get(codes, 0))).cast("long")

    def test(ones: Column) -> Column:
        both = 2.0 * ones * (n - ones)
        spread = both * (both - n) / (n * n * (n - 1.0))
        return F.when(spread > 0, two_sided((turns + 1 - both / n - 1.0) / F.sqrt(spread))).otherwise(F.lit(LEAST_P))

    return _let(ones, test)


def _serial(codes: Column, after: Column, n: Column) -> Column:
    """Correlation of each symbol with the next, the last with the first."""
    sums = F.struct(
        _sum(codes).alias("x"),
        _sum(F.transform(codes, lambda c: c * c)).alias("xx"),
        _sum(F.zip_with(codes, after, lambda a, b: a * b)).alias("xy"),
    )
    sd = F.sqrt(n * (n - 3.0) / (n + 1.0)) / (n - 1.0)

    def test(s: Column) -> Column:
        spread = n * s["xx"] - s["x"] * s["x"]
        r = (n * s["xy"] - s["x"] * s["x"]) / spread.cast("double")
        return F.when(spread > 0, two_sided((r + 1.0 / (n - 1.0)) / sd)).otherwise(F.lit(LEAST_P))

    return _let(sums, test)


def randomness(body: Column, encoding: Column) -> Column:
    """One p-value for "independent uniform symbols of this encoding" from the three tests."""
    alphabet = F.coalesce(*[F.when(encoding == k, F.lit(a)) for k, a in ALPHABETS.items()])
    body = F.when(encoding == "hex", F.lower(body)).otherwise(body)

    def battery(s: Column) -> Column:
        n, size = F.char_length(s["body"]).cast("long"), F.char_length(s["alphabet"])
        codes = F.transform(F.split(s["body"], ""), lambda c: (F.instr(s["alphabet"], c) - 1).cast("long"))

        def combined(codes: Column) -> Column:
            after = F.concat(F.slice(codes, F.lit(2), F.greatest(F.size(codes) - 1, F.lit(0))), F.slice(codes, 1, 1))
            tests = _let(
                after,
                lambda rest: F.struct(
                    _chi_squared(s["body"], s["alphabet"], n, size).alias("a"),
                    _runs(codes, rest, n, size).alias("b"),
                    _serial(codes, rest, n).alias("c"),
                ),
            )
            y = _let(tests, lambda p: -F.ln(p["a"]) - F.ln(p["b"]) - F.ln(p["c"]))
            return _let(y, lambda y: F.exp(-y) * (1.0 + y + y * y / 2.0))

        return _let(codes, combined)

    return _let(F.struct(body.alias("body"), alphabet.alias("alphabet")), battery)


def with_candidates(docs: DataFrame) -> DataFrame:
    """Adds ``_runs``: start, end, encoding, length band and p-value bin of the runs that fit an encoding."""
    docs = _found(docs, "run", RUN)
    placed = F.transform(
        F.arrays_zip(F.col("_run").alias("run"), F.col("_run_at").alias("at")),
        lambda r: _let(
            F.rtrim(r["run"], F.lit("=")),
            lambda body: F.struct(
                r["at"].alias("start"),
                (r["at"] + F.char_length(r["run"])).alias("end"),
                body.alias("body"),
                encoding_of(body).alias("encoding"),
            ),
        ),
    )
    fitting = F.filter(placed, lambda r: r["encoding"].isNotNull())
    tested = F.transform(
        fitting,
        lambda r: F.struct(
            r["start"].alias("start"),
            r["end"].alias("end"),
            r["encoding"].alias("encoding"),
            F.floor(F.log2(F.char_length(r["body"]))).cast("int").alias("band"),
            F.least(F.lit(BINS - 1), F.floor(randomness(r["body"], r["encoding"]) * BINS + 1e-7)).cast("int").alias("bin"),
        ),
    )
    # A conditional keeps texts without a run, nearly all, away from the battery.
    none = F.array().cast("array<struct<start:bigint,end:bigint,encoding:string,band:int,bin:int>>")
    return docs.withColumn("_runs", F.when(F.size("_run") > 0, tested).otherwise(none)).drop("_run", "_run_at")


def thresholds(runs: DataFrame, false_share: float = FALSE_SHARE) -> DataFrame:
    """(encoding, band, from_bin): the least p-value bin from which runs of a kind and length are reported.

    Random runs have even p-values, so twice the number in the upper half
    estimates how many there are. Of the runs from a bin on, those beyond the
    estimate's share count as false; the lowest bin whose false share is small
    enough is taken, the middle at the latest. ``runs`` has encoding, band and
    bin; it is counted per bin before anything is moved, and what is ordered
    per kind has at most ``BINS`` rows.
    """
    counts = runs.groupBy("encoding", "band", "bin").agg(F.count("*").alias("n"))
    kind = Window.partitionBy("encoding", "band")
    above = kind.orderBy(F.desc("bin")).rowsBetween(Window.unboundedPreceding, 0)
    upper = F.sum(F.when(F.col("bin") >= UPPER_FROM, F.col("n")).otherwise(0)).over(kind)
    graded = counts.withColumns({"_above": F.sum("n").over(above), "_random": 2 * upper})
    expected = F.col("_random") * (1 - F.col("bin") / F.lit(BINS))
    fits = F.col("_above") - expected <= false_share * F.col("_above") + 1e-9
    lowest = F.min(F.when(fits & (F.col("bin") < UPPER_FROM), F.col("bin")))
    return graded.groupBy("encoding", "band").agg(F.coalesce(lowest, F.lit(UPPER_FROM)).alias("from_bin"))


def secrets(docs: DataFrame, *, false_share: float = FALSE_SHARE) -> DataFrame:
    """Per row: counts and digest of the base spans, and all spans with those of the battery.

    A run inside a base span adds nothing. Every row is judged by itself but
    for the thresholds, which come from the runs of all rows: repeated rows and
    ids give repeated results and count as often as they occur. A null text is
    empty and has no span; null ids stay. An empty table gives no rows. Of the
    input only doc_id and text are used, so other columns may have any name.
    Very long texts cost time in proportion, a text with n matches n^1.5 steps
    for their places. Equal starts are listed in the order of kinds.

    Columns: doc_id, n_assign, n_access, n_hex, base_sha256, spans.
    """
    docs = docs.select("doc_id", whole_text(F.col("text")).alias("_text"))
    runs = with_candidates(docs).select(F.inline("_runs"))
    limits = thresholds(runs, false_share)
    # One entry per encoding and length band, some hundred at most.
    entry = F.struct(F.concat_ws(":", "encoding", "band"), "from_bin")
    limits = limits.agg(F.map_from_entries(F.collect_list(entry)).alias("limits")).scalar()

    scanned = docs
    for rank, (kind, pattern, group, least) in enumerate(BASE):
        scanned = _base_spans(scanned, rank, kind, pattern, group, least)
    scanned = with_candidates(scanned).withColumn("_limits", limits)
    listed = lambda spans: F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ","
    )
    kinds = [k for k, *_ in BASE]
    order = {name: len(BASE) + i for i, name in enumerate(ALPHABETS)}
    rank = lambda r: F.coalesce(*[F.when(r["encoding"] == k, F.lit(i)) for k, i in order.items()])
    passing = F.filter(
        "_runs",
        lambda r: (r["bin"] >= F.try_element_at("_limits", F.concat_ws(":", r["encoding"], r["band"])))
        & ~F.exists("_base", lambda b: (b["start"] <= r["start"]) & (r["end"] <= b["end"])),
    )
    added = F.transform(
        passing, lambda r: F.struct(r["start"], rank(r).alias("rank"), F.concat(F.lit("random_"), r["encoding"]), r["end"])
    )
    return (
        scanned.withColumn("_base", F.sort_array(F.concat(*[F.col(f"_{k}_spans") for k in kinds])))
        .withColumn("_all", F.sort_array(F.concat("_base", added.cast(SPAN))))
        .select(
            "doc_id",
            *[F.size(f"_{k}_spans").cast("long").alias(f"n_{k}") for k in kinds],
            F.sha2(listed(F.col("_base")), 256).alias("base_sha256"),
            listed(F.col("_all")).alias("spans"),
        )
    )
