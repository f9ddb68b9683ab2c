"""Divergence of sources against brute force with Python's whole numbers."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from stratacast.llm.source_divergence import _merged, price, share, source_divergence
from tests.llm.reference import lower

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
COLS = ("lang", "source", "part", "item", "value", "rank")


def brute_force(rows, min_docs=3, top=200):
    counts, docs = defaultdict(Counter), defaultdict(Counter)
    for text, lang, source in rows:
        terms = TERM.findall(lower(text))
        counts[lang or "", source or ""].update(terms)
        docs[lang or ""].update(set(terms))
    out = set()
    for lang in {k[0] for k in counts}:
        kept = sorted(t for t in docs[lang] if docs[lang][t] >= min_docs)
        groups = {s: c for (g, s), c in counts.items() if g == lang}

        def shares(count):
            total = sum(count[t] for t in kept)
            return {t: 1 + 10**9 * (count[t] + 1) // (total + len(kept)) for t in kept}

        whole = shares(sum(groups.values(), Counter()))
        p = {s: shares(c) for s, c in groups.items()}
        f = lambda a, b: (a - b) * (a - b) // b
        for s in groups:
            pairs = [(-sum(f(p[s][t], p[o][t]) for t in kept), o.encode()) for o in groups if o != s]
            terms = [(-f(p[s][t], whole[t]), t.encode()) for t in kept if groups[s][t] > 0 and p[s][t] > whole[t]]
            for part, items in (("pair", sorted(pairs)), ("term", sorted(terms)[:top])):
                out |= {(lang, s, part, i.decode(), -v, n) for n, (v, i) in enumerate(items, 1)}
    return out


def got(df):
    rows = [tuple(r) for r in df.select(*COLS).collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


@pytest.fixture(scope="module")
def rows():
    """Few words of uneven frequency, more sources than a tile, nulls and empty names, a language without kept terms."""
    rng = random.Random(4)
    words = ["Der", "der", "é", "ÉÉ", "x2y", "größe", "日本", "a_b", "the", "zz"] + [f"w{chr(97 + n % 26)}{chr(97 + n // 26)}" for n in range(300)]
    rows = []
    for _ in range(300):
        text = " ".join(rng.choice(words[: rng.choice([5, 40, 310])]) for _ in range(rng.randrange(60)))
        rows.append((text, rng.choice(["en", "de"]), rng.choice([f"s{n}" for n in range(12)] + ["S", "é", "", None])))
    rows += [(None, "en", "empty"), ("", None, None), ("solo words", "xx", "a"), ("solo", "xx", "b"), ("123 !", "fr", "none"), ("der " * 40_000, "de", "s1")]
    return rows


@pytest.mark.parametrize("options", [{}, {"block_terms": 7, "tile": 3}, {"tile": 1}])
def test_divergence_equals_brute_force(spark, rows, options):
    frame = spark.createDataFrame(rows, "text string, lang string, source string")
    frame = frame.selectExpr("*", "1 AS term", "2L AS n", "3 AS i").repartition(4)
    assert got(source_divergence(frame, **options)) == brute_force(rows)


def test_top_terms_and_repeated_rows(spark, rows):
    frame = spark.createDataFrame(rows * 2, "text string, lang string, source string")
    assert got(source_divergence(frame, top_terms=5)) == brute_force(rows * 2, top=5)


def test_registered_table(small):
    rows = [(r["text"], r["lang"], r["source"]) for r in small["documents"].collect()]
    assert got(source_divergence(small["documents"])) == brute_force(rows)


def test_odd_texts(odd_docs, odd_rows):
    assert got(source_divergence(odd_docs, min_docs=2)) == brute_force([(r[1], r[2], r[3]) for r in odd_rows], min_docs=2)


def test_nothing(odd_docs):
    assert source_divergence(odd_docs.limit(0)).count() == 0


def test_merge_counts_every_term_once():
    rng = np.random.default_rng(2)
    for _ in range(50):
        terms = int(rng.integers(1, 60))
        sides = []
        for _ in range(2):
            ids = np.sort(rng.choice(terms, int(rng.integers(0, terms + 1)), replace=False)).astype(np.int64)
            sides.append((ids, rng.integers(1, 10**9 + 2, len(ids)), int(rng.integers(1, 10**6))))
        (ia, pa, za), (ib, pb, zb) = sides
        a, b = ({t: z for t in range(terms)} | dict(zip(i.tolist(), p.tolist(), strict=True)) for i, p, z in sides)
        want = (sum((a[t] - b[t]) ** 2 // b[t] for t in range(terms)), sum((a[t] - b[t]) ** 2 // a[t] for t in range(terms)))
        assert _merged(ia, pa, za, ib, pb, zb, terms) == want


def test_shares_are_exact_beyond_longs(spark):
    from pyspark.sql import functions as F

    n = 9_000_000_000_000_000
    frame = spark.createDataFrame([(n, 2 * n, 12_345, 10**9 + 1, 1)], "n long, total long, terms long, p long, q long")
    r = frame.select(share(F.col("n"), F.col("total"), F.col("terms")).alias("s"), price(F.col("p"), F.col("q")).alias("f")).first()
    assert r["s"] == 1 + 10**9 * (n + 1) // (2 * n + 12_345) and r["f"] == 10**18
