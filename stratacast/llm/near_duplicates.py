"""Near duplicates by a chosen-path set similarity join.

Documents are sets of word 2-shingles; equal sets are one class. Independent
trees branch the classes by minwise tokens: classes in one node chose the same
tokens on the whole path to it. Classes of large nodes are branched again, in
more and deeper trees. In a leaf all members are compared with its least one
first; pairs that these links leave in different components are then compared
exhaustively, in large leaves inside one task on the full sets. Every other
candidate is confirmed on the full sets too.

A pair at the threshold shares a path of depth d in a tree with probability
0.8^d, so all trees of depth 3 and 4 miss it with probabilities of 4.5e-10 and
7.1e-10. All trees of the next depth take every class that has a large node, so
the sum, 1.2e-9, bounds what is missed in nodes of any size. Every class starts
at depth 3: nodes of depth 2 also fill with unlike texts that share a common
shingle or two, and the classes branched again for them outgrew the input.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from xxhash import xxh3_64_intdigest

from stratacast.llm.common import broadcast_within
from stratacast.session import ensure_checkpoint_dir

# Depth and number of trees; trees of one depth share no token.
TREES = ((3, 30), (4, 40))
NODE = 32
PERCENT = 80
# A pair at the threshold agrees in 128 of 160 minwise tokens on average; under 88 has a probability below 1e-12.
LEAST_AGREEING = 88
BROADCAST_ROWS = 500_000
N_TOKENS = max(d * n for d, n in TREES)
_RNG = np.random.default_rng(17)
_MULTIPLY = _RNG.integers(1, 1 << 63, N_TOKENS, dtype=np.uint64)[:, None] | np.uint64(1)
_ADD = _RNG.integers(0, 1 << 63, N_TOKENS, dtype=np.uint64)[:, None]
_M1, _M2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
_HALF, _ROTATE = np.uint64(32), np.uint64(29)
FEATURES = "doc_id long, n_shingles long, sig_a long, sig_b long, tokens array<smallint>"


def shingle_hashes(text: bytes) -> np.ndarray:
    """Sorted distinct hashes of the 2-shingles of a text; one for a single word, none for no word."""
    words = text.lower().split()
    h = np.fromiter(map(xxh3_64_intdigest, words), np.uint64, len(words))
    if len(h) > 1:
        mixed = h[:-1] * _M1 + (h[1:] ^ (h[1:] >> _ROTATE)) * _M2
        h = mixed ^ (mixed >> _HALF)
    return np.unique(h)


def minwise_tokens(shingles: np.ndarray) -> np.ndarray:
    """The least hash of the set under each of N_TOKENS functions, its last 16 bits.

    Two different tokens look equal once in 65,536 times, which only adds a candidate.
    """
    least = np.full(N_TOKENS, 0xFFFFFFFF, np.uint32)
    for at in range(0, len(shingles), 4096):
        hashed = (shingles[at : at + 4096] * _MULTIPLY + _ADD) >> _HALF
        np.minimum(least, hashed.min(axis=1).astype(np.uint32), out=least)
    return least.astype(np.uint16).view(np.int16)


def set_features(docs: DataFrame) -> DataFrame:
    """Set size, a 128-bit signature of the set and its minwise tokens."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sizes, first, second, tokens = [], [], [], []
            for text in b.column("text").cast(pa.binary()).to_pylist():
                s = shingle_hashes(text or b"")
                raw = s.tobytes()
                sizes.append(len(s))
                first.append(xxh3_64_intdigest(raw) - (1 << 63))
                second.append(xxh3_64_intdigest(raw, seed=1) - (1 << 63))
                tokens.append(minwise_tokens(s))
            flat = np.concatenate(tokens) if tokens else np.array([], np.int16)
            offsets = np.arange(len(tokens) + 1, dtype=np.int32) * N_TOKENS
            yield pa.RecordBatch.from_arrays(
                [
                    b.column("doc_id"),
                    pa.array(sizes, pa.int64()),
                    pa.array(first, pa.int64()),
                    pa.array(second, pa.int64()),
                    pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat)),
                ],
                names=[f.split()[0] for f in FEATURES.split(", ")],
            )

    return docs.mapInArrow(run, FEATURES)


def _nodes(depth: int, trees: int) -> Column:
    """The nodes that a class reaches at a depth, one of each tree."""
    paths = [[F.get("tokens", F.lit(n * depth + k)) for k in range(depth)] for n in range(trees)]
    return F.array(*[F.xxhash64(F.lit(depth), F.lit(n), *path) for n, path in enumerate(paths)])


def _sized(rows: DataFrame, node: str) -> DataFrame:
    """Adds the number of members of each node; counts are summed before the shuffle."""
    counts = rows.groupBy(node).agg(F.count(F.lit(1)).alias("_size")).where("_size > 1")
    return rows.join(counts, node)


def tree_leaves(classes: DataFrame) -> DataFrame:
    """(leaf, class, big): nodes of at most NODE members, or of the greatest depth.

    Most classes are alone in their first node. Those that have a large node
    go through all trees of the next depth.
    """
    rows, leaves = classes.where("n > 0").select("class", "tokens"), None
    for depth, trees in TREES:
        last = depth == TREES[-1][0]
        sized = _sized(rows.select("class", F.explode(_nodes(depth, trees)).alias("leaf")), "leaf").checkpoint()
        big = F.col("_size") > NODE
        done = (sized if last else sized.where(~big)).select("leaf", "class", big.alias("big"))
        leaves = leaves.unionByName(done) if leaves else done
        rows = classes.select("class", "tokens").join(sized.where(big).select("class").distinct(), "class", "left_semi")
    return leaves


def _sizes_allow(n: str, m: str) -> Column:
    return 100 * F.least(n, m) >= PERCENT * F.greatest(n, m)


def pivot_pairs(leaves: DataFrame) -> DataFrame:
    """(a, b): every member with the least member of its leaf."""
    pivots = leaves.groupBy("leaf").agg(F.min("class").alias("_pivot"))
    return leaves.join(pivots, "leaf").where("class != _pivot").select(
        F.least("class", "_pivot").alias("a"), F.greatest("class", "_pivot").alias("b")
    ).distinct()


def _confirm(pairs: DataFrame, classes: DataFrame, docs: DataFrame) -> DataFrame:
    """The pairs whose full sets are similar enough.

    Sizes and minwise tokens rule out most others first; only then texts move.
    """
    for side in ("a", "b"):
        pairs = pairs.join(classes.select(F.col("class").alias(side), F.col("n").alias(f"n{side}")), side)
    pairs = pairs.where(_sizes_allow("na", "nb")).select("a", "b")
    for side in ("a", "b"):
        pairs = pairs.join(classes.select(F.col("class").alias(side), F.col("tokens").alias(f"t{side}")), side)
    agreeing = F.aggregate(
        F.zip_with("ta", "tb", lambda x, y: (x == y).cast("int")), F.lit(0), lambda s, x: s + x
    )
    likely = pairs.where(agreeing >= LEAST_AGREEING).select("a", "b").checkpoint()
    ids = likely.select(F.explode(F.array("a", "b")).alias("_class")).distinct()
    texts = docs.join(broadcast_within(ids, BROADCAST_ROWS), F.col("doc_id") == F.col("_class"), "left_semi")
    # An id on several rows: any of its texts has the set of its class, or none of these pairs is confirmed by it.
    with_a = likely.join(texts.select(F.col("doc_id").alias("a"), F.col("text").alias("_ta")), "a")
    both = with_a.join(texts.select(F.col("doc_id").alias("b"), F.col("text").alias("_tb")), "b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = (batch.column(c).cast(pa.binary()).to_pylist() for c in ("_ta", "_tb"))
            keep, last, left = [], None, None
            for x, y in zip(a, b, strict=True):
                if x is not last:
                    last, left = x, shingle_hashes(x or b"")
                right = shingle_hashes(y or b"")
                shared = len(np.intersect1d(left, right, assume_unique=True))
                keep.append(100 * shared >= PERCENT * (len(left) + len(right) - shared) and shared > 0)
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], ["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return both.select("a", "b", "_ta", "_tb").mapInArrow(run, "a long, b long").distinct()


def components(links: DataFrame) -> DataFrame:
    """(id, component): the least id reachable over links (a, b), for every id that has a link.

    Each round takes the least label around and then that label's own label,
    so long chains shrink quickly; rounds end when nothing changes.
    """
    both = links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct().checkpoint()
    labels = both.groupBy(F.col("a").alias("id")).agg(F.min("b").alias("_m")).select("id", F.least("id", "_m").alias("component"))
    labels = labels.checkpoint()
    while True:
        near = (
            both.join(labels.withColumnRenamed("id", "b"), "b")
            .groupBy(F.col("a").alias("id"))
            .agg(F.min("component").alias("_near"))
        )
        moved = labels.join(near, "id").select("id", "component", F.least("component", "_near").alias("_next"))
        jump = moved.select(F.col("id").alias("_next"), F.col("_next").alias("_far"))
        new = (
            moved.join(jump, "_next", "left")
            .select("id", F.col("component").alias("_old"), F.least("_next", "_far").alias("component"))
            .checkpoint()
        )
        changed = new.where("_old != component").limit(1).count()
        labels = new.select("id", "component")
        if not changed:
            return labels


def _labelled(rows: DataFrame, labels: DataFrame) -> DataFrame:
    return rows.join(labels.withColumnRenamed("id", "class"), "class", "left").withColumn(
        "component", F.coalesce("component", "class")
    )


def remaining_pairs(leaves: DataFrame, labels: DataFrame) -> DataFrame:
    """Pairs of one small leaf that the links so far leave in different components, fewer than NODE per member."""
    rows = _labelled(leaves.where("NOT big"), labels)
    other = rows.select("leaf", F.col("class").alias("_c"), F.col("component").alias("_l"))
    apart = rows.join(other, "leaf").where((F.col("component") != F.col("_l")) & (F.col("class") < F.col("_c")))
    return apart.select(F.col("class").alias("a"), F.col("_c").alias("b")).distinct()


def _leaf_links(part: pd.DataFrame) -> pd.DataFrame:
    """Links that join the components of one leaf as comparing all its members would.

    The member whose shingles are the most common ones comes first, as the
    middle of a group of near copies. Members of its component need no
    comparison of their own: all others are compared with every member.
    """
    ids = part["class"].to_numpy()
    label = np.unique(part["component"].to_numpy(), return_inverse=True)[1]
    sets = [shingle_hashes(t or b"") for t in part["text"]]
    n = np.array([len(s) for s in sets])
    ends = np.cumsum(n)
    _, term, spread = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    holders = np.repeat(np.arange(len(ids), dtype=np.int32), n)[np.argsort(term, kind="stable")]
    last = np.cumsum(spread)
    common = np.array([spread[term[e - k : e]].mean() if k else 0.0 for e, k in zip(ends, n, strict=True)])
    order = np.argsort(-common, kind="stable")
    main, found = label[order[0]], []
    for place, i in enumerate(order):
        if place and label[i] == main:
            continue
        own = term[ends[i] - n[i] : ends[i]]
        lists = [holders[last[t] - spread[t] : last[t]] for t in own[spread[own] > 1]]
        if not lists:
            continue
        shared = np.bincount(np.concatenate(lists), minlength=len(ids))
        near = np.flatnonzero((100 * shared >= PERCENT * (n[i] + n - shared)) & (shared > 0) & (label != label[i]))
        joined, at = np.unique(label[near], return_index=True)
        found += [sorted((int(ids[i]), int(ids[j]))) for j in near[at]]
        if len(joined):
            label[np.isin(label, [label[i], *joined])] = main if main in joined else label[i]
    return pd.DataFrame(found, columns=["a", "b"], dtype="int64")


def crowded_links(leaves: DataFrame, labels: DataFrame, docs: DataFrame) -> DataFrame:
    """Confirmed links between the components that meet in a large leaf.

    A leaf is compared in one task, which holds the shingles of its members.
    """
    rows = _labelled(leaves.where("big"), labels)
    apart = rows.groupBy("leaf").agg(F.min("component").alias("_m"), F.max("component").alias("_n")).where("_m != _n")
    rows = rows.join(apart.select("leaf"), "leaf", "left_semi").select("leaf", "class", "component").checkpoint()
    ids = rows.select(F.col("class").alias("_class")).distinct()
    texts = docs.join(broadcast_within(ids, BROADCAST_ROWS), F.col("doc_id") == F.col("_class"), "left_semi")
    texts = texts.select(F.col("doc_id").alias("class"), F.col("text").cast("binary").alias("text"))
    return rows.join(texts, "class").groupBy("leaf").applyInPandas(_leaf_links, "a long, b long").distinct()


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id, kept and class_id for every document.

    ``docs`` has doc_id and text; other columns are ignored. Texts without
    words have empty sets and are linked with nothing. Rows without an id are
    left out. Rows that repeat an id are one document: equal texts as one, of
    different texts the largest size and the least component. ``class_id``
    names the least document with an equal set. An empty table gives no rows.
    """
    spark = docs.sparkSession
    ensure_checkpoint_dir(spark)
    docs = docs.where("doc_id IS NOT NULL").select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    features = set_features(docs).checkpoint()
    keys = features.groupBy("sig_a", "sig_b").agg(F.min("doc_id").alias("class")).checkpoint()
    first = keys.select(F.col("class").alias("doc_id"), "sig_a", "sig_b")
    classes = (
        features.join(first, ["doc_id", "sig_a", "sig_b"])
        .select(F.col("doc_id").alias("class"), F.col("n_shingles").alias("n"), "tokens")
        .dropDuplicates(["class"])
        .checkpoint()
    )
    leaves = tree_leaves(classes).checkpoint()
    links = _confirm(pivot_pairs(leaves), classes, docs).checkpoint()
    labels = components(links)
    # What is in one component already is not compared again, so groups of near copies cost a few pairs a member.
    for compare in (
        lambda: _confirm(remaining_pairs(leaves, labels), classes, docs),
        lambda: crowded_links(leaves, labels, docs),
    ):
        more = compare().checkpoint()
        if more.limit(1).count():
            links = links.unionByName(more).distinct()
            labels = components(links)
    members = features.select("doc_id", "n_shingles", "sig_a", "sig_b").join(keys, ["sig_a", "sig_b"])
    # Texts without words share the empty signature and stay by themselves.
    members = members.withColumn("class", F.when(F.col("n_shingles") == 0, F.col("doc_id")).otherwise(F.col("class")))
    return (
        members.join(labels.withColumnRenamed("id", "class"), "class", "left")
        .groupBy("doc_id")
        .agg(
            F.max("n_shingles").alias("n_shingles"),
            F.min(F.coalesce("component", "class")).alias("component_id"),
            F.min("class").alias("class_id"),
        )
        .select("doc_id", "n_shingles", "component_id", (F.col("doc_id") == F.col("component_id")).alias("kept"), "class_id")
    )


def deduplicated(docs: DataFrame) -> DataFrame:
    """The documents, with their own columns, that represent their component; rows without an id stay.

    Rows that share an id are one document: all of them stay, or none. Columns
    may have any name; an empty table stays empty. Ids are whole numbers.
    """
    gone = near_duplicates(docs.select("doc_id", "text")).where("NOT kept").select(F.col("doc_id").alias("gone_id"))
    return docs.alias("d").join(gone.alias("gone"), F.col("d.doc_id") == F.col("gone.gone_id"), "left_anti")
