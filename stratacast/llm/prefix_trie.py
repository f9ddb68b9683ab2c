"""Prefix trie of conversations by collapsing whole sequences.

Conversations that are equal from the first turn to the last become one
weighted sequence; only sequences, not conversations, are cut into prefixes. A
prefix is known by its depth and two 64-bit values, each the exclusive-or of
hashes of (depth, turn) over its turns. Exclusive-or may be taken in any order,
so a long conversation is worked on in blocks of turns, and equal prefixes of
different conversations get equal values wherever they are computed.

Sums over subtrees need no walk of the tree. A node's conversations each pass
through its subtree on one path, so the sum over nodes of (members * words) is
the sum over members of the words that follow. What is to be taken off, the
words of every node once, is counted on the path of the smallest member of each
node: on one path these nodes are a tail, so again a single sum suffices.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stratacast.llm.common import broadcast_within, plain_words
from stratacast.session import ensure_checkpoint_dir

# Conversations are rebuilt from the head of the first of every FAMILY ids; heads have fewer than HEADS turns.
FAMILY = 20
HEADS = 4
# Neighbouring turn numbers and depths that one task orders.
BLOCK_BITS = 10
# Neighbouring ids that are listed in one piece before the digest runs over the pieces.
LIST_BITS = 16
# Paths through a node from which on the node is broadcast (three numbers a row) instead of joined by key.
HOT_PATHS = 1_000
BROADCAST_ROWS = 1_000_000
KEY = ["depth", "k1", "k2"]
_FIRST = -(1 << 60)


def _hex_long(text: Column, start: int) -> Column:
    return F.conv(F.substring(text, start, 15), 16, 10).cast("long")


def turn_digests(rows: DataFrame, block_bits: int = BLOCK_BITS) -> DataFrame:
    """(conv_id, _block, turn, role, e1, e2, words): turns with their texts as digests, in blocks of neighbouring numbers."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    digest = F.sha2(F.concat(F.char_length(role).cast("string"), F.lit(":"), role, text), 256)
    return (
        rows.where(F.col("conv_id").isNotNull())
        .select(
            F.col("conv_id").cast("long").alias("conv_id"),
            F.col("turn").cast("long").alias("turn"),
            role.alias("role"),
            digest.alias("_digest"),
            F.size(plain_words(text)).cast("long").alias("words"),
        )
        .select(
            "conv_id",
            F.coalesce(F.shiftright("turn", block_bits), F.lit(_FIRST)).alias("_block"),
            "turn",
            "role",
            _hex_long(F.col("_digest"), 1).alias("e1"),
            _hex_long(F.col("_digest"), 16).alias("e2"),
            "words",
        )
    )


def rebuilt(turns: DataFrame, family: int = FAMILY, heads: int = HEADS) -> tuple[DataFrame, DataFrame]:
    """All conversation ids, and the turns (conv_id, depth, e1, e2, words) of the rebuilt conversations.

    Conversation c takes the first h turns of c - c % family and its own from
    the h-th on, h = crc32(c) % heads. Turns are ordered by number, nulls
    first, then role and digest. What a conversation needs to know is joined to
    its blocks, so a conversation of any length is spread over many tasks.
    """
    block = ["conv_id", "_block"]
    counts = turns.groupBy(*block).agg(F.count("*").alias("_n"))
    sizes = counts.groupBy("conv_id").agg(F.sum("_n").alias("_n"))
    heir = sizes.select(
        "conv_id",
        (F.col("conv_id") - F.col("conv_id") % family).alias("_base"),
        (F.crc32(F.col("conv_id").cast("string").cast("binary")) % heads).alias("_h"),
    )
    base = sizes.select(F.col("conv_id").alias("_base"), F.col("_n").alias("_base_n"))
    plan = heir.join(base, "_base", "left").withColumn("_taken", F.least("_h", F.coalesce("_base_n", F.lit(0)))).checkpoint()
    before = Window.partitionBy("conv_id").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select(*block, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    within = Window.partitionBy(*block).orderBy(F.asc_nulls_first("turn"), "role", "e1", "e2")
    placed = turns.join(counts.join(plan, "conv_id"), block).withColumn("pos", F.col("_before") + F.row_number().over(within) - 1)
    own = placed.where(F.col("pos") >= F.col("_h")).select(
        "conv_id", (F.col("pos") - F.col("_h") + F.col("_taken") + 1).alias("depth"), "e1", "e2", "words"
    )
    head = placed.where((F.col("pos") < heads - 1) & (F.col("conv_id") == F.col("_base")))
    places = F.explode(F.sequence(F.lit(0).cast("long"), F.col("_taken") - 1)).alias("pos")
    wanted = plan.where("_taken > 0").select("conv_id", "_base", places)
    led = wanted.join(head.select("_base", "pos", "e1", "e2", "words"), ["_base", "pos"])
    return plan.select("conv_id"), own.unionByName(led.select("conv_id", (F.col("pos") + 1).alias("depth"), "e1", "e2", "words"))


def sequences(ids: DataFrame, turns: DataFrame) -> DataFrame:
    """(conv_id, length, k1, k2, total): each conversation as a whole; one without turns has length 0."""
    whole = turns.groupBy("conv_id").agg(
        F.count("*").alias("length"),
        F.bit_xor("t1").alias("k1"),
        F.bit_xor("t2").alias("k2"),
        F.sum("words").alias("total"),
    )
    none = F.lit(0).cast("long")
    return ids.join(whole, "conv_id", "left").select(
        "conv_id", *[F.coalesce(c, none).alias(c) for c in ("length", "k1", "k2", "total")]
    )


def by_block(of_rep: DataFrame, block_bits: int) -> DataFrame:
    """One row per block of depths of a sequence: long sequences meet their turns in many tasks."""
    last = F.shiftright("length", block_bits)
    return of_rep.withColumn("_block", F.explode(F.sequence(F.lit(0).cast("long"), last)))


def prefixes(turns: DataFrame, classes: DataFrame, block_bits: int = BLOCK_BITS) -> DataFrame:
    """One row per sequence and depth, 0 included: its key, its parent's key, the words from here on."""
    block = ["rep", "_block"]
    known = by_block(classes.select("rep", "length", "total"), block_bits)
    rows = (
        turns.withColumnRenamed("conv_id", "rep")
        .withColumn("_block", F.shiftright("depth", block_bits))
        .join(known, block)
        .select(*block, "length", "depth", "t1", "t2", "words", "total")
    )
    sums = rows.groupBy(*block).agg(F.bit_xor("t1").alias("_s1"), F.bit_xor("t2").alias("_s2"), F.sum("words").alias("_sw"))
    before = Window.partitionBy("rep").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    none = F.lit(0).cast("long")
    sums = sums.select(
        *block,
        F.coalesce(F.bit_xor("_s1").over(before), none).alias("_b1"),
        F.coalesce(F.bit_xor("_s2").over(before), none).alias("_b2"),
        F.coalesce(F.sum("_sw").over(before), none).alias("_bw"),
    )
    upto = Window.partitionBy(*block).orderBy("depth").rowsBetween(Window.unboundedPreceding, 0)
    k1 = F.col("_b1").bitwiseXOR(F.bit_xor("t1").over(upto))
    k2 = F.col("_b2").bitwiseXOR(F.bit_xor("t2").over(upto))
    done = F.col("_bw") + F.sum("words").over(upto)
    deep = (
        rows.join(sums, block)
        .select(
            *block, "length", "depth", k1.alias("k1"), k2.alias("k2"), "t1", "t2", (F.col("total") - done + F.col("words")).alias("tail")
        )
        .withColumns({"up1": F.col("k1").bitwiseXOR(F.col("t1")), "up2": F.col("k2").bitwiseXOR(F.col("t2"))})
        .drop("t1", "t2")
    )
    root = classes.select(
        "rep",
        none.alias("_block"),
        "length",
        *[none.alias(c) for c in KEY],
        *[F.lit(None).cast("long").alias(c) for c in ("up1", "up2")],
        F.col("total").alias("tail"),
    )
    return deep.unionByName(root)


def with_owners(paths: DataFrame, hot: int = HOT_PATHS) -> DataFrame:
    """Adds ``_owner``, the smallest member of the node of each row.

    Nodes near the root lie on very many paths. Those on more than ``hot``
    are told to the rows where they are, which is a small table as there are
    at most (rows / hot) of them; only the others meet their rows by key.
    """
    owners = paths.groupBy(*KEY).agg(F.min("rep").alias("_owner"), F.count("*").alias("_paths")).checkpoint()
    wide = owners.where(F.col("_paths") > hot).select(*KEY, F.col("_owner").alias("_wide"))
    seen = paths.join(broadcast_within(wide, BROADCAST_ROWS), KEY, "left")
    narrow = seen.where(F.col("_wide").isNull()).drop("_wide").join(owners.where(F.col("_paths") <= hot).drop("_paths"), KEY)
    return narrow.unionByName(seen.where(F.col("_wide").isNotNull()).withColumnRenamed("_wide", "_owner"))


def _digests(pieces: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """SHA-256 over the pieces of each key, which come in order; only the running digest is kept."""
    last, running = None, None
    for frame in pieces:
        out = []
        for depth, k1, k2, listed in frame[["depth", "k1", "k2", "listed"]].itertuples(index=False):
            key = (depth, k1, k2)
            if key != last:
                if last is not None:
                    out.append((*last, running.hexdigest()))
                last, running = key, hashlib.sha256(listed.encode())
            else:
                running.update(b"," + listed.encode())
        yield pd.DataFrame(out, columns=["depth", "k1", "k2", "ends"])
    if last is not None:
        yield pd.DataFrame([(*last, running.hexdigest())], columns=["depth", "k1", "k2", "ends"])


def end_digests(whole: DataFrame, list_bits: int = LIST_BITS) -> DataFrame:
    """(depth, k1, k2, ends): the digest of the ids of the conversations that end at a node.

    Ids are listed in pieces of neighbouring ones. Where one piece is all, its
    digest is taken at once; the pieces of larger groups are sorted and run
    through one digest, which holds a single piece at a time. A digest over a
    list is sequential by definition; its pieces are made in parallel.
    """
    pieces = (
        whole.groupBy(F.col("length").alias("depth"), "k1", "k2", F.shiftright("conv_id", list_bits).alias("_piece"))
        .agg(F.array_join(F.sort_array(F.collect_list("conv_id")).cast("array<string>"), ",").alias("listed"))
        .checkpoint()
    )
    counted = pieces.groupBy(*KEY).agg(F.count("*").alias("_pieces"), F.first("listed").alias("listed"))
    small = counted.where("_pieces = 1").select(*KEY, F.sha2("listed", 256).alias("ends"))
    large = pieces.join(counted.where("_pieces > 1").select(*KEY), KEY, "left_semi")
    streamed = large.repartition(*KEY).sortWithinPartitions(*KEY, "_piece").select(*KEY, "listed")
    return small.unionByName(streamed.mapInPandas(_digests, "depth long, k1 long, k2 long, ends string"))


def prefix_trie(
    rows: DataFrame,
    *,
    family: int = FAMILY,
    heads: int = HEADS,
    block_bits: int = BLOCK_BITS,
    list_bits: int = LIST_BITS,
    hot_paths: int = HOT_PATHS,
) -> DataFrame:
    """One row per node of the trie of rebuilt conversations.

    ``rows`` has conv_id, turn, role and text; other columns are ignored
    whatever their names. A null role or text is empty, a null turn comes
    first; equal turns are ordered by role and then by the digest of role and
    text, so repeated rows are repeated turns. Rows without a conv_id belong to
    no conversation and are left out; ids and turns are whole numbers.
    Conversations may have any length and texts any size: texts are replaced by
    digests in the scan. Two prefixes are the same if their depth and 128 bits
    of hashes are. An empty table gives no rows, a table with a row the root.

    Columns: conv_id (smallest member), depth, parent_conv_id, n_convs,
    n_children, n_leaves, saved_tokens, ends_sha256.
    """
    ensure_checkpoint_dir(rows.sparkSession)
    turns = turn_digests(rows.select("conv_id", "turn", "role", "text"), block_bits).checkpoint()
    ids, told = rebuilt(turns, family, heads)
    told = told.select(
        "conv_id",
        "depth",
        F.xxhash64("depth", "e1", "e2").alias("t1"),
        F.xxhash64("e2", "depth", "e1").alias("t2"),
        "words",
    ).checkpoint()

    # Whole sequences, and one conversation to stand for each.
    whole = sequences(ids, told).checkpoint()
    classes = whole.groupBy("length", "k1", "k2").agg(
        F.min("conv_id").alias("rep"), F.count("*").alias("weight"), F.max("total").alias("total")
    )
    paths = prefixes(told, classes, block_bits).checkpoint()

    # A sequence that is a proper prefix of another is no leaf.
    inner = paths.where(F.col("depth") < F.col("length")).select(*KEY).distinct()
    leaves = classes.select("rep", F.col("length").alias("depth"), "k1", "k2").join(inner, KEY, "left_anti")

    # A node is told of by the sequence of its smallest member: from some depth on all nodes of a path are its own.
    own = F.col("_owner") == F.col("rep")
    tails = (
        with_owners(paths, hot_paths)
        .groupBy("rep")
        .agg(
            F.min(F.when(own, F.col("depth"))).alias("_from"),
            F.max(F.when(own, F.col("tail"))).alias("_own"),
            F.max_by("_owner", F.when(~own, F.col("depth"))).alias("_above"),
        )
    )
    of_rep = (
        classes.select("rep", "length", "weight")
        .join(tails, "rep")
        .join(leaves.select("rep", F.lit(1).cast("long").alias("_leaf")), "rep", "left")
    )
    weighted = paths.drop("length").join(by_block(of_rep, block_bits), ["rep", "_block"]).withColumn("_told", F.coalesce(F.col("depth") >= F.col("_from"), F.lit(False)))

    # Everything that a node is told, by its sequences, its children and the conversations that end there.
    long = lambda c: F.lit(c).cast("long")
    parent = F.when(F.col("depth") > F.col("_from"), F.col("rep")).otherwise(F.col("_above"))
    by_path = weighted.select(
        *KEY,
        "rep",
        "weight",
        F.coalesce("_leaf", long(0)).alias("leaves"),
        (F.col("weight") * F.col("tail") - F.least("tail", F.coalesce("_own", long(0)))).alias("saved"),
        F.when(F.col("_told"), parent).alias("parent"),
        long(0).alias("children"),
        F.lit(None).cast("string").alias("ends"),
    )
    none = [long(None).alias("rep"), long(0).alias("weight"), long(0).alias("leaves"), long(0).alias("saved"), long(None).alias("parent")]
    by_child = weighted.where(F.col("_told") & (F.col("depth") > 0)).select(
        (F.col("depth") - 1).alias("depth"), F.col("up1").alias("k1"), F.col("up2").alias("k2"),
        *none, long(1).alias("children"), F.lit(None).cast("string").alias("ends"),
    )
    by_end = end_digests(whole, list_bits).select(*KEY, *none, long(0).alias("children"), "ends")
    return (
        by_path.unionByName(by_child)
        .unionByName(by_end)
        .groupBy(*KEY)
        .agg(
            F.min("rep").alias("conv_id"),
            F.max("parent").alias("parent_conv_id"),
            F.sum("weight").alias("n_convs"),
            F.sum("children").alias("n_children"),
            F.sum("leaves").alias("n_leaves"),
            F.sum("saved").alias("saved_tokens"),
            F.max("ends").alias("_ends"),
        )
        .select(
            "conv_id",
            "depth",
            "parent_conv_id",
            "n_convs",
            "n_children",
            "n_leaves",
            "saved_tokens",
            F.coalesce("_ends", F.sha2(F.lit(""), 256)).alias("ends_sha256"),
        )
    )
