"""The trie of rebuilt conversations against a brute-force walk."""

import hashlib
import random
import re
import zlib

import pytest

from stratacast.llm.prefix_trie import prefix_trie

ROW = "conv_id long, turn long, role string, text string"
COLS = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def brute_force(rows):
    own = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            own.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(turns)] for c, turns in own.items()}
    nodes = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 4
        base = c - int(abs(c) % 20) * (1 if c >= 0 else -1)
        told = tuple(own.get(base, [])[:h] + own[c][h:])
        for d in range(len(told) + 1):
            node = nodes.setdefault(told[:d], {"members": [], "ends": []})
            node["members"].append(c)
            if d == len(told):
                node["ends"].append(c)
    out = set()
    for path, node in nodes.items():
        below = [p for p in nodes if p[: len(path)] == path]
        kids = [p for p in below if len(p) == len(path) + 1]
        leaves = [p for p in below if not any(len(q) == len(p) + 1 and q[: len(p)] == p for q in below)]
        words = lambda p: len(re.findall(r"[^\x20\x09-\x0D]+", p[-1][1])) if p else 0
        saved = sum((len(nodes[p]["members"]) - 1) * words(p) for p in below)
        ends = hashlib.sha256(",".join(map(str, sorted(node["ends"]))).encode()).hexdigest()
        parent = min(nodes[path[:-1]]["members"]) if path else None
        out.add((min(node["members"]), len(path), parent, len(node["members"]), len(kids), len(leaves), saved, ends))
    return out


def got(df):
    rows = [tuple(r) for r in df.select(*COLS).collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def family(seed, convs, turns):
    """Few texts, so that prefixes are shared at every depth, some ids without a first of their family."""
    rng = random.Random(seed)
    rows = []
    for c in rng.sample(range(-45, 200), convs):
        for turn in range(rng.randrange(1, turns)):
            rows.append((c, turn, rng.choice(["user", "assistant"]), rng.choice(["a b", "c", "", "d e  f"])))
    return rows


@pytest.mark.parametrize("bits", [(10, 16, 1_000), (1, 1, 5)])
def test_trie_equals_walk(spark, bits):
    rows = family(1, 120, 7)
    frame = spark.createDataFrame(rows, ROW).selectExpr("*", "1 AS depth", "2 AS rep").repartition(5)
    assert got(prefix_trie(frame, block_bits=bits[0], list_bits=bits[1], hot_paths=bits[2])) == brute_force(rows)


def test_registered_table(small):
    rows = [tuple(r) for r in small["conversations"].select("conv_id", "turn", "role", "text").collect()]
    assert got(prefix_trie(small["conversations"])) == brute_force(rows)


def test_odd_rows(spark):
    """Nulls in every column, repeated rows, ties, turnless rebuilt conversations, prefixes of others, long ones."""
    rows = [
        (0, None, None, None), (0, 1, "user", "x y"), (0, 1, "user", "x y"), (20, 0, "user", None), (21, 5, None, "z"),
        (41, 0, "user", "only"), (61, 0, "u", "a"), (61, 0, "u", "b"), (None, 1, "user", "lost"), (-3, 0, "user", "neg"), (-3, -7, "user", "before"),
        (62, 0, "u", "a" * 30_000),
    ]
    rows += [(100, t, "u", "same") for t in range(150)] + [(120, t, "u", "same") for t in range(149)] + [(140, t, "u", "same") for t in range(150)]
    frame = spark.createDataFrame(rows, ROW)
    assert got(prefix_trie(frame, block_bits=3, list_bits=2)) == brute_force(rows)
    # Turnless: fewer own turns than the head takes, and no first of the family.
    assert any(r[1] == 0 and r[-1] != hashlib.sha256(b"").hexdigest() for r in brute_force(rows))


def test_nothing(small):
    assert prefix_trie(small["conversations"].limit(0)).count() == 0
