"""Boosted trees under the Tweedie loss with a log link, grown level by level.

Inputs become bins, by their values where these are few and by quantiles of a
sketch otherwise. The binned rows lie in chunks, each a few arrays. A level of
a tree is one pass: every task adds up the loss's first and second derivatives
of its rows by (node, input, bin), Spark sums these histograms, and the best
split of each node is read off them. What reaches the driver per level is at
most (nodes x inputs x bins) sums, whatever the number of rows. The scores of
the rows are kept beside them and brought up to date in the first pass of the
next round; every ``CHECKPOINT_ROUNDS`` rounds they are written to the shared
folder, so a lost executor repeats a bounded number of rounds.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stratacast.constants import (
    LEARNING_RATE,
    MIN_ROWS_PER_LEAF,
    N_TREES,
    SAMPLE_FRACTION,
    SEED,
    SERIES_COLS,
    TREE_DEPTH,
    TWEEDIE_POWER,
)
from stratacast.operators.forecasting import encode, prepare_features, target_means, with_inputs
from stratacast.session import ensure_checkpoint_dir

CHUNK = "n int, bins binary, row binary, y binary, score binary"
CELL = "node int, input int, bin int, g double, h double, n long"
CHECKPOINT_ROUNDS = 25
SKETCH_ACCURACY = 10_000
# Gains closer than this share are taken for equal, so that the order of sums decides nothing.
SAME_GAIN = 1e-9


@dataclass(frozen=True)
class Settings:
    """How trees are grown; the defaults are the study's."""

    rounds: int = N_TREES
    depth: int = TREE_DEPTH
    rate: float = LEARNING_RATE
    power: float = TWEEDIE_POWER
    min_rows: int = MIN_ROWS_PER_LEAF
    min_hessian: float = 1e-3
    row_share: float = SAMPLE_FRACTION
    column_share: float = SAMPLE_FRACTION
    bins: int = 64
    seed: int = SEED


@dataclass(frozen=True)
class Tree:
    """Nodes are numbered like a heap: 1 is the root, 2k and 2k + 1 follow k."""

    splits: dict[int, tuple[int, int]] = field(default_factory=dict)
    leaves: dict[int, float] = field(default_factory=dict)


def derivatives(y: np.ndarray, score: np.ndarray, power: float) -> tuple[np.ndarray, np.ndarray]:
    """First and second derivative of the Tweedie loss by the log of the mean."""
    low, high = np.exp((1 - power) * score), np.exp((2 - power) * score)
    return high - y * low, (2 - power) * high - (1 - power) * y * low


def _walk(splits: dict[int, tuple[int, float]], depth: int, right: Callable[[np.ndarray, np.ndarray, np.ndarray], np.ndarray], n: int) -> np.ndarray:
    """The node each row ends in; ``right(inputs, rows, thresholds)`` tells which rows turn right."""
    size = 1 << (depth + 1)
    inputs, thresholds = np.full(size, -1), np.zeros(size)
    for k, (i, t) in splits.items():
        inputs[k], thresholds[k] = i, t
    node = np.ones(n, dtype=np.int64)
    for _ in range(depth):
        rows = np.flatnonzero(inputs[node] >= 0)
        if not len(rows):
            break
        at = node[rows]
        node[rows] = 2 * at + right(inputs[at], rows, thresholds[at])
    return node


def _chosen(row: np.ndarray, round_: int, share: float) -> np.ndarray:
    """The rows of a round: a mixed hash of row and round below the share."""
    if share >= 1:
        return np.ones(len(row), dtype=bool)
    with np.errstate(over="ignore"):
        x = row.view(np.uint64) + np.uint64(round_ + 1) * np.uint64(0x9E3779B97F4A7C15)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return (x >> np.uint64(11)) < np.uint64(int(share * (1 << 53)))


def bin_edges(rows: DataFrame, inputs: Sequence[str], bins: int) -> list[list[float]]:
    """Upper bounds of the bins of each input but the last bin.

    One pass sketches quantiles and the number of values of every input. An
    input with fewer values than bins gets its values as they are, in a second
    pass that gathers at most a few times ``bins`` numbers per input.
    """
    shares = [i / bins for i in range(1, bins)]
    found = rows.agg(
        *[F.percentile_approx(F.col(f"`{c}`"), shares, SKETCH_ACCURACY).alias(f"q{i}") for i, c in enumerate(inputs)],
        *[F.approx_count_distinct(F.col(f"`{c}`")).alias(f"d{i}") for i, c in enumerate(inputs)],
        *[F.max(F.col(f"`{c}`")).alias(f"m{i}") for i, c in enumerate(inputs)],
    ).first()
    few = [i for i in range(len(inputs)) if found[f"d{i}"] <= 1.2 * bins]
    exact = rows.agg(*[F.collect_set(F.col(f"`{inputs[i]}`")).alias(f"v{i}") for i in few]).first() if few else None
    edges = []
    for i in range(len(inputs)):
        values = sorted(set(exact[f"v{i}"])) if i in few else None
        if values is None or len(values) > bins:
            values = sorted({*found[f"q{i}"], found[f"m{i}"]}) if found[f"q{i}"] else []
        edges.append([float(v) for v in values[:-1]])
    return edges


def chunks(rows: DataFrame, inputs: Sequence[str], target: str, row: str, edges: list[list[float]], start: float) -> DataFrame:
    """The training rows as arrays: bins by input, hash, target and score."""
    bounds = [np.array(e) for e in edges]

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            if n:
                columns = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
                bins = np.stack([np.searchsorted(b, x, side="left") for b, x in zip(bounds, columns, strict=False)])
                cells = [bins.astype(np.uint16), columns[-1].astype(np.int64), columns[-2].astype(float), np.full(n, start)]
                yield pa.RecordBatch.from_pydict({"n": pa.array([n], pa.int32())} | {
                    name: [cell.tobytes()] for name, cell in zip(("bins", "row", "y", "score"), cells, strict=True)
                })

    cells = [F.col(f"`{c}`").cast("double").alias(f"c{i}") for i, c in enumerate(inputs)]
    return rows.select(*cells, F.col(target).cast("double").alias("_y"), F.col(row).alias("_row")).mapInArrow(packed, CHUNK)


def _unpacked(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    for n, bins, row, y, score in zip(*[batch.column(i).to_pylist() for i in range(5)], strict=True):
        yield (
            np.frombuffer(bins, np.uint16).reshape(-1, n),
            np.frombuffer(row, np.int64),
            np.frombuffer(y, float),
            np.frombuffer(score, float),
        )


def advanced(state: DataFrame, tree: Tree, settings: Settings) -> DataFrame:
    """The chunks with the tree's leaf values added to their scores."""
    leaves = np.zeros(1 << (settings.depth + 1))
    leaves[list(tree.leaves)] = list(tree.leaves.values())

    def moved(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = []
            for bins, _, _, score in _unpacked(batch):
                node = _walk(tree.splits, settings.depth, lambda i, r, t, b=bins: b[i, r] > t, len(score))
                scores.append((score + leaves[node]).tobytes())
            yield pa.RecordBatch.from_arrays([*batch.columns[:4], pa.array(scores, pa.binary())], schema=batch.schema)

    return state.mapInArrow(moved, CHUNK)


def histogram(
    state: DataFrame, tree: Tree, nodes: Sequence[int], inputs: Sequence[int], round_: int, settings: Settings
) -> DataFrame:
    """Sums of derivatives and rows by (node, input, bin) of the nodes that may be split."""

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = np.full(1 << (settings.depth + 1), -1)
        place[list(nodes)] = np.arange(len(nodes))
        sums, width = None, settings.bins + 1
        for batch in batches:
            for bins, row, y, score in _unpacked(batch):
                node = _walk(tree.splits, settings.depth, lambda i, r, t, b=bins: b[i, r] > t, len(y))
                use = np.flatnonzero(_chosen(row, round_, settings.row_share) & (place[node] >= 0))
                g, h = derivatives(y[use], score[use], settings.power)
                base = place[node[use]] * width
                if sums is None:
                    sums = np.zeros((3, len(inputs), len(nodes) * width))
                for k, i in enumerate(inputs):
                    cell = base + bins[i, use]
                    for s, weights in enumerate((g, h, None)):
                        sums[s, k] += np.bincount(cell, weights, minlength=sums.shape[2])
        if sums is not None:
            k, cell = np.nonzero(sums[2])
            columns = [np.asarray(nodes)[cell // width], np.asarray(inputs)[k], cell % width]
            out = [pa.array(c, pa.int32()) for c in columns] + [pa.array(sums[s, k, cell]) for s in (0, 1)]
            out.append(pa.array(sums[2, k, cell].astype(np.int64)))
            yield pa.RecordBatch.from_arrays(out, names=["node", "input", "bin", "g", "h", "n"])

    sums = state.mapInArrow(added, CELL).groupBy("node", "input", "bin")
    return sums.agg(F.sum("g").alias("g"), F.sum("h").alias("h"), F.sum("n").alias("n"))


def split_gains(cells: DataFrame, settings: Settings) -> DataFrame:
    """Every allowed split of every node: rows on the left, and how much it lowers the loss."""
    whole = Window.partitionBy("node", "input")
    left = whole.orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)
    sums = {f"{c}{side}": F.sum(c).over(w) for c in "ghn" for side, w in (("", whole), ("_left", left))}
    split = cells.select("node", "input", "bin", *[e.alias(f"s{name}") for name, e in sums.items()])
    parts = lambda side: F.pow(F.col(f"sg{side}"), F.lit(2)) / F.col(f"sh{side}")
    split = split.withColumns({f"s{c}_right": F.col(f"s{c}") - F.col(f"s{c}_left") for c in "ghn"})
    allowed = F.lit(True)
    for side in ("_left", "_right"):
        allowed &= (F.col(f"sn{side}") >= settings.min_rows) & (F.col(f"sh{side}") >= settings.min_hessian)
    return split.where(allowed).select(
        "node", "input", "bin", F.col("sn_left").alias("n_left"), (parts("_left") + parts("_right") - parts("")).alias("gain")
    )


def best_splits(cells: pd.DataFrame, settings: Settings) -> tuple[dict[int, tuple[int, int]], dict[int, tuple[float, float, int]]]:
    """The split with the largest gain per node, the first input and bin among equals, and the sums of nodes and children.

    The same rule as ``split_gains``, over a level's sums on the driver.
    """
    splits, sums = {}, {}
    for node, of_node in cells.groupby("node"):
        best = (0.0, None, None)
        for i, rows in of_node.groupby("input"):
            rows = rows.sort_values("bin")
            g, h, n = (rows[c].to_numpy() for c in ("g", "h", "n"))
            left = [c.cumsum()[:-1] for c in (g, h, n)]
            total = [c.sum() for c in (g, h, n)]
            right = [t - c for t, c in zip(total, left, strict=True)]
            sums.setdefault(node, tuple(total))
            ok = np.ones(len(rows) - 1, dtype=bool)
            for side in (left, right):
                ok &= (side[2] >= settings.min_rows) & (side[1] >= settings.min_hessian)
            if not ok.any():
                continue
            gain = np.full(len(ok), -np.inf)
            gain[ok] = left[0][ok] ** 2 / left[1][ok] + right[0][ok] ** 2 / right[1][ok] - total[0] ** 2 / total[1]
            at = int(np.flatnonzero(gain >= gain.max() * (1 - SAME_GAIN))[0]) if gain.max() > 0 else -1
            if at >= 0 and gain[at] > best[0] * (1 + SAME_GAIN):
                ends = {2 * node: tuple(c[at] for c in left), 2 * node + 1: tuple(c[at] for c in right)}
                best = (gain[at], (int(i), int(rows["bin"].iloc[at])), ends)
        if best[1]:
            splits[int(node)] = best[1]
            sums |= best[2]
    return splits, sums


def grow(state: DataFrame, round_: int, n_inputs: int, settings: Settings) -> Tree:
    """One tree, a pass per level; nodes that no split improves become leaves."""
    rng = np.random.default_rng([settings.seed, round_])
    used = sorted(rng.choice(n_inputs, max(1, math.ceil(settings.column_share * n_inputs)), replace=False).tolist())
    tree, sums, open_nodes = Tree(), {}, [1]
    for _ in range(settings.depth):
        cells = histogram(state, tree, open_nodes, used, round_, settings).toPandas()
        splits, found = best_splits(cells, settings)
        sums |= found
        tree.splits.update(splits)
        open_nodes = sorted(c for k in splits for c in (2 * k, 2 * k + 1) if sums[c][2] >= 2 * settings.min_rows)
        if not open_nodes:
            break
    ends = {c for k in tree.splits for c in (2 * k, 2 * k + 1)} - set(tree.splits) or {1}
    leaves = {int(k): float(-settings.rate * sums[k][0] / sums[k][1]) for k in ends if k in sums and sums[k][1] > 0}
    return Tree(tree.splits, leaves)


def boost(rows: DataFrame, inputs: Sequence[str], target: str, row: str, settings: Settings) -> tuple[float, list[list[float]], list[Tree]]:
    """Start value, bin edges and trees. ``row`` is a long hash that tells rows apart for sampling."""
    ensure_checkpoint_dir(rows.sparkSession)
    mean = rows.agg(F.avg(target)).first()[0]
    if not mean or mean <= 0:
        raise ValueError(f"the mean of {target} must be positive for a log link")
    start, edges = math.log(mean), bin_edges(rows, inputs, settings.bins)
    state = chunks(rows, inputs, target, row, edges, start).checkpoint()
    trees: list[Tree] = []
    kept: list[DataFrame] = []
    for round_ in range(settings.rounds):
        trees.append(grow(state, round_, len(inputs), settings))
        state = advanced(state, trees[-1], settings)
        if (round_ + 1) % CHECKPOINT_ROUNDS == 0:
            state = state.checkpoint()
        else:
            state = state.persist(StorageLevel.MEMORY_AND_DISK)
            kept.append(state)
        # The newest needs the one before until its first pass has run.
        while len(kept) > 2 or (kept and (round_ + 1) % CHECKPOINT_ROUNDS == 0):
            kept.pop(0).unpersist()
    for old in kept:
        old.unpersist()
    return start, edges, trees


@dataclass
class BoostedModel:
    """Trees over raw input values, with the encodings they were grown on."""

    start: float
    trees: list[dict[int, tuple[int, float]]]
    leaves: list[dict[int, float]]
    means: DataFrame
    numeric: list[str]
    categories: list[str]
    depth: int

    @property
    def inputs(self) -> list[str]:
        return [*self.numeric, *[f"{c}_enc" for c in self.categories]]

    @property
    def columns(self) -> list[str]:
        return [*[f"{c}_in" for c in self.numeric], *[f"{c}_enc" for c in self.categories]]

    def predict(self, df: DataFrame) -> DataFrame:
        """Add ``pred``, the mean under the model; the frame keeps its own columns, a ``pred`` among them is replaced."""
        start, trees, depth = self.start, self.trees, self.depth
        tables = []
        for leaves in self.leaves:
            table = np.zeros(1 << (depth + 1))
            table[list(leaves)] = list(leaves.values())
            tables.append(table)

        @F.pandas_udf("double")
        def mean(*columns: pd.Series) -> pd.Series:
            x = np.stack([c.to_numpy(dtype=float) for c in columns])
            score = np.full(x.shape[1], start)
            for splits, table in zip(trees, tables, strict=True):
                score += table[_walk(splits, depth, lambda i, r, t: x[i, r] > t, x.shape[1])]
            return pd.Series(np.exp(score))

        keep = [c for c in df.columns if c != "pred"]
        encoded = encode(with_inputs(df, self.numeric), self.means, self.categories)
        return encoded.select(*keep, mean(*[F.col(f"`{c}`") for c in self.columns]).alias("pred"))

    def feature_importance(self) -> DataFrame:
        """How often each input splits a node."""
        counts = dict.fromkeys(range(len(self.inputs)), 0)
        for splits in self.trees:
            for i, _ in splits.values():
                counts[i] += 1
        rows = [(name, float(counts[i])) for i, name in enumerate(self.inputs)]
        return self.means.sparkSession.createDataFrame(rows, "feature string, importance double")

    def save(self, path: str) -> None:
        spark = self.means.sparkSession
        rows = [(k, node, i, t, None) for k, splits in enumerate(self.trees) for node, (i, t) in splits.items()]
        rows += [(k, node, None, None, v) for k, leaves in enumerate(self.leaves) for node, v in leaves.items()]
        nodes = spark.createDataFrame(rows, "tree int, node int, input int, threshold double, value double")
        nodes.coalesce(1).write.mode("overwrite").parquet(f"{path}/nodes")
        facts = [("numeric", i, c, None) for i, c in enumerate(self.numeric)]
        facts += [("category", i, c, None) for i, c in enumerate(self.categories)]
        facts += [("start", len(self.trees), "", self.start), ("depth", self.depth, "", None)]
        kind = "kind string, position int, name string, value double"
        spark.createDataFrame(facts, kind).coalesce(1).write.mode("overwrite").parquet(f"{path}/inputs")
        self.means.write.mode("overwrite").parquet(f"{path}/means")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> BoostedModel:
        facts = spark.read.parquet(f"{path}/inputs").orderBy("position").collect()
        start = next(r for r in facts if r["kind"] == "start")
        trees: list[dict] = [{} for _ in range(start["position"])]
        leaves: list[dict] = [{} for _ in trees]
        for r in spark.read.parquet(f"{path}/nodes").collect():  # at most 2^(depth + 1) rows a tree
            if r["input"] is None:
                leaves[r["tree"]][r["node"]] = r["value"]
            else:
                trees[r["tree"]][r["node"]] = (r["input"], r["threshold"])
        names = {k: [r["name"] for r in facts if r["kind"] == k] for k in ("numeric", "category")}
        depth = next(r["position"] for r in facts if r["kind"] == "depth")
        means = spark.read.parquet(f"{path}/means")
        return cls(start["value"], trees, leaves, means, names["numeric"], names["category"], depth)


def training_rows(df: DataFrame, means: DataFrame, keys: Sequence[str] = (*SERIES_COLS, "day_num")) -> tuple[DataFrame, list[str], list[str]]:
    """Encoded inputs, target and row hash; numeric and categorical names."""
    numeric, categories = prepare_features(df)
    encoded = encode(with_inputs(df, numeric), means, categories)
    cols = [f"{c}_in" for c in numeric] + [f"{c}_enc" for c in categories]
    present = [c for c in keys if c in df.columns] or df.columns
    return encoded.select(*cols, "sales", F.xxhash64(*present).alias("_row")), numeric, categories


def train_boosted(df: DataFrame, means_path: str, settings: Settings | None = None) -> BoostedModel:
    """Fit boosted trees over all series; a null input counts 0, as does one that is absent when predicting."""
    settings = settings or Settings()
    target_means(df, prepare_features(df)[1]).write.mode("overwrite").parquet(means_path)
    means = df.sparkSession.read.parquet(means_path)
    rows, numeric, categories = training_rows(df, means)
    inputs = [c for c in rows.columns if c not in ("sales", "_row")]
    rows = rows.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        start, edges, trees = boost(rows, inputs, "sales", "_row", settings)
    finally:
        rows.unpersist()
    raw = [{k: (i, edges[i][b]) for k, (i, b) in t.splits.items()} for t in trees]
    return BoostedModel(start, raw, [t.leaves for t in trees], means, numeric, categories, settings.depth)


def first_round_gains(df: DataFrame, inputs: Sequence[str], settings: Settings, target: str = "sales") -> DataFrame:
    """Every split of the first root with its threshold: the table from which the first split is taken."""
    rows = df.select(
        *[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in inputs], target, F.lit(0).cast("long").alias("_row")
    )
    start, edges = math.log(rows.agg(F.avg(target)).first()[0]), bin_edges(rows, inputs, settings.bins)
    state = chunks(rows, inputs, target, "_row", edges, start)
    cells = histogram(state, Tree(), [1], range(len(inputs)), 0, settings)
    bounds = [(i, b, inputs[i], v) for i, e in enumerate(edges) for b, v in enumerate(e)]
    names = df.sparkSession.createDataFrame(bounds, "input int, bin int, feature string, threshold double")
    return split_gains(cells, settings).join(F.broadcast(names), ["input", "bin"]).select("feature", "threshold", "n_left", "gain")
