"""Bottom-up, top-down and minimum-trace (OLS) reconciliation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratacast.constants import SERIES_COLS
from stratacast.functions.columns import lookup
from stratacast.session import all_cluster_keys, ensure_checkpoint_dir
from stratacast.split import Split

# The reduced hierarchy, upper levels first, store x department last.
REDUCED_LEVELS = {
    "total": (),
    "state": ("state_id",),
    "store": ("store_id",),
    "dept": ("dept_id",),
    "store_dept": ("store_id", "dept_id"),
}
UPPER = {name: cols for name, cols in REDUCED_LEVELS.items() if name != "store_dept"}
# Days of a horizon that a broadcast of one row per day may have.
BROADCAST_DAYS = 100_000
BOTTOM = ["state_id", "store_id", "dept_id"]


def bottom_up(val: DataFrame, pred_col: str = "pred") -> DataFrame:
    """Keep the bottom forecasts; upper levels follow by summation."""
    return val.withColumn("pred_bu", F.col(pred_col))


def _mean(column: str, n_days: int | None) -> Column:
    """Mean over the rows, or over a stated number of days of which a sparse panel has only some."""
    return F.avg(column) if n_days is None else F.sum(column) / F.lit(n_days)


def historical_proportions(train: DataFrame, actual_col: str = "sales", n_days: int | None = None) -> DataFrame:
    """Mean sales of each series as a share of the sum of means.

    ``n_days`` is the number of training days where zero rows are left out.
    """
    means = train.groupBy(*SERIES_COLS).agg(_mean(actual_col, n_days).alias("avg_sales"))
    total = means.agg(F.sum("avg_sales")).scalar()
    return means.withColumn("proportion", F.try_divide("avg_sales", total))


def national_forecast(val: DataFrame, pred_col: str = "pred", day_col: str = "day_num") -> DataFrame:
    return val.groupBy(day_col).agg(F.sum(pred_col).alias("national_pred"))


def _per_day(df: DataFrame, split: Split) -> DataFrame:
    """Broadcast a frame keyed by validation day when the horizon bounds it."""
    return F.broadcast(df) if split.horizon <= BROADCAST_DAYS else df


def top_down(
    train: DataFrame,
    val: DataFrame,
    split: Split,
    pred_col: str = "pred",
    actual_col: str = "sales",
    day_col: str = "day_num",
    n_days: int | None = None,
) -> DataFrame:
    """Split the national forecast by historical proportions.

    A series without training rows has no proportion and gets NULL.
    """
    shares = historical_proportions(train, actual_col, n_days).drop("avg_sales")
    national = _per_day(national_forecast(val, pred_col, day_col), split)
    joined = val.join(shares, list(SERIES_COLS), "left").join(national, day_col, "left")
    return joined.withColumn("pred_td", F.col("national_pred") * F.col("proportion")).drop("national_pred", "proportion")


def within_dept_proportions(train: DataFrame, actual_col: str = "sales", n_days: int | None = None) -> DataFrame:
    """Mean sales of an item as a share of its store's department; 0 for a dead department."""
    means = train.groupBy("store_id", "dept_id", "item_id").agg(_mean(actual_col, n_days).alias("avg_sales"))
    totals = means.groupBy("store_id", "dept_id").agg(F.sum("avg_sales").alias("dept_total"))
    share = F.coalesce(F.try_divide("avg_sales", "dept_total"), F.lit(0.0))
    return means.join(totals, ["store_id", "dept_id"]).withColumn("within_prop", share)


def base_forecasts(val: DataFrame, pred_col: str = "pred", day_col: str = "day_num") -> DataFrame:
    """Daily base forecasts at the five reduced levels, one row per node and day.

    The store x department sums carry their state, so the upper levels are
    built from them and the bottom rows are read once.
    """
    bottom = val.groupBy(*BOTTOM, day_col).agg(F.sum(pred_col).alias("_y"))
    keys = [*BOTTOM, day_col]
    # One bit per key, first key highest, set where the key is aggregated away.
    sets = {
        "total": [day_col],
        "state": ["state_id", day_col],
        "store": ["store_id", day_col],
        "dept": ["dept_id", day_col],
        "store_dept": ["store_id", "dept_id", day_col],
    }
    ids = {name: sum(1 << (3 - i) for i, c in enumerate(keys) if c not in cols) for name, cols in sets.items()}
    name = lookup("_gid", {gid: n for n, gid in ids.items()})
    return (
        bottom.groupingSets(list(sets.values()), *keys)
        .agg(F.grouping_id().alias("_gid"), F.coalesce(F.sum("_y"), F.lit(0.0)).alias("yhat"))
        .select(name.alias("node_level"), *BOTTOM, day_col, "yhat")
    )


def bottom_nodes(df: DataFrame) -> DataFrame:
    """One row per (state, store, department)."""
    return df.select(*BOTTOM).distinct()


def project_ols(
    base: DataFrame,
    nodes: DataFrame,
    split: Split,
    day_col: str = "day_num",
    tolerance: float = 1e-10,
    max_iterations: int = 200,
) -> DataFrame:
    """Least-squares coherent forecasts at store x department.

    ``base`` holds one forecast per node of the reduced hierarchy and day
    (missing ones count 0), ``nodes`` the store x department nodes. With U the
    upper rows of the summing matrix the solution x of (I + U'U) x = S' yhat is
    found by conjugate gradients: every step is an aggregate and a join per
    upper level, whatever the number of nodes. The matrix has few distinct
    eigenvalues, so a handful of steps is enough.
    """
    return _solve_cg(_right_hand_side(base, nodes, split, day_col), split, day_col, tolerance, max_iterations)


def _node_rows(levels: Sequence[str]) -> Column:
    """The upper nodes (and the node itself) a store x department node belongs to.

    A node key is the array of its values: joined text could collide.
    """
    rows = [
        F.struct(F.lit(name).alias("node_level"), F.array(*[F.col(c) for c in REDUCED_LEVELS[name]]).cast("array<string>").alias("node"))
        for name in levels
    ]
    return F.inline(F.array(*rows))


def _right_hand_side(base: DataFrame, nodes: DataFrame, split: Split, day_col: str) -> DataFrame:
    """b = S' yhat: at each node its own forecast plus those of its ancestors.

    The summing matrix as rows meets all base forecasts in one join.
    """
    days = F.explode(F.sequence(F.lit(split.val_from), F.lit(split.val_to)))
    grid = nodes.select(*BOTTOM, days.alias(day_col))
    members = grid.select(*BOTTOM, day_col, _node_rows(list(REDUCED_LEVELS)))
    key = F.coalesce(
        *[F.when(F.col("node_level") == name, F.array(*[F.col(c) for c in cols]).cast("array<string>")) for name, cols in REDUCED_LEVELS.items()]
    )
    known = base.select("node_level", key.alias("node"), day_col, "yhat")
    joined = members.join(known, ["node_level", "node", day_col], "left")
    return joined.groupBy(*BOTTOM, day_col).agg(F.coalesce(F.sum("yhat"), F.lit(0.0)).alias("b"))


def _apply_normal_matrix(df: DataFrame, vector: str, day_col: str) -> DataFrame:
    """(I + U'U) v: v plus its sums over total, state, store and department.

    All four sums are taken from the incoming rows and joined back, so a step
    reads them five times however many levels there are.
    """
    out, rows = F.col(vector), df
    for name, cols in UPPER.items():
        sums = rows.groupBy(*cols, day_col).agg(F.sum(vector).alias(f"_s_{name}"))
        df = df.join(sums, [*cols, day_col])
        out = out + F.col(f"_s_{name}")
    return df.withColumn("_mv", out).drop(*[f"_s_{name}" for name in UPPER])


def _solve_cg(rhs: DataFrame, split: Split, day_col: str, tolerance: float, max_iterations: int) -> DataFrame:
    """One independent conjugate-gradient run per day, all days side by side.

    Joins on (node, day) must be dealt out by both: with ``tune``'s looser rule
    the planner may use the day alone, of which there are only a few.
    """
    spark = rhs.sparkSession
    ensure_checkpoint_dir(spark)
    with all_cluster_keys(spark):
        return _cg_steps(rhs, split, day_col, tolerance, max_iterations)


def _cg_steps(rhs: DataFrame, split: Split, day_col: str, tolerance: float, max_iterations: int) -> DataFrame:
    r = F.col("r")

    def day_sums(df: DataFrame, **exprs) -> DataFrame:
        return _per_day(df.groupBy(day_col).agg(*[F.sum(e).alias(n) for n, e in exprs.items()]), split)

    state = rhs.select(*BOTTOM, day_col, F.lit(0.0).alias("x"), F.col("b").alias("r"), F.col("b").alias("p"), "b")
    state = state.join(day_sums(state, rr=r * r, bb=F.col("b") * F.col("b")), day_col).drop("b").checkpoint()
    for _ in range(max_iterations):
        worst = state.agg(F.max(F.when(F.col("bb") > 0, F.sqrt(F.col("rr") / F.col("bb"))).otherwise(0.0))).first()[0]
        if worst is None or worst <= tolerance:
            return state.select(*BOTTOM, day_col, "x")
        step = _apply_normal_matrix(state, "p", day_col)
        step = step.join(day_sums(step, pap=F.col("p") * F.col("_mv")), day_col)
        alpha = F.coalesce(F.try_divide("rr", "pap"), F.lit(0.0))
        step = step.withColumns({"x": F.col("x") + alpha * F.col("p"), "r": r - alpha * F.col("_mv")})
        step = step.join(day_sums(step, rr_new=r * r), day_col)
        beta = F.coalesce(F.try_divide("rr_new", "rr"), F.lit(0.0))
        step = step.withColumn("p", r + beta * F.col("p"))
        # A reliable checkpoint each round keeps the plan one round deep.
        state = step.select(*BOTTOM, day_col, "x", "r", "p", F.col("rr_new").alias("rr"), "bb").checkpoint()
    raise RuntimeError(f"no convergence in {max_iterations} iterations, relative residual {worst:.2e}")


def mintrace_ols(
    train: DataFrame,
    val: DataFrame,
    split: Split,
    pred_col: str = "pred",
    actual_col: str = "sales",
    base: DataFrame | None = None,
    day_col: str = "day_num",
    n_days: int | None = None,
) -> DataFrame:
    """Reconcile at store x department, then split to items by their usual share.

    ``base`` may hold forecasts made independently per level; by default the
    bottom forecasts are summed. Negative results are kept.
    """
    base = base_forecasts(val, pred_col, day_col) if base is None else base
    reconciled = project_ols(base, bottom_nodes(val), split, day_col)
    reconciled = reconciled.select("store_id", "dept_id", day_col, F.col("x").alias("_dept_pred"))
    shares = within_dept_proportions(train, actual_col, n_days).select("store_id", "dept_id", "item_id", "within_prop")
    joined = val.join(shares, ["store_id", "dept_id", "item_id"], "left").join(
        reconciled, ["store_id", "dept_id", day_col], "left"
    )
    pred = F.coalesce("_dept_pred", F.lit(0.0)) * F.coalesce("within_prop", F.lit(0.0))
    return joined.withColumn("pred_mint", pred).drop("_dept_pred", "within_prop")


def reconcile_all(
    train: DataFrame, val: DataFrame, split: Split, pred_col: str = "pred", n_days: int | None = None
) -> DataFrame:
    """Bottom-up, top-down and minimum-trace columns side by side."""
    down = top_down(train, bottom_up(val, pred_col), split, pred_col, n_days=n_days)
    return mintrace_ols(train, down, split, pred_col, n_days=n_days)
