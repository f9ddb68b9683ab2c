import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from stratacast.operators import metrics as me
from stratacast.operators import reconcile as rc
from stratacast.session import all_cluster_keys
from stratacast.split import Split
from tests.helpers import random_panel, series_frame

SPLIT = Split(1, 30, 31, 40)


@pytest.fixture(scope="module")
def parts(spark):
    df = random_panel(spark).withColumn("pred", F.col("sales") * 0.7 + 0.1)
    return SPLIT.train(df), SPLIT.validation(df)


def dense_projection(base, nodes):
    """S (S'S)^-1 S' on the store x department nodes, day by day."""
    nodes = sorted((r["state_id"], r["store_id"], r["dept_id"]) for r in nodes.collect())
    rows, labels = [], []

    def add(label, member):
        labels.append(label)
        rows.append([float(member(n)) for n in nodes])

    add(("total",), lambda n: True)
    for pos, name in enumerate(("state", "store", "dept")):
        for v in sorted({n[pos] for n in nodes}):
            add((name, v), lambda n, pos=pos, v=v: n[pos] == v)
    for m in nodes:
        add(("store_dept", m[1], m[2]), lambda n, m=m: n == m)
    s = np.array(rows)
    p = np.linalg.solve(s.T @ s, s.T)
    known = {}
    for r in base.collect():
        names = {"total": (), "state": (r["state_id"],), "store": (r["store_id"],), "dept": (r["dept_id"],),
                 "store_dept": (r["store_id"], r["dept_id"])}
        known[(r["node_level"], *names[r["node_level"]]), r["day_num"]] = r["yhat"]
    out = {}
    for day in range(SPLIT.val_from, SPLIT.val_to + 1):
        y = np.array([known.get((label, day), 0.0) for label in labels])
        for n, x in zip(nodes, p @ y):
            out[n[1], n[2], day] = x
    return out


def test_projection_matches_dense_solution(spark, parts):
    _, val = parts
    # An incomplete grid, a missing base cell, and levels that disagree.
    val = val.where("NOT (store_id = 'S3' AND dept_id = 'D1')")
    noise = F.hash("node_level", "state_id", "store_id", "dept_id", "day_num") % 5
    base = rc.base_forecasts(val).withColumn("yhat", F.col("yhat") + noise)
    base = base.where("NOT (node_level = 'store' AND store_id = 'S1' AND day_num = 33)")
    nodes = rc.bottom_nodes(val)
    want = dense_projection(base, nodes)
    got = {(r["store_id"], r["dept_id"], r["day_num"]): r["x"] for r in rc.project_ols(base, nodes, SPLIT).collect()}
    assert got.keys() == want.keys()
    assert all(got[k] == pytest.approx(want[k], abs=1e-7) for k in want)


def test_projection_keeps_coherent_forecasts(spark, parts):
    _, val = parts
    base = rc.base_forecasts(val)
    own = {(r["store_id"], r["dept_id"], r["day_num"]): r["yhat"] for r in base.where("node_level = 'store_dept'").collect()}
    got = rc.project_ols(base, rc.bottom_nodes(val), SPLIT).collect()
    assert all(r["x"] == pytest.approx(own[r["store_id"], r["dept_id"], r["day_num"]]) for r in got)


def test_normal_matrix_is_four_joins_none_by_day_alone(spark, parts):
    _, val = parts
    rhs = val.groupBy("state_id", "store_id", "dept_id", "day_num").agg(F.sum("pred").alias("p"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        with all_cluster_keys(spark):
            plan = rc._apply_normal_matrix(rhs, "p", "day_num")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("SortMergeJoin") == 4
    alone = re.findall(r"hashpartitioning\(day_num#\d+, ", plan)
    # Only the join with the total has no other key: its sums, and the rows that meet them.
    assert len(alone) <= 3


def test_top_down_keeps_totals(spark, parts):
    train, val = parts
    out = rc.top_down(train, val, SPLIT)
    sums = out.groupBy("day_num").agg(F.sum("pred").alias("a"), F.sum("pred_td").alias("b")).collect()
    assert all(r["a"] == pytest.approx(r["b"]) for r in sums)


def test_top_down_unseen_series_is_null(spark, parts):
    train, val = parts
    out = rc.top_down(train.where("item_id <> 'D0_0'"), val, SPLIT)
    assert out.where("item_id = 'D0_0' AND pred_td IS NOT NULL").count() == 0


def test_no_training_sales_at_all(spark):
    train = series_frame(spark, [0, 0])
    assert rc.historical_proportions(train).first()["proportion"] is None
    assert rc.within_dept_proportions(train).first()["within_prop"] == 0.0


def test_mintrace_distributes_the_department(spark, parts):
    train, val = parts
    out = rc.mintrace_ols(train, val, SPLIT)
    sums = out.groupBy("store_id", "dept_id", "day_num").agg(F.sum("pred").alias("a"), F.sum("pred_mint").alias("b")).collect()
    assert all(r["a"] == pytest.approx(r["b"]) for r in sums)
    assert sorted(out.columns) == sorted([*val.columns, "pred_mint"])


def test_level_one_is_equal_for_all_methods(spark, parts):
    train, val = parts
    methods = ("pred_bu", "pred_td", "pred_mint")
    both = me.combine(train, rc.reconcile_all(train, val, SPLIT), methods)
    levels = me.wrmsse_levels(me.score_series(both, SPLIT, methods), SPLIT, methods).where("level = 1").collect()
    assert len(levels) == 3
    assert max(r["wrmsse"] for r in levels) == pytest.approx(min(r["wrmsse"] for r in levels))
