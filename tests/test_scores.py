import numpy as np
import pytest
from pyspark.sql import functions as F

from stratacast.constants import LEVELS
from stratacast.operators import hierarchy as hi
from stratacast.operators import metrics as me
from stratacast.operators.panel import value_steps
from stratacast.split import Split
from tests.helpers import random_panel, series_frame

SPLIT = Split(1, 30, 31, 40)


def with_pred(df):
    return df.withColumn("pred", F.when(F.col("day_num") >= SPLIT.val_from, F.col("sales") * 0.5 + F.col("day_num") % 3))


def dense_scores(df):
    """The definition on plain arrays, level by level."""
    pdf = df.toPandas()
    pdf["pred"] = pdf["pred"].fillna(0.0)
    scores = {}
    for level, cols in LEVELS.items():
        key = pdf[list(cols)].agg("|".join, axis=1) if cols else "all"
        table = pdf.assign(key=key).pivot_table(index="key", columns="day_num", values=["sales", "sell_price", "pred"], aggfunc="sum")
        y, p, f = (table[c].to_numpy() for c in ("sales", "sell_price", "pred"))
        train, val = slice(0, 30), slice(30, 40)
        scale = np.mean(np.diff(y[:, train], axis=1) ** 2, axis=1)
        scale[scale == 0] = 1
        money = (y[:, train] * p[:, train]).sum(axis=1)
        w = money / money.sum() if money.sum() else np.ones(len(money)) / len(money)
        r2 = ((y[:, val] - f[:, val]) ** 2).sum(axis=1) / (10 * scale)
        scores[level] = np.sqrt((w * r2).sum())
    return scores


def level_scores(df, **kwargs):
    series = me.score_series(df, SPLIT, **kwargs)
    return {r["level"]: r["wrmsse"] for r in me.wrmsse_levels(series, SPLIT).collect()}


@pytest.mark.parametrize("dense", [False, True])
def test_scores_match_arrays(spark, dense):
    df = with_pred(random_panel(spark))
    want = dense_scores(df)
    got = level_scores(df, dense=dense)
    assert got == {k: pytest.approx(v, rel=1e-9) for k, v in want.items()}


def test_sparse_rows_score_like_zero_rows(spark):
    df = with_pred(random_panel(spark)).withColumn("sell_price", F.lit(1.0))
    first = F.col("day_num").isin(1, 31)
    sparse = df.where(first | (F.col("sales") > 0) | (F.col("day_num") > 30))
    full = {r["level"]: r["s"] for r in me.score_series(df, SPLIT).groupBy("level").agg(F.sum("scale").alias("s")).collect()}
    thin = {r["level"]: r["s"] for r in me.score_series(sparse, SPLIT).groupBy("level").agg(F.sum("scale").alias("s")).collect()}
    assert thin == {k: pytest.approx(v) for k, v in full.items()}


def test_row_order_and_layout_do_not_matter(spark):
    df = with_pred(random_panel(spark))
    shuffled = df.orderBy(F.rand(3)).repartition(7)
    assert level_scores(shuffled) == {k: pytest.approx(v) for k, v in level_scores(df).items()}


def test_staged_equals_single_grouping(spark):
    df = random_panel(spark)
    staged = hi.aggregate_levels(df, ["sales"])
    single = hi.aggregate_levels(df, ["sales"], staged=False)
    assert staged.exceptAll(single).count() == 0
    assert single.exceptAll(staged).count() == 0
    assert staged.select("level").distinct().count() == 12


def test_constant_series_has_scale_one(spark):
    df = with_pred(series_frame(spark, [4] * 40))
    assert {r["scale"] for r in me.score_series(df, SPLIT).collect()} == {1.0}


def test_zero_dollars_give_equal_weights(spark):
    df = with_pred(random_panel(spark)).withColumn("sell_price", F.lit(0.0))
    series = me.series_weights(me.score_series(df, SPLIT))
    sums = {r["level"]: r["s"] for r in series.groupBy("level").agg(F.sum("weight").alias("s")).collect()}
    assert sums == {k: pytest.approx(1.0) for k in LEVELS}
    assert series.where("level = 12").select("weight").distinct().count() == 1
    assert level_scores(df) == {k: pytest.approx(v) for k, v in dense_scores(df).items()}


def test_unmatched_series_are_reported_not_scored(spark):
    df = with_pred(random_panel(spark)).where("NOT (store_id = 'S0' AND day_num > 30)")
    series = me.score_series(df, SPLIT)
    missing = me.unmatched(series).where("level = 3").collect()
    assert [(r["store_id"], r["missing_in"]) for r in missing] == [("S0", "validation")]
    assert me.matched(series).where("level = 3").count() == 3


def test_coherence(spark):
    df = with_pred(random_panel(spark)).where("day_num > 30")
    assert me.coherence_error(df).first()["coherence_error"] == pytest.approx(0, abs=1e-6)
    parent = df.groupBy("store_id", "day_num").agg((F.sum("pred") + 1).alias("pred"))
    error = me.coherence_between(parent, df, ["store_id"], ["pred"]).first()["coherence_error"]
    assert error == pytest.approx(4 * 10)


def test_dependency_check(spark):
    hi.check_dependencies(random_panel(spark))
    bad = series_frame(spark, [1], state="A").union(series_frame(spark, [1], state="B", item="I2"))
    with pytest.raises(ValueError, match="state_id"):
        hi.check_dependencies(bad)


@pytest.mark.parametrize("weights", ["level", "revenue"])
def test_sparse_panel_with_price_steps_scores_like_a_dense_one(spark, weights):
    """Prices differ by week and series and are missing in some; only rows with sales are kept."""
    df = random_panel(spark).withColumn("week", F.floor((F.col("day_num") - 1) / 7).cast("int"))
    price = F.pmod(F.xxhash64("store_id", "item_id", "week"), F.lit(4)) * 1.25
    df = with_pred(df.withColumn("sell_price", F.when(price > 0, price)))
    weekly = df.select(*hi.KEYS, "week", "sell_price").distinct()
    steps = value_steps(weekly, lambda w: w * 7 + 1, lambda w: w * 7 + 7, SPLIT.train_from, SPLIT.train_to, "week")
    mark = F.col("day_num") == SPLIT.train_from
    sparse = df.where(mark | (F.col("sales") > 0) | (F.col("day_num") >= SPLIT.val_from))
    full = me.series_weights(me.score_series(df, SPLIT, weights=weights))
    thin = me.series_weights(me.score_series(sparse, SPLIT, weights=weights, price_steps=steps))
    cols = ["level", *hi.KEYS]
    want = {tuple(r[c] for c in cols): (r["weight"], r["scale"], r["sse_pred"]) for r in full.collect()}
    got = {tuple(r[c] for c in cols): (r["weight"], r["scale"], r["sse_pred"]) for r in thin.collect()}
    assert got == {k: pytest.approx(v, rel=1e-9, abs=1e-12) for k, v in want.items()} and len(got) == len(want)
    assert level_scores(sparse, weights=weights, price_steps=steps) == pytest.approx(level_scores(df, weights=weights))
