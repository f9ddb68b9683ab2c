"""Boosted trees against the same algorithm on plain arrays, and their parts against formulas."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from stratacast.operators import boosting as bo
from tests.helpers import random_panel

PLAIN = bo.Settings(rounds=4, depth=3, rate=0.3, min_rows=5, row_share=1.0, column_share=1.0, bins=60)


def data(spark):
    df = random_panel(spark, n_days=60).withColumn("sales_lag_1", F.pmod(F.xxhash64("day_num", "store_id"), F.lit(9)).cast("int"))
    return df.withColumn("sales", (F.col("sales") + F.col("sales_lag_1") * (F.col("day_num") % 3)).cast("int"))


def dense_boost(x, y, s):
    """Exact greedy trees over all thresholds."""
    score = np.full(len(y), math.log(y.mean()))
    splits = 0
    for _ in range(s.rounds):
        g, h = bo.derivatives(y, score, s.power)
        add = np.zeros(len(y))
        todo = [(np.arange(len(y)), 0)]
        while todo:
            rows, level = todo.pop()
            best = (0.0, None)
            whole = g[rows].sum() ** 2 / h[rows].sum()
            for i in range(x.shape[1]) if level < s.depth else ():
                for t in sorted(set(x[rows, i]))[:-1]:
                    left = x[rows, i] <= t
                    if min(left.sum(), (~left).sum()) < s.min_rows:
                        continue
                    a, b = rows[left], rows[~left]
                    gain = g[a].sum() ** 2 / h[a].sum() + g[b].sum() ** 2 / h[b].sum() - whole
                    if gain > best[0] * (1 + 1e-9):
                        best = (gain, (a, b))
            if best[1] is None:
                add[rows] = -s.rate * g[rows].sum() / h[rows].sum()
            else:
                splits += 1
                todo += [(best[1][0], level + 1), (best[1][1], level + 1)]
        score = score + add
    return np.exp(score), splits


def test_trees_equal_exact_greedy_ones(spark, tmp_path):
    df = data(spark)
    model = bo.train_boosted(df, str(tmp_path / "means"), PLAIN)
    rows, _, _ = bo.training_rows(df, model.means)
    table = rows.withColumn("pred", F.lit(0.0)).toPandas()
    want, splits = dense_boost(table[model.columns].to_numpy(dtype=float), table["sales"].to_numpy(dtype=float), PLAIN)
    got = model.predict(df)
    assert got.columns == [*df.columns, "pred"]
    assert sorted(r["pred"] for r in got.collect()) == pytest.approx(sorted(want), rel=1e-9)
    counts = {r["feature"]: r["importance"] for r in model.feature_importance().collect()}
    assert sum(counts.values()) == splits == sum(map(len, model.trees)) and set(counts) == set(model.inputs)

    model.save(str(tmp_path / "model"))
    again = bo.BoostedModel.load(spark, str(tmp_path / "model"))
    assert sorted(r["pred"] for r in again.predict(df).collect()) == sorted(r["pred"] for r in got.collect())
    assert (again.start, again.trees, again.leaves, again.inputs) == (model.start, model.trees, model.leaves, model.inputs)


def test_loss_falls_and_sampling_is_repeatable(spark, tmp_path):
    df = data(spark)
    settings = bo.Settings(rounds=bo.CHECKPOINT_ROUNDS + 2, depth=2, rate=0.2, min_rows=20, bins=8)
    one, two = (bo.train_boosted(df.repartition(n), str(tmp_path / f"m{n}"), settings) for n in (1, 5))
    assert [set(t) for t in one.trees] == [set(t) for t in two.trees]
    y, p = np.array([(r["sales"], r["pred"]) for r in one.predict(df).collect()], dtype=float).T

    def loss(mean):
        return float(np.mean(mean**0.9 / 0.9 + y * mean**-0.1 / 0.1))

    assert loss(p) < loss(np.full(len(y), y.mean())) - 0.05
    assert len({i for t in one.trees for i, _ in t.values()}) > 2


def test_derivatives_are_those_of_the_loss():
    y, s, p, e = np.array([0.0, 1.0, 7.5]), np.array([-1.0, 0.3, 2.0]), 1.1, 1e-5
    loss = lambda s: -y * np.exp((1 - p) * s) / (1 - p) + np.exp((2 - p) * s) / (2 - p)
    g, h = bo.derivatives(y, s, p)
    assert g == pytest.approx((loss(s + e) - loss(s - e)) / (2 * e), abs=1e-6)
    assert h == pytest.approx((bo.derivatives(y, s + e, p)[0] - bo.derivatives(y, s - e, p)[0]) / (2 * e), abs=1e-6)


def test_edges(spark):
    rows = spark.range(10_000).select(
        (F.col("id") % 5).cast("double").alias("few"), F.col("id").cast("double").alias("many"), F.lit(2.0).alias("one")
    )
    few, many, one = bo.bin_edges(rows, ["few", "many", "one"], 16)
    assert few == [0.0, 1.0, 2.0, 3.0] and one == []
    assert len(many) == 15 and all(abs(v - 625 * (i + 1)) <= 5 for i, v in enumerate(many))


def test_rows_of_a_round():
    rows = np.arange(-5_000, 5_000, dtype=np.int64)
    shares = [bo._chosen(rows, r, 0.7) for r in range(3)]
    assert all(abs(s.mean() - 0.7) < 0.03 for s in shares) and (shares[0] != shares[1]).any()
    assert bo._chosen(rows, 0, 1.0).all()


def test_first_split_is_the_largest_gain(spark, tmp_path):
    df = data(spark)
    gains = bo.first_round_gains(df, ["sales_lag_1", "day_num"], PLAIN).toPandas().sort_values("gain")
    mu, p = df.agg(F.avg("sales")).first()[0], PLAIN.power
    rows = df.toPandas()
    for _, r in gains.iterrows():
        left = rows[r["feature"]] <= r["threshold"]
        g = mu ** (2 - p) - rows["sales"] * mu ** (1 - p)
        h = (2 - p) * mu ** (2 - p) - (1 - p) * rows["sales"] * mu ** (1 - p)
        want = sum(g[m].sum() ** 2 / h[m].sum() for m in (left, ~left)) - g.sum() ** 2 / h.sum()
        assert r["n_left"] == left.sum() and r["gain"] == pytest.approx(want, rel=1e-8, abs=1e-8)


def test_no_positive_target_raises(spark, tmp_path):
    with pytest.raises(ValueError, match="positive"):
        bo.train_boosted(data(spark).withColumn("sales", F.lit(0)), str(tmp_path / "m"), PLAIN)
