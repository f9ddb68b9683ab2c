import math
import statistics

import pytest
from pyspark.sql import functions as F

from stratacast.functions.columns import clip_at_zero, round_cents
from stratacast.operators import features as ft
from stratacast.operators.features import _rolling_by_frames
from tests.helpers import random_panel, series_frame, values


def test_lags_do_not_cross_series(spark):
    df = series_frame(spark, [1, 3, 5]).union(series_frame(spark, [7, 8, 9], item="I2"))
    out = ft.add_lags(df, [1])
    assert values(out.where("item_id = 'I1'"), "sales_lag_1") == [None, 1, 3]
    assert values(out.where("item_id = 'I2'"), "sales_lag_1") == [None, 7, 8]


def test_rolling_edges(spark):
    sales = [1, 3, 5, 0, 2]
    out = ft.add_rolling(series_frame(spark, sales), [3])
    for i, (mean, std) in enumerate(values(out, "sales_rmean_3", "sales_rstd_3")):
        before = sales[max(0, i - 3) : i]
        assert mean == (pytest.approx(statistics.mean(before)) if before else None)
        assert std == (pytest.approx(statistics.stdev(before)) if len(before) > 1 else None)


def test_rolling_matches_sliding_frames(spark):
    df = random_panel(spark).withColumn("sales", F.when(F.col("day_num") % 9 != 0, F.col("sales")))
    fast, slow = ft.add_rolling(df, [4, 20]), _rolling_by_frames(df, [4, 20], "sales")
    names = ["sales_rmean_4", "sales_rstd_4", "sales_rmean_20", "sales_rstd_20"]
    keys = ["store_id", "item_id", "day_num"]
    a = {tuple(r[k] for k in keys): [r[n] for n in names] for r in fast.collect()}
    for r in slow.collect():
        for x, y in zip(a[tuple(r[k] for k in keys)], [r[n] for n in names]):
            assert (x is None) == (y is None)
            assert x is None or x == pytest.approx(y, abs=1e-9)


def test_empty_means_none_and_missing_means_default(spark):
    df = series_frame(spark, [1, 2])
    assert ft.add_lags(df, []).columns == df.columns
    assert ft.add_rolling(df, []).columns == df.columns
    assert "sales_lag_28" in ft.add_lags(df).columns


def test_calendar_features(spark):
    df = spark.createDataFrame(
        [("d_7", 7, 3, "A", "NoEvent", 1, 0), ("d_8", 1, 12, "B", "FEAST", 1, 0), ("d_9", 2, 1, "X", None, 1, 1)],
        "d string, wday int, month int, state_id string, event_name_1 string, snap_A int, snap_B int",
    )
    out = ft.add_calendar_features(df).orderBy("day_num").collect()
    assert [r["day_num"] for r in out] == [7, 8, 9]
    assert [r["is_event"] for r in out] == [0, 1, 0]
    assert [r["snap"] for r in out] == [1, 0, 0]
    assert out[1]["wday_sin"] == pytest.approx(math.sin(2 * math.pi / 7))
    assert out[0]["month_cos"] == pytest.approx(0.0, abs=1e-12)
    plain = ft.add_calendar_features(df.select("d", "wday", "month")).first()
    assert (plain["is_event"], plain["snap"]) == (0, 0)


def test_price_momentum(spark):
    rows = [("S", "I", i, p) for i, p in enumerate([None, 0.0, 2.0, 2.0, 3.0, None])]
    df = spark.createDataFrame(rows, "store_id string, item_id string, day_num int, sell_price double")
    assert values(ft.add_price_momentum(df), "price_momentum") == [0.0, 0.0, 0.0, 0.0, 0.5, 0.0]
    assert values(ft.add_price_momentum(df, step=2), "price_momentum")[4] == 0.5
    assert ft.add_price_momentum(df.drop("sell_price")).columns == df.drop("sell_price").columns


def test_burn_in_drops_the_largest_lag(spark):
    df = ft.add_lags(random_panel(spark, n_days=35))
    assert df.count() - ft.drop_burn_in(df).count() == 28 * 24


def test_one_series_exchange_and_no_python(spark):
    df = random_panel(spark).withColumns({"d": F.concat(F.lit("d_"), "day_num"), "wday": F.lit(1), "month": F.lit(1)})
    plan = ft.build_features(df)._jdf.queryExecution().sparkPlan().toString()
    executed = ft.build_features(df)._jdf.queryExecution().executedPlan().toString()
    assert executed.count("Exchange hashpartitioning(store_id") == 1
    assert "Python" not in plan


def test_clip_and_half_even(spark):
    df = spark.createDataFrame([(-1.0,), (0.125,), (0.375,), (2.5,)], "p double")
    out = [r[0] for r in df.select(round_cents(clip_at_zero(F.col("p")))).collect()]
    assert out == [0.0, 0.12, 0.38, 2.5]


def test_rolling_of_large_values(spark):
    out = ft.add_rolling(series_frame(spark, [2_000_000_000] * 6), [3])
    assert values(out, "sales_rmean_3", "sales_rstd_3")[-1] == (2e9, 0.0)


@pytest.mark.parametrize("kind", ["int", "long"])
def test_rolling_keeps_the_deviation_of_large_neighbours(spark, kind):
    sales = [1_000_000_000, 1_000_000_001, 1_000_000_003, -2_000_000_000, 2_000_000_000, 7, 46_341, 46_340]
    df = series_frame(spark, sales).withColumn("sales", F.col("sales").cast(kind))
    out = ft.add_rolling(df, [2, 3, 60])
    for k in (2, 3, 60):
        for i, (mean, std) in enumerate(values(out, f"sales_rmean_{k}", f"sales_rstd_{k}")):
            before = sales[max(0, i - k) : i]
            assert mean == (pytest.approx(statistics.mean(before), rel=1e-15) if before else None)
            assert std == (pytest.approx(statistics.stdev(before), rel=1e-12) if len(before) > 1 else None)
