import pytest
from pyspark.sql import functions as F

from stratacast.operators import panel as pa
from stratacast.plans import pipeline as pl
from stratacast.sources.retail import WEEKLY_PRICE, Retail, first_day_of_week, last_day_of_week, week_of
from tests.helpers import series_frame, values


def wide(spark, days=(1, 2, 3)):
    ids = "id string, state_id string, store_id string, cat_id string, dept_id string, item_id string"
    cols = ", ".join(f"d_{n} int" for n in days)
    rows = [("i1", "A", "S1", "C", "D", "I1", *days), ("i2", "A", "S1", "C", "D", "I2", *[0] * len(days))]
    return spark.createDataFrame(rows, f"{ids}, {cols}")


def test_slice_and_unpivot(spark):
    long = pa.wide_to_long(pa.slice_window(wide(spark), 2, 3))
    assert long.columns[-3:] == ["d", "day_num", "sales"]
    assert values(long.where("id = 'i1'"), "d", "day_num", "sales") == [("d_2", 2, 2), ("d_3", 3, 3)]
    assert long.count() == 4


def test_missing_window_day_raises(spark):
    with pytest.raises(ValueError, match="d_4"):
        pa.slice_window(wide(spark), 1, 4)


def test_pivot_is_the_inverse(spark):
    w = wide(spark)
    back = pa.pivot_series(pa.wide_to_long(w), [1, 2, 3])
    assert sorted(back.collect()) == sorted(w.select(back.columns).collect())
    assert pa.pivot_series(pa.wide_to_long(w), [3, 4], fill=0).where("id = 'i1'").first()["d_4"] == 0


@pytest.mark.parametrize("days", [[2], [2, 5], [5, 9], [9], [-3], [-3, 4], [1, 2, 3, 4, 5, 6]])
def test_densify_fills_each_day_once(spark, days):
    rows = [("S", "I", d, d + 100) for d in days]
    sales = spark.createDataFrame(rows, "store_id string, item_id string, day_num int, sales int")
    got = dict(values(pa.densify(sales, 1, 6), "day_num", "sales"))
    assert got == {d: (d + 100 if d in days else 0) for d in range(1, 7)}
    assert pa.densify(sales, 1, 6).count() == 6


def test_densify_keeps_the_type(spark):
    sales = spark.createDataFrame([("S", "I", 2, 1.75)], "store_id string, item_id string, day_num int, sales double")
    assert values(pa.densify(sales, 1, 3), "sales") == [0.0, 1.75, 0.0]


def test_series_silent_in_the_window_is_a_gap(spark):
    df = series_frame(spark, [1])
    assert pa.count_gaps(df, 5, 9).first()["missing_days"] == 5


def test_gap_check(spark):
    df = series_frame(spark, [1, 2, 3]).where("day_num <> 2")
    assert pa.count_gaps(df, 1, 3).first()["missing_days"] == 1
    assert pa.count_gaps(pa.densify(df, 1, 3), 1, 3).count() == 0


def test_calendar_and_price_joins(spark):
    cal = spark.createDataFrame(
        [("d_1", 1, None), ("d_2", 2, "FEAST")], "d string, wm_yr_wk int, event_name_1 string"
    )
    prices = spark.createDataFrame([("S1", "I1", 1, 2.5)], "store_id string, item_id string, wm_yr_wk int, sell_price double")
    sales = series_frame(spark, [1, 2, 3]).drop("sell_price").withColumn("d", F.concat(F.lit("d_"), "day_num"))
    got = values(pa.build_panel(sales, cal, prices), "event_name_1", "sell_price")
    assert got == [("NoEvent", 2.5), ("FEAST", None), (None, None)]
    assert values(pa.fill_price(pa.build_panel(sales, cal, prices)), "sell_price") == [2.5, 0.0, 0.0]
    assert values(pa.fill_price(sales), "sell_price") == [1.0, 1.0, 1.0]


FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("window", [None, 70])
def test_prices_of_one_pass_equal_the_joined_ones(spark, window):
    r = Retail.open(spark, FOLDER, window)
    dense = pa.densify(r.sales, r.window_from, r.last_day).withColumn("wm_yr_wk", week_of(F.col("day_num")))
    joined = pa.attach_prices(dense, r.prices)
    cols = ["store_id", "item_id", "day_num", "sales", "wm_yr_wk", "sell_price"]
    one_pass = pl.retail_priced(r).select(*cols)
    assert one_pass.count() == joined.count()
    assert one_pass.exceptAll(joined.select(*cols)).count() == 0
    assert one_pass.where("sell_price IS NOT NULL").count() > 0


def test_panel_reads_and_moves_the_lines_once(spark):
    plan = pl.retail_panel(Retail.open(spark, FOLDER))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("lineitem.parquet") == 1
    assert plan.count("Exchange hashpartitioning(store_id") == 1
    assert "SortMergeJoin" not in plan and "Python" not in plan


def test_value_steps_add_up_to_the_value_of_each_day(spark):
    rows = [("S", "I", w, p) for w, p in ((1, 2.0), (2, 2.0), (3, 5.0), (6, 1.0), (7, None), (8, 0.0), (9, 4.0))]
    rows += [("S", "J", 2, 3.0), ("S", "K", 1, 9.0)]
    df = spark.createDataFrame(rows, "store_id string, item_id string, week int, price double")
    first, last = (lambda w: (w - 1) * 7 + 1), (lambda w: w * 7)
    steps = pa.value_steps(df, first, last, 10, 60, "week", "price", ("store_id", "item_id"))
    told = [tuple(r) for r in steps.collect()]
    for item in "IJK":
        for day in range(10, 61):
            want = {w: p or 0.0 for s, i, w, p in rows if i == item}.get((day - 1) // 7 + 1, 0.0)
            assert sum(step for _, i, d, step in told if i == item and d <= day) == want, (item, day)
    assert all(10 <= d <= 60 and step != 0 for _, _, d, step in told)
    # Equal prices of adjoining weeks cost nothing.
    assert len([t for t in told if t[1] == "I"]) == 6


def test_weeks_cover_their_days():
    assert [first_day_of_week(11101), last_day_of_week(11101)] == [1, 7]
    assert WEEKLY_PRICE.column == "wm_yr_wk"
