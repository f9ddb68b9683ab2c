import pytest
from pyspark.sql import functions as F

from stratacast.operators import forecasting as fc
from stratacast.operators import hierarchy as hi
from stratacast.operators import quality as qu
from stratacast.operators import reports as rp
from stratacast.sources import tables
from stratacast.split import Split
from tests.helpers import random_panel, series_frame, values


def test_key_coverage(spark):
    left = spark.createDataFrame([(1,), (2,), (2,), (None,)], "k int")
    right = spark.createDataFrame([(2,), (3,), (4,)], "k int")
    r = qu.key_coverage(left, right, "k").first()
    assert (r["n_left"], r["n_right"], r["n_overlap"], r["left_only"], r["right_only"], r["keys_match"]) == (2, 3, 1, 1, 2, False)
    assert [x[0] for x in qu.keys_only_in(left.dropna(), right, ["k"]).collect()] == [1]


def test_nulls_and_profile(spark):
    df = spark.createDataFrame([(1, "a", None), (2, None, None), (2, "a", 1.5)], "n int, t string, x double")
    got = {r["column_name"]: (r["nulls"], round(r["pct"], 2)) for r in qu.null_audit({"d": df}).collect()}
    assert got == {"t": (1, 33.33), "x": (2, 66.67)}
    profile = {r["column_name"]: (r["dtype"], r["nulls"], r["n_distinct"]) for r in qu.column_profile(df).collect()}
    assert profile == {"n": ("int", 0, 2), "t": ("string", 1, 1), "x": ("double", 2, 1)}
    types = {r["dtype"]: r["n_columns"] for r in qu.dtype_summary({"d": df}).collect()}
    assert types == {"int": 1, "string": 1, "double": 1}


def test_narrowing(spark):
    rows = [(100, 40000, 2**40, 1.25, "a")] * 3 + [(-100, 1, 1, 1e300, "b")]
    df = spark.createDataFrame(rows, "a long, b long, c long, x double, t string")
    plan = {r["column_name"]: r["to_type"] for r in qu.narrowing_plan(df).collect()}
    assert plan == {"a": "tinyint", "b": "int", "c": "bigint", "x": "double", "t": "string"}
    flags = {r["column_name"]: r["is_categorical"] for r in qu.narrowing_plan(df).collect()}
    assert not flags["t"] and not flags["a"]
    narrow = qu.narrow_schema(df)
    assert dict(narrow.dtypes)["a"] == "tinyint"
    assert sorted(narrow.collect()) == sorted(df.collect())


def test_dataset_report_total(spark):
    df = spark.createDataFrame([(1, "aa"), (2, "aa"), (3, "aa")], "n long, t string")
    rows = {r["table_name"]: r for r in qu.dataset_report({"one": df, "two": df}).collect()}
    assert (rows["one"]["bytes_before"], rows["one"]["bytes_after"]) == (3 * 8 + 6, 3 + 3)
    assert rows["TOTAL"]["n_rows"] == 6


def test_window_presence(spark):
    df = series_frame(spark, [1, 1, 1])
    r = qu.window_presence(df, 2, 5).first()
    assert (r["found"], r["expected"], r["complete"]) == (2, 4, False)
    assert qu.wide_window_presence(spark.createDataFrame([(1, 2)], "d_1 int, d_3 int"), 1, 3) == (2, 3)
    assert qu.size_estimate(df, 500).first()["est_rows"] == 500


def test_hierarchy_cardinality_sample(spark):
    r = {x["column_name"]: x for x in hi.hierarchy_cardinality(random_panel(spark), n_sample=2).collect()}
    assert (r["store_id"]["n_distinct"], r["store_id"]["sample"]) == (4, "S0, S1")
    with pytest.raises(ValueError):
        hi.hierarchy_cardinality(random_panel(spark).drop("dept_id"))


def test_rankings(spark):
    scores = spark.createDataFrame([("pred_bu", 0.5), ("pred_td", 0.75), ("pred_mint", 0.5)], "method string, wrmsse double")
    coherence = scores.select("method", (1 - F.col("wrmsse")).alias("coherence_error"))
    ranks = {r["method"]: (r["rank_wrmsse"], r["rank_coherence"], r["pct_vs_base"]) for r in rp.method_ranks(scores, coherence).collect()}
    assert ranks == {"pred_bu": (1, 2, 0.0), "pred_mint": (1, 2, 0.0), "pred_td": (3, 1, 50.0)}
    assert rp.best_method(scores).first()["best_method"] == "pred_bu"


def test_top_items_breaks_ties_by_name(spark):
    df = random_panel(spark)
    assert values(rp.top_items(df, "S0", 2), "item_id", order="item_id") == ["D0_0", "D0_1"]


def test_last_value_skips_nulls(spark):
    df = spark.createDataFrame(
        [("S", "I", 1, 5.0), ("S", "I", 2, None)], "store_id string, item_id string, day_num int, x double"
    )
    last = fc.last_values(df)
    assert (last.first()["day_num"], last.first()["x"]) == (2, 5.0)
    assert values(fc.horizon_template(last, 3), "day_num", "x") == [(3, 5.0), (4, 5.0), (5, 5.0)]


def test_model_round_trip_and_horizon(spark, tmp_path):
    split = Split(1, 30, 31, 40)
    df = random_panel(spark).withColumn("sales_lag_1", F.col("sales") * 0.5)
    train, val = split.train(df), split.validation(df)
    model, preds, reused = fc.train_or_reuse(train, val, fc.linear_stage(5), str(tmp_path))
    assert not reused
    again, same, reused = fc.train_or_reuse(train.repartition(7).orderBy(F.rand(1)), val, fc.linear_stage(5), str(tmp_path))
    assert reused and again.spreads == model.spreads
    assert preds.count() == val.count() and sorted(same.collect()) == sorted(preds.collect())
    assert preds.where("pred < 0 OR pred IS NULL").count() == 0
    assert again.inputs == model.inputs
    unseen = val.withColumn("item_id", F.lit("new")).drop("sales_lag_1")
    assert model.predict(unseen).where("pred IS NULL").count() == 0
    out = fc.horizon_forecast(again, fc.horizon_template(fc.last_values(df)))
    assert out.count() == 24 * 28
    one = fc.forecast_of(out, "S0", "D0_0").first()
    assert (one["horizon_days"], len(one["forecasts"])) == (28, 28)
    assert fc.forecast_of(out, "S0", "nothing").count() == 0


def test_tree_importance(spark, tmp_path):
    df = random_panel(spark).withColumn("hint", F.col("sales") * 2.0)
    stage = fc.tree_stage(n_trees=2, depth=2)
    model = fc.train(df, stage, str(tmp_path / "means"))
    assert fc.top_features(model.feature_importance(), 1).first()["feature"] == "hint"


def test_models_are_reused_for_the_same_rows_and_settings_only(spark, tmp_path):
    split = Split(1, 30, 31, 40)
    df = random_panel(spark)
    train, val = split.train(df), split.validation(df)
    one = F.col("day_num") == 3
    changed = train.withColumn("sales", F.when(one & (F.col("store_id") == "S0"), F.col("sales") + 1).otherwise(F.col("sales")))
    twice = train.union(train.limit(1))
    nulled = train.withColumn("sell_price", F.when(F.col("day_num") != 5, F.col("sell_price")))
    prints = [fc.fingerprint(x, fc.linear_stage(5)) for x in (train, train.repartition(5), changed, twice, nulled)]
    assert prints[0] == prints[1] and len(set(prints)) == 4
    assert fc.fingerprint(train, fc.linear_stage(6)) != prints[0]
    runs = [(train, 5), (train, 5), (changed, 5), (changed, 6), (changed, 6)]
    assert [fc.train_or_reuse(t, val, fc.linear_stage(n), str(tmp_path))[2] for t, n in runs] == [False, True, False, False, True]


def test_linear_importance_does_not_depend_on_units(spark, tmp_path):
    df = random_panel(spark).withColumn("sales_lag_1", F.col("sales") * 0.5 + F.col("day_num") % 3)
    found = []
    for n, factor in enumerate((1.0, 1000.0)):
        model = fc.train(df.withColumn("sales_lag_1", F.col("sales_lag_1") * factor), fc.linear_stage(25), str(tmp_path / f"m{n}"))
        found.append({r["feature"]: r["importance"] for r in model.feature_importance().collect()})
    assert found[0]["sales_lag_1"] == pytest.approx(found[1]["sales_lag_1"], rel=0.02)


def test_forecasts_are_found_in_one_folder(spark, tmp_path):
    path = str(tmp_path / "f")
    rows = random_panel(spark, n_days=3).select("store_id", "item_id", F.col("day_num").alias("h"), F.col("sell_price").alias("forecast"))
    tables.write_forecasts(rows, path, groups=16)
    known = tables.forecast_rows(spark, path, "S1", "D0_2", groups=16)
    assert sorted(r["h"] for r in known.collect()) == [1, 2, 3]
    assert tables.forecast_rows(spark, path, "S1", "nothing", groups=16).count() == 0
    scan = known._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(series_group" in scan


def test_column_facts_of_wide_tables(spark):
    days = ", ".join(f"{n % 5 if n % 7 else 'NULL'} AS d_{n}" for n in range(300))
    wide = spark.sql(f"SELECT 'é' || id AS id, id % 3 AS g, id / 4.0D AS x, DATE '2024-01-01' AS day, {days} FROM range(40)")
    empty = wide.limit(0)
    facts = {(r["table_name"], r["column_name"]): r for r in qu.column_facts({"wide": wide.repartition(4), "empty": empty}).collect()}
    assert len(facts) == 2 * 304
    r = facts["wide", "id"]
    assert (r["position"], r["dtype"], r["n_rows"], r["nulls"], r["n_distinct"], r["text_bytes"]) == (1, "string", 40, 0, 40, 10 * 3 + 30 * 4)
    assert (facts["wide", "g"]["min_value"], facts["wide", "g"]["max_value"], facts["wide", "g"]["n_distinct"]) == (0, 2, 3)
    assert (facts["wide", "d_7"]["nulls"], facts["wide", "d_7"]["n_distinct"], facts["wide", "d_7"]["min_value"]) == (40, 0, None)
    assert (facts["wide", "day"]["n_distinct"], facts["wide", "day"]["max_value"]) == (1, None)
    assert (facts["empty", "id"]["n_rows"], facts["empty", "id"]["nulls"], facts["empty", "id"]["n_distinct"]) == (0, 0, 0)
    plan = {r["column_name"]: r["to_type"] for r in qu.narrowing(qu.column_facts({"wide": wide})).collect()}
    assert (plan["g"], plan["x"], plan["day"], plan["id"]) == ("tinyint", "float", "date", "string")
    report = {r["table_name"]: r for r in qu.dataset_sizes(qu.column_facts({"wide": wide, "empty": empty})).collect()}
    want = {r["table_name"]: r for r in qu.dataset_report({"wide": wide, "empty": empty}).collect()}
    assert {k: (r["n_rows"], r["n_columns"], r["bytes_before"]) for k, r in report.items()} == {
        k: (r["n_rows"], r["n_columns"], r["bytes_before"] or 0) for k, r in want.items()
    }
