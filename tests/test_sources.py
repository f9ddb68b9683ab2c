import pytest
from pyspark.sql import functions as F

from stratacast.operators import panel as pa
from stratacast.operators.features import build_features
from stratacast.plans import increments as inc
from stratacast.plans import pipeline as pl
from stratacast.plans.queries import write_csv_tables
from stratacast.session import broadcast_if_small, scratch_path
from stratacast.sources import runlog, tables
from stratacast.sources.retail import Retail
from stratacast.split import Split
from tests.helpers import random_panel, series_frame, values

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def retail(spark):
    return Retail.open(spark, FOLDER, window_days=70)


def test_scratch_lies_in_the_configured_folder(spark):
    assert scratch_path(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))


def test_broadcast_only_below_the_limit(spark):
    plan = lambda df: df._jdf.queryExecution().logical().toString()
    assert "broadcast" in plan(broadcast_if_small(spark.range(5), 5))
    assert "broadcast" not in plan(broadcast_if_small(spark.range(6), 5))


def test_csv_tables_through_all_phases(spark, retail, tmp_path):
    folder = write_csv_tables(retail, str(tmp_path / "csv"))
    loaded = tables.load_all_data(spark, folder)
    assert dict(loaded["calendar"].dtypes)["date"] == "date"
    assert dict(loaded["calendar"].dtypes)["snap_ASIA"] == "int"
    assert len(loaded["sales_evaluation"].columns) == 76
    last = retail.last_day - 28
    panel = pl.run_panel(spark, folder, str(tmp_path / "panel"), retail.window_from, last)
    n_series = loaded["sales_validation"].count()
    assert panel.count() == n_series * 42
    assert pa.count_gaps(panel, retail.window_from, last).count() == 0
    features = pl.run_features(spark, str(tmp_path / "panel"), str(tmp_path / "features"))
    assert features.count() == n_series * 14
    split = Split.at_end(retail.window_from + 28, last, horizon=7)
    log = str(tmp_path / "log")
    predict = lambda train, val: val.withColumn("pred", F.col("sales_rmean_7"))
    for _ in range(2):  # a repeated run replaces its own rows
        levels = pl.run_study(features, split, predict, log, {"alpha": 1}, run_id="0012")
    assert levels.count() == 48
    stored = runlog.read(spark, log)
    assert stored.where("kind = 'metric'").count() == 4 * 14 + 1
    assert stored.where("key = 'rmse' AND run_name = 'baseline_lgbm_sku'").count() == 1
    assert stored.where("key = 'description'").count() == 3
    params = {r["key"]: r["value"] for r in stored.where("kind = 'param'").collect()}
    assert params["alpha"] == "1" and int(params["val_rows"]) == n_series * 7
    assert [r[0] for r in stored.select("run_id").distinct().collect()] == ["0012"]


def test_report_shows_the_later_of_two_runs(spark, tmp_path):
    log = str(tmp_path / "log")
    for value in ("0.9", "0.5"):
        rows = spark.createDataFrame([("some_run", "metric", "wrmsse_overall", value)], runlog.ROW)
        runlog.append(rows, log)
    assert [r["value"] for r in runlog.scores(runlog.read(spark, log)).collect()] == [0.5]


def test_bad_csv_cell_raises(spark, tmp_path):
    (tmp_path / "p.csv").write_text("store_id,item_id,wm_yr_wk,sell_price\nS,I,1,abc\n")
    with pytest.raises(Exception, match="abc|MALFORMED"):
        tables.load_sell_prices(spark, str(tmp_path / "p.csv")).collect()


def test_missing_csv_column_raises(spark, tmp_path):
    spark.createDataFrame([("a", 1)], "store_id string, wm_yr_wk int").write.csv(str(tmp_path / "p"), header=True)
    with pytest.raises(ValueError, match="sell_price"):
        tables.load_sell_prices(spark, str(tmp_path / "p"))


def test_predictions_are_keyed(spark, tmp_path):
    val = series_frame(spark, [1, 2, 3])
    path = str(tmp_path / "preds")
    assert values(tables.attach_predictions(val, path), "pred") == [1.0, 2.0, 3.0]
    tables.write_predictions(val.withColumn("pred", F.col("day_num") - 2.0).orderBy(F.desc("day_num")), path)
    assert values(tables.attach_predictions(val, path), "pred") == [0.0, 0.0, 1.0]


def test_whole_history_is_the_default_of_none(spark):
    whole = Retail.open(spark, FOLDER)
    assert whole.window_days is None and whole.window_from == whole.first_day


def test_panel_layout(spark, tmp_path):
    tables.write_panel(random_panel(spark), str(tmp_path / "p"))
    assert tables.read_parquet(spark, str(tmp_path / "p")).count() == 24 * 40


def test_runs_without_an_id_are_different_runs(spark, tmp_path):
    rows = spark.createDataFrame([("r", "metric", "k", "1")], runlog.ROW)
    for _ in range(2):
        runlog.append(rows, str(tmp_path / "log"))
    assert runlog.read(spark, str(tmp_path / "log")).count() == 2


def test_bucketed_panel_feeds_windows_without_a_shuffle(spark, tmp_path):
    path = str(tmp_path / "p")
    df = random_panel(spark).withColumns({"d": F.concat(F.lit("d_"), "day_num"), "wday": F.lit(1), "month": F.lit(1)})
    tables.write_series_table(df, path, buckets=3)
    back = tables.read_series_table(spark, path)
    assert sorted(back.select(df.columns).collect()) == sorted(df.collect())
    plan = build_features(back)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Window" in plan
    files = [f for f in (tmp_path / "p").iterdir() if f.name.startswith("part-")]
    assert 0 < len(files) <= 3
    for f in files:
        rows = [(r["store_id"], r["item_id"], r["day_num"]) for r in spark.read.parquet(str(f)).collect()]
        assert rows == sorted(rows)
    # Written again, the table is replaced.
    tables.write_series_table(df.where("store_id = 'S0'"), path, buckets=3)
    assert tables.read_series_table(spark, path).count() == 6 * 40


def test_features_in_steps_equal_features_at_once(spark, retail, tmp_path):
    folder = write_csv_tables(retail, str(tmp_path / "csv"))
    first, last = retail.window_from, retail.last_day - 28
    cuts = [(first, first + 30), (first + 31, first + 31), (first + 32, last)]
    paths = {n: str(tmp_path / n) for n in ("panel", "features", "state")}
    for a, b in cuts:
        for _ in range(2):  # a repeated batch replaces itself
            inc.extend_panel(spark, folder, paths["panel"], a, b)
            inc.extend_features(spark, paths["panel"], paths["features"], paths["state"], a, b)
    at_once = pl.run_features_table(pl.run_panel(spark, folder, str(tmp_path / "once"), first, last))
    cols = sorted(at_once.columns)
    in_steps = inc.read_batches(spark, paths["features"])
    assert sorted(in_steps.columns) == cols
    assert in_steps.count() == at_once.count() > 0
    assert in_steps.select(cols).exceptAll(at_once.select(cols)).count() == 0
    state = spark.read.parquet(paths["state"]).where(F.col("upto") == first + 30)
    assert state.count() == 31 * loaded_series(spark, folder)
    with pytest.raises(ValueError, match="overlap"):
        inc.extend_panel(spark, folder, paths["panel"], first + 5, first + 40)
    with pytest.raises(ValueError, match="no state of day"):
        inc.extend_features(spark, paths["panel"], paths["features"], paths["state"], last + 5, last + 6)


def loaded_series(spark, folder):
    return tables.load_all_data(spark, folder)["sales_validation"].count()
