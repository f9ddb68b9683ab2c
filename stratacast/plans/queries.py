"""One runnable query per operator, over the retail tables of a folder.

Queries read the whole history. Those marked ``windowed`` take its last 500
days, the slice that the batch phases cut for the panel, its features and the
models: their operator is the slice, or they return or train on a row per
series and day of it. Computed fractions are rounded to six decimals so that
results compare across engines.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratacast.constants import HIERARCHY_COLS, LAGS, LEVELS, METHOD_NAMES, ROLLING_WINDOWS, SERIES_COLS, WINDOW_DAYS
from stratacast.functions.columns import clip_at_zero, round_cents
from stratacast.operators import boosting as bo
from stratacast.operators import features as ft
from stratacast.operators import forecasting as fc
from stratacast.operators import hierarchy as hi
from stratacast.operators import metrics as me
from stratacast.operators import panel as pa
from stratacast.operators import quality as qu
from stratacast.operators import reconcile as rc
from stratacast.operators import reports as rp
from stratacast.plans import increments as inc
from stratacast.plans import pipeline as pl
from stratacast.session import scratch_path, tune
from stratacast.sources import runlog, tables
from stratacast.sources.retail import Retail, first_day_of_week, last_day_of_week, state_names

STORE = "NATION_1"
ITEM = "Brand#1|ECONOMY"
KEYS = list(HIERARCHY_COLS)
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def _register(build: Callable[[Retail], DataFrame], window_days: int | None):
    @wraps(build)
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return _rounded(build(Retail.open(tune(spark), folder, window_days)))

    QUERIES[build.__name__] = run
    return run


def query(build: Callable[[Retail], DataFrame]):
    """Register a function of the retail tables under its own name."""
    return _register(build, None)


def windowed(build: Callable[[Retail], DataFrame]):
    """The same over the sliding window of the batch phases."""
    return _register(build, WINDOW_DAYS)


def _round6(value):
    """Six decimals; the nudge keeps summation noise from deciding exact halves."""
    return F.round(value + F.signum(value) * F.lit(1e-10), 6) + F.lit(0.0)


def _rounded(df: DataFrame) -> DataFrame:
    # Adding 0.0 turns a negative zero into a plain one.
    fractions = (T.DoubleType, T.FloatType)
    return df.select(
        *[_round6(F.col(f"`{f.name}`")).alias(f.name) if isinstance(f.dataType, fractions) else f"`{f.name}`" for f in df.schema]
    )


# Panel construction


@windowed
def panel_long(r: Retail) -> DataFrame:
    cols = ("store_id", "item_id", "day_num", "sales", "wm_yr_wk", "wday", "event_name_1", "sell_price")
    return pl.retail_panel(r).select(*cols)


@windowed
def unpivot_wide(r: Retail) -> DataFrame:
    """The wide table, sliced to the window and turned back to long."""
    wide = wide_sales(r, r.window_from, r.last_day)
    return pa.wide_to_long(pa.slice_window(wide, r.window_from, r.last_day)).select("id", "d", "day_num", "sales")


def wide_sales(r: Retail, lo: int, hi: int) -> DataFrame:
    ids = F.concat_ws("_", "item_id", "store_id").alias("id")
    return pa.pivot_series(r.sales.select(ids, *KEYS, "day_num", "sales"), range(lo, hi + 1), fill=0)


@query
def panel_gaps(r: Retail) -> DataFrame:
    """Days each series lacks before gaps are filled."""
    return pa.count_gaps(r.sales, r.window_from, r.last_day)


@query
def price_join_coverage(r: Retail) -> DataFrame:
    return qu.price_gaps(pl.retail_panel(r))


# Features


@windowed
def lag_features(r: Retail) -> DataFrame:
    out = ft.drop_burn_in(ft.add_lags(pl.retail_sales(r)))
    return out.select(*SERIES_COLS, "day_num", *[f"sales_lag_{k}" for k in LAGS])


@windowed
def rolling_features(r: Retail) -> DataFrame:
    out = ft.add_rolling(pl.retail_sales(r))
    return out.select(*SERIES_COLS, "day_num", *[f"sales_{s}_{k}" for k in ROLLING_WINDOWS for s in ("rmean", "rstd")])


@query
def calendar_features(r: Retail) -> DataFrame:
    """Calendar features of every day of the history in every state."""
    states = F.array(*[F.lit(s) for s in state_names(r.spark, r.folder)])
    days = pa.name_missing_events(r.calendar).withColumn("state_id", F.explode(states))
    cols = ("wday_sin", "wday_cos", "month_sin", "month_cos", "is_event", "snap")
    return ft.add_calendar_features(days).select("d", "state_id", "day_num", *cols)


@windowed
def price_momentum(r: Retail) -> DataFrame:
    panel = ft.add_price_momentum(pl.retail_priced(r))
    return panel.select(*SERIES_COLS, "day_num", "sell_price", "price_momentum")


@query
def feature_table(r: Retail) -> DataFrame:
    """The whole feature pipeline, summed up per store and day."""
    return _per_store_and_day(pl.retail_features(r))


def _per_store_and_day(features: DataFrame) -> DataFrame:
    engineered = [f"sales_lag_{k}" for k in LAGS]
    engineered += [f"sales_{s}_{k}" for k in ROLLING_WINDOWS for s in ("rmean", "rstd")]
    engineered += ["wday_sin", "wday_cos", "month_sin", "month_cos", "is_event", "snap", "price_momentum"]
    return features.groupBy("store_id", "day_num").agg(
        F.count("*").alias("n_rows"), F.sum("sales").alias("sales"), *[F.sum(c).alias(c) for c in engineered]
    )


@query
def train_val_split(r: Retail) -> DataFrame:
    features = ft.drop_burn_in(ft.add_lags(pl.retail_sales(r)))
    split = r.split(burn_in=max(LAGS))
    part = F.when(F.col("day_num") < split.val_from, "train").otherwise("validation")
    return features.groupBy(part.alias("part")).agg(
        F.count("*").alias("n_rows"), F.min("day_num").alias("first_day"), F.max("day_num").alias("last_day")
    )


# Hierarchy and scores


@query
def level_aggregate(r: Retail) -> DataFrame:
    """Daily sums at all levels; days without a sale of the level have no row."""
    return hi.aggregate_levels(r.sales, ["sales"])


@query
def store_dept_daily(r: Retail) -> DataFrame:
    """One level on its own, per day."""
    return hi.aggregate_level(r.sales, ["store_id", "dept_id"], ["sales"])


@query
def price_of_levels(r: Retail) -> DataFrame:
    """Summed price of the levels on the days on which it changes, from the steps of the series."""
    split = r.split(burn_in=max(LAGS))
    steps = pa.value_steps(r.priced_sales, first_day_of_week, last_day_of_week, split.train_from, split.train_to)
    daily = hi.aggregate_levels(steps, ["price_step"])
    upto = Window.partitionBy("level", *KEYS).orderBy("day_num").rowsBetween(Window.unboundedPreceding, 0)
    return daily.select("level", *KEYS, "day_num", F.sum("price_step").over(upto).alias("price")).where("level <= 9")


@query
def series_scale(r: Retail) -> DataFrame:
    return pl.retail_study(r).series().select("level", *KEYS, "scale")


@query
def series_weights(r: Retail) -> DataFrame:
    return me.series_weights(pl.retail_study(r).series()).select("level", *KEYS, "weight")


@query
def revenue_weights(r: Retail) -> DataFrame:
    """Weights from price times sales of the bottom series."""
    return me.series_weights(pl.retail_study(r).series(weights="revenue")).select("level", *KEYS, "weight")


@query
def series_rmsse(r: Retail) -> DataFrame:
    study = pl.retail_study(r)
    series = study.series()
    return series.select("level", *KEYS, me.rmsse(series, study.split).alias("rmsse"))


@query
def wrmsse_levels(r: Retail) -> DataFrame:
    study = pl.retail_study(r)
    return me.wrmsse_levels(study.series(), study.split).drop("method")


@query
def wrmsse_overall(r: Retail) -> DataFrame:
    study = pl.retail_study(r)
    levels = me.wrmsse_levels(study.series(), study.split)
    return me.wrmsse_overall(levels).select(F.col("wrmsse").alias("wrmsse_overall"))


@query
def unmatched_series(r: Retail) -> DataFrame:
    """Series that only one side of the split has when rows without sales are left out."""
    split = r.split(burn_in=max(LAGS))
    sold = r.sales.withColumn("pred", F.col("sales"))
    series = me.score_series(sold, split)
    return me.unmatched(series).groupBy("level", "missing_in").agg(F.count("*").alias("n_series"))


# Reconciliation


def _validation(r: Retail) -> tuple[DataFrame, object]:
    """Validation rows with the forecast, unstored: read once."""
    return pl.retail_validation(r), r.split(burn_in=max(LAGS))


@query
def bottom_up_levels(r: Retail) -> DataFrame:
    val, _ = _validation(r)
    return hi.aggregate_levels(rc.bottom_up(val), ["pred_bu"])


@query
def hist_proportions(r: Retail) -> DataFrame:
    split = r.split(burn_in=max(LAGS))
    train = pl.sparse_training(r.priced_sales, split)
    return rc.historical_proportions(train, n_days=split.train_days)


@query
def top_down(r: Retail) -> DataFrame:
    s = pl.retail_study(r)
    return rc.top_down(s.train, s.val, s.split, n_days=s.split.train_days).select(*SERIES_COLS, "day_num", "pred_td")


@query
def within_dept_proportions(r: Retail) -> DataFrame:
    split = r.split(burn_in=max(LAGS))
    train = pl.sparse_training(r.priced_sales, split)
    return rc.within_dept_proportions(train, n_days=split.train_days)


@query
def summing_membership(r: Retail) -> DataFrame:
    return hi.summing_membership(rc.bottom_nodes(r.sales))


@query
def base_forecasts(r: Retail) -> DataFrame:
    val, _ = _validation(r)
    return rc.base_forecasts(val)


@query
def mintrace_coherent(r: Retail) -> DataFrame:
    s = pl.retail_study(r)
    return rc.mintrace_ols(s.train, s.val, s.split, n_days=s.split.train_days).select(*SERIES_COLS, "day_num", "pred_mint")


def _whole_units(base: DataFrame) -> DataFrame:
    # The inner rounding removes summation noise, which would decide halves.
    return base.withColumn("yhat", F.round(F.round("yhat", 9)))


@query
def mintrace_incoherent(r: Retail) -> DataFrame:
    """Base forecasts rounded to whole units at every level, so that levels disagree."""
    val, split = _validation(r)
    val = pl.stored(val, "validation")
    base = pl.stored(_whole_units(rc.base_forecasts(val)), "base")
    solved = rc.project_ols(base, rc.bottom_nodes(val), split)
    return solved.select("store_id", "dept_id", "day_num", F.col("x").alias("reconciled"))


@query
def coherence_error(r: Retail) -> DataFrame:
    return rp.display_method(me.coherence_error(pl.retail_reconciled(r).val, pl.METHODS))


@query
def coherence_of_levels(r: Retail) -> DataFrame:
    """Disagreement of forecasts rounded on their own at store and department level."""
    val, _ = _validation(r)
    base = _whole_units(rc.base_forecasts(val)).withColumnRenamed("yhat", "pred")
    store = base.where("node_level = 'store'")
    below = base.where("node_level = 'store_dept'")
    return me.coherence_between(store, below, ["store_id"], ["pred"]).drop("method")


# Error measures and drill-down


@query
def rmse(r: Retail) -> DataFrame:
    return me.rmse(_validation(r)[0])


@query
def store_report(r: Retail) -> DataFrame:
    return rp.store_report(_validation(r)[0])


@query
def national_daily(r: Retail) -> DataFrame:
    return rp.national_daily(_validation(r)[0])


@query
def state_daily(r: Retail) -> DataFrame:
    return rp.state_daily(_validation(r)[0])


@query
def state_coherence(r: Retail) -> DataFrame:
    return rp.state_coherence(_validation(r)[0])


@query
def sku_series(r: Retail) -> DataFrame:
    return rp.sku_series(_validation(r)[0], STORE, ITEM)


@query
def top_items(r: Retail) -> DataFrame:
    return rp.top_items(r.sales, STORE)


@query
def sorted_stores(r: Retail) -> DataFrame:
    return rp.sorted_stores(r.sales)


@query
def pred_range(r: Retail) -> DataFrame:
    return rp.display_method(me.prediction_range(pl.retail_reconciled(r).val, pl.METHODS))


# Comparison of methods


def _study(r: Retail) -> tuple[DataFrame, DataFrame]:
    levels, coherence = pl.retail_reconciled(r).scores()
    # Reports read the 48 score rows several times.
    return pl.stored(levels, "scores"), coherence


@query
def leaderboard(r: Retail) -> DataFrame:
    levels, coherence = _study(r)
    levels, coherence = rp.display_method(levels), rp.display_method(coherence)
    return rp.leaderboard(levels, coherence, list(METHOD_NAMES.values()))


@query
def best_per_level(r: Retail) -> DataFrame:
    # The baseline equals bottom-up, so the three reconciled forecasts compete.
    levels, _ = _study(r)
    levels = _comparable(rp.display_method(levels.where("method <> 'pred'")))
    return rp.best_per_level(levels)


def _comparable(df: DataFrame) -> DataFrame:
    """Scores that agree to six decimals tie, so that the name decides."""
    return df.withColumn("wrmsse", _round6(F.col("wrmsse")))


@query
def best_method(r: Retail) -> DataFrame:
    levels, _ = _study(r)
    return rp.best_method(_comparable(rp.display_method(me.wrmsse_overall(levels.where("method <> 'pred'")))))


@query
def method_ranks(r: Retail) -> DataFrame:
    levels, coherence = _study(r)
    overall = _comparable(me.wrmsse_overall(levels.where("method <> 'pred'")))
    # In exact arithmetic every coherence error is 0; the rounding residue is not ranked.
    exact = coherence.withColumn("coherence_error", _round6(F.col("coherence_error")))
    return rp.display_method(rp.method_ranks(overall, exact))


@windowed
def metrics_report(r: Retail) -> DataFrame:
    """The study written to the run log and reported from it."""
    split = r.split(burn_in=max(LAGS))
    rows = pl.stored(pl.retail_predicted(r), "predicted")
    log = scratch_path(r.spark, "runlog")
    pl.run_study(rows, split, lambda train, val: val, log, {"n_features": 1})
    scores = runlog.scores(runlog.read(r.spark, log)).where("method <> 'Baseline'")
    return rp.metrics_report(scores.withColumn("value", _round6(F.col("value"))))


@query
def run_log_roundtrip(r: Retail) -> DataFrame:
    study = pl.retail_study(r)
    log = scratch_path(r.spark, "runlog")
    runlog.append(runlog.metric_rows(me.wrmsse_levels(study.series(), study.split)), log)
    runlog.append(runlog.param_rows(r.spark, "baseline_lgbm_sku", {"horizon": study.split.horizon}), log)
    read = runlog.read(r.spark, log)
    return read.select("run_name", "kind", "key", F.col("value").cast("double").alias("value"))


# Audit


def _audited(r: Retail) -> dict[str, DataFrame]:
    return {"calendar": r.calendar, "sales": r.sales, "sell_prices": r.prices}


@query
def null_audit(r: Retail) -> DataFrame:
    return qu.null_audit(_audited(r))


@query
def column_profile(r: Retail) -> DataFrame:
    return qu.column_profile(r.calendar.drop("date")).unionByName(qu.column_profile(r.sales)).unionByName(
        qu.column_profile(r.prices)
    )


@query
def dtype_summary(r: Retail) -> DataFrame:
    """Columns and nulls per type over the three tables."""
    profile = column_profile.__wrapped__(r)
    return profile.groupBy("dtype").agg(F.count("*").alias("n_columns"), F.sum("nulls").alias("nulls"))


@query
def narrow_schema(r: Retail) -> DataFrame:
    return qu.narrowing_plan(r.prices).unionByName(qu.narrowing_plan(r.sales))


@query
def dataset_report(r: Retail) -> DataFrame:
    return qu.dataset_report({"sales": r.sales, "sell_prices": r.prices})


@query
def hierarchy_cardinality(r: Retail) -> DataFrame:
    return hi.hierarchy_cardinality(r.sales)


@query
def hierarchy_info(r: Retail) -> DataFrame:
    return hi.hierarchy_info(r.sales)


@query
def series_count(r: Retail) -> DataFrame:
    return hi.count_series(r.sales)


@query
def store_state_map(r: Retail) -> DataFrame:
    return hi.store_state_map(r.sales)


@query
def key_coverage_days(r: Retail) -> DataFrame:
    return qu.key_coverage(r.sales.withColumn("d", F.concat(F.lit("d_"), "day_num")), r.calendar, "d")


@query
def key_coverage_stores(r: Retail) -> DataFrame:
    return qu.key_coverage(r.sales, r.prices, "store_id")


@query
def key_coverage_items(r: Retail) -> DataFrame:
    return qu.key_coverage(r.sales, r.prices, "item_id")


@query
def key_coverage_weeks(r: Retail) -> DataFrame:
    return qu.key_coverage(r.calendar, r.prices, "wm_yr_wk")


@windowed
def priced_never_sold_in_window(r: Retail) -> DataFrame:
    window = r.sales.where(F.col("day_num") >= r.window_from)
    return qu.keys_only_in(r.prices, window, SERIES_COLS)


@windowed
def window_presence(r: Retail) -> DataFrame:
    return qu.window_presence(r.sales, r.window_from, r.last_day)


@windowed
def size_estimate(r: Retail) -> DataFrame:
    return qu.size_estimate(r.sales, r.last_day - r.window_from + 1)


@windowed
def csv_load(r: Retail) -> DataFrame:
    """The five tables as CSV files, read back with their schemas."""
    folder = write_csv_tables(r, scratch_path(r.spark, "csv"))
    loaded = tables.load_all_data(r.spark, folder)
    result = None
    for name, df in loaded.items():
        numbers = [c for c, t in df.dtypes if t in ("int", "double")]
        cells = F.array(*[F.coalesce(F.col(f"`{c}`").cast("double"), F.lit(0.0)) for c in numbers])
        # Whole cents, so that the sum does not depend on the order of rows.
        total = F.round(F.aggregate(cells, F.lit(0.0), lambda a, b: a + b) * 100).cast("long")
        one = df.agg(F.count("*").alias("n_rows"), F.sum(total).alias("checksum")).select(
            F.lit(name).alias("table_name"), F.lit(len(df.columns)).cast("long").alias("n_columns"), "n_rows", "checksum"
        )
        result = one if result is None else result.unionByName(one)
    return result


def write_csv_tables(r: Retail, folder: str) -> str:
    """Write the derived tables under the file names the loaders expect."""
    evaluation = wide_sales(r, r.window_from, r.last_day)
    horizon = pa.day_columns(r.last_day - 27, r.last_day)
    written = {
        "calendar": r.calendar,
        "sales_validation": evaluation.drop(*horizon),
        "sales_evaluation": evaluation,
        "sell_prices": r.prices,
        "sample_submission": evaluation.select("id", *[F.lit(0.0).alias(f"F{h}") for h in range(1, 29)]),
    }
    for name, df in written.items():
        df.write.csv(f"{folder}/{tables.FILES[name]}", header=True)
    return folder


# Forecasting


@query
def clip_round(r: Retail) -> DataFrame:
    """Clipping and half-even rounding of a forecast that has negatives and ties."""
    val, _ = _validation(r)
    raw = F.col("sales") / 8 - 0.25
    return val.select(*SERIES_COLS, "day_num", clip_at_zero(raw).alias("clipped"), round_cents(clip_at_zero(raw)).alias("rounded"))


@query
def stored_predictions(r: Retail) -> DataFrame:
    """Forecasts written by key and joined back; negatives count 0."""
    val, _ = _validation(r)
    path = scratch_path(r.spark, "predictions")
    tables.write_predictions(val.withColumn("pred", F.col("sales") / 8 - 0.25), path)
    return tables.attach_predictions(val.drop("pred"), path).select(*SERIES_COLS, "day_num", "pred")


@query
def predictions_fallback(r: Retail) -> DataFrame:
    """Without stored forecasts the actual sales stand in."""
    val, _ = _validation(r)
    missing = scratch_path(r.spark, "absent")
    return tables.attach_predictions(val.drop("pred"), missing).select(*SERIES_COLS, "day_num", "pred")


@query
def stored_panel(r: Retail) -> DataFrame:
    """The panel written by store and read back."""
    path = scratch_path(r.spark, "panel")
    tables.write_panel(pl.retail_panel(r), path)
    return tables.read_parquet(r.spark, path).groupBy("store_id").agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum("sales").alias("sales"), F.count("sell_price").alias("n_prices")
    )


@query
def series_last(r: Retail) -> DataFrame:
    features = pl.retail_features(r).select(
        *SERIES_COLS, "day_num", "sales", "sell_price", "sales_lag_28", "sales_rmean_60", "price_momentum"
    )
    return fc.last_values(features)


@query
def horizon_template(r: Retail) -> DataFrame:
    last = fc.last_values(ft.add_lags(pl.retail_sales(r), (7,)).select(*SERIES_COLS, "day_num", "sales", "sales_lag_7"))
    return fc.horizon_template(last).select(*SERIES_COLS, "h", "day_num", "sales", "sales_lag_7")


def _trained(r: Retail, stage):
    """A model over the stored feature table, and both parts of the split."""
    features = pl.stored(pa.fill_price(pl.retail_features(r)), "features")
    split = r.split(burn_in=max(LAGS))
    train, val = split.train(features), split.validation(features)
    return fc.train(train, stage, scratch_path(r.spark, "means")), features, val


@windowed
def train_score(r: Retail) -> DataFrame:
    """The linear Tweedie model, its error per store."""
    model, _, val = _trained(r, fc.linear_stage())
    return rp.store_report(model.predict(val))


@windowed
def feature_importance_topk(r: Retail) -> DataFrame:
    """Inputs of the linear model by what one standard deviation of each moves."""
    model, _, _ = _trained(r, fc.linear_stage())
    return fc.top_features(model.feature_importance())


@windowed
def horizon_forecast(r: Retail) -> DataFrame:
    """28 days ahead for every series."""
    model, features, _ = _trained(r, fc.linear_stage())
    return fc.horizon_forecast(model, fc.horizon_template(fc.last_values(features)))


# Boosted trees. A round of depth 7 costs seven passes, so the queries grow fewer rounds than a study.
BOOSTED = bo.Settings(rounds=10)
FIRST_SPLIT_INPUTS = ("sales_lag_7", "sales_lag_14", "sales_lag_28", "wday", "month", "is_event", "snap")


@windowed
def boosted_first_gains(r: Retail) -> DataFrame:
    """Every split that the first root could take, and what it gains."""
    train = r.split(burn_in=max(LAGS)).train(pl.retail_features(r))
    gains = bo.first_round_gains(train, FIRST_SPLIT_INPUTS, bo.Settings(bins=255, row_share=1.0))
    # Gains are sums over all rows; their last digits depend on the order of summation.
    return gains.withColumn("gain", F.round(F.col("gain") + F.lit(1e-7), 3))


def _boosted(r: Retail) -> tuple[bo.BoostedModel, DataFrame]:
    features = pl.stored(pa.fill_price(pl.retail_features(r)), "features")
    split = r.split(burn_in=max(LAGS))
    model = bo.train_boosted(split.train(features), scratch_path(r.spark, "means"), BOOSTED)
    return model, split.validation(features)


@windowed
def boosted_score(r: Retail) -> DataFrame:
    """Boosted Tweedie trees, their error per store."""
    model, val = _boosted(r)
    return rp.store_report(model.predict(val))


@windowed
def boosted_importance(r: Retail) -> DataFrame:
    """The inputs that split most nodes, with the number of splits."""
    return fc.top_features(_boosted(r)[0].feature_importance())


# Phases in steps, stored layouts, reuse


@windowed
def features_in_steps(r: Retail) -> DataFrame:
    """The feature table from two batches of days, the second run twice, summed up per store and day."""
    panel, out, state = (scratch_path(r.spark, n) for n in ("panel", "features", "state"))
    days = r.split().val_from
    whole = pl.retail_panel(r)
    for first, last in ((r.window_from, days - 1), (days, r.last_day), (days, r.last_day)):
        inc.write_batch(whole.where(F.col("day_num").between(first, last)), panel, first, last)
        inc.extend_features(r.spark, panel, out, state, first, last)
    return _per_store_and_day(inc.read_batches(r.spark, out))


@query
def forecast_lookup(r: Retail) -> DataFrame:
    """The stored forecast of a known and of an unknown series; an unknown one has no steps."""
    last = pl.retail_validation(r).where(F.col("day_num") == r.last_day).select(*SERIES_COLS, "day_num", "pred")
    steps = fc.horizon_template(last).select(*SERIES_COLS, "h", "day_num", round_cents(F.col("pred")).alias("forecast"))
    path = scratch_path(r.spark, "forecasts")
    tables.write_forecasts(steps, path)
    result = None
    for store, item in ((STORE, ITEM), (STORE, "unknown")):
        asked = r.spark.createDataFrame([(store, item)], "store_id string, item_id string")
        one = asked.join(tables.forecast_rows(r.spark, path, store, item), list(SERIES_COLS), "left")
        result = one if result is None else result.unionByName(one)
    return result


@query
def model_reuse(r: Retail) -> DataFrame:
    """A model asked for again with the same rows in another order, and with one row changed."""
    rows = pl.stored(pl.retail_validation(r).withColumnRenamed("pred", "sales_rmean_28"), "validation")
    half = r.split().val_from + 14
    train, val = rows.where(F.col("day_num") < half), rows.where(F.col("day_num") >= half)
    one = (F.col("store_id") == STORE) & (F.col("item_id") == ITEM) & (F.col("day_num") == half - 1)
    changed = train.withColumn("sales", F.when(one, F.col("sales") + 1).otherwise(F.col("sales")))
    folder, result = scratch_path(r.spark, "model"), None
    for step, asked in (("first", train), ("reordered", train.repartition(5)), ("changed", changed)):
        _, preds, reused = fc.train_or_reuse(asked, val, fc.linear_stage(), folder)
        facts = asked.agg(F.count("*").alias("n_train"), F.sum("sales").alias("sales"))
        told = facts.select(F.lit(step).alias("step"), F.lit(reused).alias("reused"), "*", F.lit(preds.count()).alias("n_preds"))
        result = told if result is None else result.unionByName(told)
    return result


@query
def preview(r: Retail) -> DataFrame:
    """The first rows of the sales in the order of their keys."""
    return rp.preview(r.sales, 3, [*SERIES_COLS, "day_num"])


# Audit of the five tables, wide ones included


def _five_tables(r: Retail) -> dict[str, DataFrame]:
    evaluation = pl.stored(wide_sales(r, r.window_from, r.last_day), "wide")
    return {
        "calendar": r.calendar,
        "sales_validation": evaluation.drop(*pa.day_columns(r.last_day - 27, r.last_day)),
        "sales_evaluation": evaluation,
        "sell_prices": r.prices,
        "sample_submission": evaluation.select("id", *[F.lit(0.0).alias(f"F{h}") for h in range(1, 29)]),
    }


@windowed
def audit_columns(r: Retail) -> DataFrame:
    """Type, nulls, distinct values, range, text size and narrowest type of every column of the five tables."""
    return qu.narrowing(qu.column_facts(_five_tables(r)))


@windowed
def audit_datasets(r: Retail) -> DataFrame:
    """Rows, columns and bytes of the five tables before and after narrowing."""
    return qu.dataset_sizes(qu.column_facts(_five_tables(r)))
