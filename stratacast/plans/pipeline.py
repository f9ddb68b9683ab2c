"""The three batch phases: panel, features, study. Each reads and writes Parquet."""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratacast.constants import HIERARCHY_COLS, LAGS, RUN_NAMES
from stratacast.operators.features import add_rolling, build_features, with_day_number
from stratacast.operators.hierarchy import check_dependencies
from stratacast.operators.metrics import coherence_error, combine, score_series, wrmsse_levels
from stratacast.operators.panel import (
    attach_calendar,
    build_panel,
    densify,
    fill_price,
    name_missing_events,
    slice_window,
    value_steps,
    wide_to_long,
)
from stratacast.operators.reconcile import reconcile_all
from stratacast.session import scratch_path
from stratacast.sources import runlog
from stratacast.sources.retail import WEEKLY_PRICE, Retail, first_day_of_week, last_day_of_week
from stratacast.sources.tables import SERIES_BUCKETS, load_all_data, read_series_table, write_series_table
from stratacast.split import Split

METHODS = tuple(RUN_NAMES)
NAIVE_WINDOW = 28


def stored(df: DataFrame, name: str, *partition_by: str) -> DataFrame:
    """Write to the shared folder and read back, where several jobs follow.

    Unlike a cache the table survives lost executors, and it is not recomputed.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.partitionBy(*partition_by).parquet(path)
    return df.sparkSession.read.parquet(path)


def run_panel(spark: SparkSession, csv_folder: str, out: str, first_day: int, last_day: int, buckets: int = SERIES_BUCKETS) -> DataFrame:
    """CSV tables to the long panel with calendar and prices, stored by series."""
    tables = load_all_data(spark, csv_folder)
    long = wide_to_long(slice_window(tables["sales_validation"], first_day, last_day))
    write_series_table(build_panel(long, tables["calendar"], tables["sell_prices"]), out, buckets)
    return read_series_table(spark, out)


def run_features(spark: SparkSession, panel_path: str, out: str, buckets: int = SERIES_BUCKETS) -> DataFrame:
    """Stored panel to the feature table, burn-in dropped; the windows read it as it lies."""
    write_series_table(run_features_table(read_series_table(spark, panel_path)), out, buckets)
    return read_series_table(spark, out)


def run_features_table(panel: DataFrame) -> DataFrame:
    """The feature table of a panel, not stored."""
    return build_features(panel)


def run_study(
    features: DataFrame,
    split: Split,
    predict: Callable[[DataFrame, DataFrame], DataFrame],
    log_path: str,
    params: dict[str, object] | None = None,
    run_id: str | None = None,
) -> DataFrame:
    """Predict, reconcile three ways, score everything, store it in the run log.

    ``predict`` takes the training and validation rows and returns validation
    rows with ``pred``; ``params`` are the parameters of its model. Under one
    ``run_id`` a study is logged once, however often it runs. Returns the level
    scores of the four methods.
    """
    spark, began = features.sparkSession, time.time()
    features = fill_price(with_day_number(features))
    check_dependencies(features)
    train = split.train(features)
    predicted = stored(predict(train, split.validation(features)), "predicted")
    counts: dict[str, object] = {"training_time_sec": round(time.time() - began, 3)}
    val = stored(reconcile_all(train, predicted, split), "reconciled")
    levels, coherence = score_methods(train, val, split, METHODS)
    levels = stored(levels, "scores")
    counts |= {"train_rows": train.count(), "val_rows": val.count()} | dict(params or {})
    rows = runlog.metric_rows(levels, coherence).unionByName(runlog.error_rows(val))
    rows = rows.unionByName(runlog.method_rows(spark, METHODS)).unionByName(runlog.param_rows(spark, RUN_NAMES["pred"], counts))
    runlog.append(rows, log_path, run_id)
    return levels


def score_methods(
    train: DataFrame, val: DataFrame, split: Split, methods: Sequence[str] = METHODS
) -> tuple[DataFrame, DataFrame]:
    """Level scores and coherence errors of several methods, each in one pass."""
    series = score_series(combine(train, val, methods), split, methods, dense=True)
    return wrmsse_levels(series, split, methods), coherence_error(val, methods)


# The same phases over tables derived from order lines.


def retail_sales(retail: Retail) -> DataFrame:
    """Dense daily sales of the window with ids only."""
    return retail_priced(retail).drop("wm_yr_wk", "sell_price")


def retail_priced(retail: Retail, first_day: int | None = None) -> DataFrame:
    """Dense daily sales with week and price, from one pass over the order lines and one shuffle."""
    first = retail.window_from if first_day is None else first_day
    return densify(retail.priced_sales, first, retail.last_day, period=WEEKLY_PRICE, laid_out=True)


def retail_panel(retail: Retail) -> DataFrame:
    """Dense sales with calendar and prices."""
    dense = retail_priced(retail).withColumn("d", F.concat(F.lit("d_"), "day_num"))
    return attach_calendar(dense, name_missing_events(retail.calendar))


def retail_features(retail: Retail) -> DataFrame:
    return build_features(retail_panel(retail))


def retail_validation(retail: Retail) -> DataFrame:
    """Ids, day, sales, price and a forecast without training, on the validation days: the mean of the 28 days before.

    Only the days that the forecast looks back on are filled in.
    """
    split = retail.split(burn_in=max(LAGS))
    dense = retail_priced(retail, max(retail.window_from, split.val_from - NAIVE_WINDOW))
    return _naive(dense, split.val_from)


def retail_predicted(retail: Retail) -> DataFrame:
    """The same on every day after the burn-in, for phases that take a dense table."""
    return _naive(retail_priced(retail), retail.window_from + max(LAGS))


def _naive(dense: DataFrame, first: int) -> DataFrame:
    rows = fill_price(add_rolling(dense, (NAIVE_WINDOW,)).where(F.col("day_num") >= first))
    return rows.select(*HIERARCHY_COLS, "day_num", "sales", "sell_price", F.col(f"sales_rmean_{NAIVE_WINDOW}").alias("pred"))


@dataclass(frozen=True)
class Study:
    """What scoring needs: sparse training rows, dense validation rows with forecasts, and the prices as steps."""

    train: DataFrame
    val: DataFrame
    price_steps: DataFrame
    split: Split

    def series(self, methods: Sequence[str] = ("pred",), weights: str = "level") -> DataFrame:
        rows = combine(self.train, self.val, methods)
        return score_series(rows, self.split, methods, weights, price_steps=self.price_steps)

    def scores(self, methods: Sequence[str] = METHODS) -> tuple[DataFrame, DataFrame]:
        """Level scores and coherence errors of several methods, each in one pass."""
        return wrmsse_levels(self.series(methods), self.split, methods), coherence_error(self.val, methods)


def sparse_training(sales: DataFrame, split: Split) -> DataFrame:
    """Training rows with sales, and a zero row per series, which shows that the series is there.

    A series that sold only outside the training days has the zero row alone.
    """
    cols = [*HIERARCHY_COLS, "day_num", "sales", "sell_price"]
    mark = sales.select(*HIERARCHY_COLS).distinct().select(
        *HIERARCHY_COLS, F.lit(split.train_from).alias("day_num"), F.lit(0).alias("sales"), F.lit(0.0).alias("sell_price")
    )
    return split.train(sales).select(*cols).unionByName(mark)


def retail_study(retail: Retail) -> Study:
    """The naive forecast over the whole window, ready for scoring.

    Sales and weekly prices are stored once, a row per series and day with a
    sale; zero rows exist only on the validation days.
    """
    split = retail.split(burn_in=max(LAGS))
    sales = stored(retail.priced_sales, "sales")
    first = max(retail.window_from, split.val_from - NAIVE_WINDOW)
    dense = add_rolling(densify(sales.drop("wm_yr_wk", "sell_price"), first, retail.last_day), (NAIVE_WINDOW,))
    val = split.validation(dense.withColumnRenamed(f"sales_rmean_{NAIVE_WINDOW}", "pred"))
    val = stored(val.select(*HIERARCHY_COLS, "day_num", "sales", "pred"), "validation")
    steps = value_steps(sales, first_day_of_week, last_day_of_week, split.train_from, split.train_to)
    return Study(sparse_training(sales, split), val, steps, split)


def retail_reconciled(retail: Retail) -> Study:
    """The same with the three reconciled forecasts, stored before scoring."""
    study = retail_study(retail)
    val = reconcile_all(study.train, study.val, study.split, n_days=study.split.train_days)
    return replace(study, val=stored(val, "reconciled"))
