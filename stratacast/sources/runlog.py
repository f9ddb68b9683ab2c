"""Run log: parameters and metrics of named runs in one table, a partition per run id."""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratacast.constants import METHOD_NAMES, RUN_NAMES
from stratacast.functions.columns import lookup
from stratacast.operators.metrics import rmse

SCHEMA = "run_id string, logged_at timestamp, run_name string, kind string, key string, value string"
# Method and description of each reconciliation run.
METHOD_FACTS = {
    "pred_bu": ("BU", "Aggregate SKU forecasts upward"),
    "pred_td": ("TD", "National forecast disaggregated by proportions"),
    "pred_mint": ("MinT_OLS", "MinTrace OLS at store_x_dept, distributed to item"),
}
ROW = "run_name string, kind string, key string, value string"


def metric_rows(levels: DataFrame, coherence: DataFrame | None = None) -> DataFrame:
    """Log rows of level scores, their mean, and the coherence error, per run."""
    per_level = levels.select("method", F.concat(F.lit("wrmsse_level_"), "level").alias("key"), F.col("wrmsse").alias("v"))
    overall = levels.groupBy("method").agg(F.avg("wrmsse").alias("v"))
    rows = per_level.unionByName(overall.select("method", F.lit("wrmsse_overall").alias("key"), "v"))
    if coherence is not None:
        rows = rows.unionByName(
            coherence.select("method", F.lit("coherence_error").alias("key"), F.col("coherence_error").alias("v"))
        )
    name = F.coalesce(lookup("method", RUN_NAMES), "method")
    return rows.select(name.alias("run_name"), F.lit("metric").alias("kind"), "key", F.col("v").cast("string").alias("value"))


def param_rows(spark: SparkSession, run_name: str, params: Mapping[str, object], kind: str = "param") -> DataFrame:
    return spark.createDataFrame([(run_name, kind, k, str(v)) for k, v in params.items()], ROW)


def new_run() -> str:
    return uuid.uuid4().hex


def append(rows: DataFrame, path: str, run_id: str | None = None) -> None:
    """Store the rows of a run under its id and the time of writing.

    A run is one partition, overwritten as a whole: a run that is repeated
    after a failure, or logged twice, counts once.
    """
    stamped = rows.select(
        F.lit(run_id or new_run()).alias("run_id"), F.current_timestamp().alias("logged_at"), "run_name", "kind", "key", "value"
    )
    stamped.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("run_id").parquet(path)


def method_rows(spark: SparkSession, methods: Iterable[str]) -> DataFrame:
    """Method and description of the reconciliation runs."""
    rows = [(RUN_NAMES[m], "param", k, v) for m in methods if m in METHOD_FACTS for k, v in zip(("method", "description"), METHOD_FACTS[m])]
    return spark.createDataFrame(rows, ROW)


def error_rows(val: DataFrame, run_name: str = RUN_NAMES["pred"], pred_col: str = "pred") -> DataFrame:
    """The root mean squared error of a run's forecasts."""
    value = rmse(val, pred_col).select(F.col("rmse").cast("string").alias("value"))
    return value.select(F.lit(run_name).alias("run_name"), F.lit("metric").alias("kind"), F.lit("rmse").alias("key"), "value")


def read(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(SCHEMA).parquet(path)


def latest(log: DataFrame) -> DataFrame:
    """The last value of each key of each run name; equal times are settled by the run id."""
    return log.groupBy("run_name", "kind", "key").agg(F.max_by("value", F.struct("logged_at", "run_id")).alias("value"))


def scores(log: DataFrame) -> DataFrame:
    """Level and summary metrics of the latest run of each name, by display name of the method."""
    log = latest(log)
    names = {RUN_NAMES[m]: METHOD_NAMES[m] for m in RUN_NAMES}
    method = F.coalesce(lookup("run_name", names), "run_name")
    return log.where("kind = 'metric'").select(method.alias("method"), "key", F.col("value").cast("double").alias("value"))
