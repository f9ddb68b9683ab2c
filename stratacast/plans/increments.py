"""Panel and features of the days that arrive, from a small state instead of the whole history.

A batch is a range of days. Its rows are one partition of a table, which is
overwritten as a whole, so a batch that is run again replaces itself. What
features look back on is kept per series: the last rows, as many as the longest
window needs. A state belongs to the day it was taken on; a batch reads the
state of the day before its first and writes that of its last.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stratacast.constants import HIERARCHY_COLS, LAGS, ROLLING_WINDOWS, SERIES_COLS
from stratacast.operators.features import build_features, with_day_number
from stratacast.operators.panel import build_panel, slice_window, wide_to_long
from stratacast.sources.tables import load_all_data, path_exists

LOOK_BACK = max(*LAGS, *ROLLING_WINDOWS)
STATE_COLS = [*HIERARCHY_COLS, "day_num", "sales", "sell_price"]


def write_batch(df: DataFrame, path: str, first_day: int, last_day: int) -> None:
    """Store the rows of a range of days; days that lie in another range already raise."""
    spark = df.sparkSession
    if path_exists(spark, path):
        known = spark.read.parquet(path).select("batch_from", "batch_to").distinct().collect()  # one row per batch
        for a, b in known:
            if (a, b) != (first_day, last_day) and a <= last_day and first_day <= b:
                raise ValueError(f"days {first_day}..{last_day} overlap the stored batch {a}..{b}")
    (
        df.withColumns({"batch_from": F.lit(first_day), "batch_to": F.lit(last_day)})
        .repartition(*SERIES_COLS)
        .sortWithinPartitions(*SERIES_COLS, "day_num")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("batch_from", "batch_to")
        .parquet(path)
    )


def read_batches(spark: SparkSession, path: str, first_day: int | None = None, last_day: int | None = None) -> DataFrame:
    """Rows of the days asked for; batches outside them are not opened."""
    rows = spark.read.parquet(path)
    if first_day is not None:
        rows = rows.where((F.col("batch_to") >= first_day) & (F.col("day_num") >= first_day))
    if last_day is not None:
        rows = rows.where((F.col("batch_from") <= last_day) & (F.col("day_num") <= last_day))
    return rows.drop("batch_from", "batch_to")


def extend_panel(spark: SparkSession, csv_folder: str, out: str, first_day: int, last_day: int) -> None:
    """Add the panel of a range of days; of the wide table only those columns are read."""
    tables = load_all_data(spark, csv_folder)
    long = wide_to_long(slice_window(tables["sales_validation"], first_day, last_day))
    write_batch(build_panel(long, tables["calendar"], tables["sell_prices"]), out, first_day, last_day)


def _state(spark: SparkSession, path: str, day: int) -> DataFrame | None:
    """The rows kept on a day; None where nothing has been kept yet."""
    if not path_exists(spark, path):
        return None
    kept = spark.read.parquet(path).where(F.col("upto") == day)
    if kept.isEmpty():
        days = [r[0] for r in spark.read.parquet(path).select("upto").distinct().orderBy("upto").collect()]
        if min(days) > day:
            return None
        raise ValueError(f"no state of day {day}; states were kept on {days}")
    return kept.drop("upto")


def extend_features(spark: SparkSession, panel_path: str, out: str, state_path: str, first_day: int, last_day: int) -> None:
    """Add the features of a range of days of the stored panel.

    Every series needs its rows on all days, as in the panel. A series that
    first appears in the range starts without a past. The rows of a range are
    the same as if the whole history had been built at once, since no feature
    looks back further than the rows that are kept.
    """
    new = with_day_number(read_batches(spark, panel_path, first_day, last_day))
    past = _state(spark, state_path, first_day - 1)
    rows = new if past is None else new.unionByName(past, allowMissingColumns=True)
    features = build_features(rows)
    write_batch(features.where(F.col("day_num") >= first_day), out, first_day, last_day)

    latest = Window.partitionBy(*SERIES_COLS).orderBy(F.desc("day_num"))
    kept = rows.select(*[c for c in STATE_COLS if c in rows.columns]).withColumn("_age", F.row_number().over(latest))
    (
        kept.where(F.col("_age") <= LOOK_BACK)
        .drop("_age")
        .withColumn("upto", F.lit(last_day))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("upto")
        .parquet(state_path)
    )
