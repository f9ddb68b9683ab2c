"""CSV sources with fixed schemas, and Parquet sinks and sources."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratacast.constants import EVENT_COLS, HIERARCHY_COLS, SERIES_COLS

_CALENDAR_TYPES = {
    "date": T.DateType(),
    "wm_yr_wk": T.IntegerType(),
    "weekday": T.StringType(),
    "wday": T.IntegerType(),
    "month": T.IntegerType(),
    "year": T.IntegerType(),
    "d": T.StringType(),
    **{c: T.StringType() for c in EVENT_COLS},
}
_PRICE_TYPES = {
    "store_id": T.StringType(),
    "item_id": T.StringType(),
    "wm_yr_wk": T.IntegerType(),
    "sell_price": T.DoubleType(),
}


def _schema(types: dict[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in types.items()])


CALENDAR_SCHEMA = _schema(_CALENDAR_TYPES)
PRICE_SCHEMA = _schema(_PRICE_TYPES)

# Files of a table laid out by series, folders of stored forecasts, and the place of a layout beside its table.
SERIES_BUCKETS = 64
FORECAST_GROUPS = 64
LAYOUT = "_layout"

# File names of the five input tables.
FILES = {
    "calendar": "calendar.csv",
    "sales_validation": "sales_train_validation.csv",
    "sales_evaluation": "sales_train_evaluation.csv",
    "sell_prices": "sell_prices.csv",
    "sample_submission": "sample_submission.csv",
}


def csv_header(spark: SparkSession, path: str) -> list[str]:
    """Column names only: one line of one file is read."""
    return spark.read.csv(path, header=True, inferSchema=False).columns


def _read_csv(spark: SparkSession, path: str, known: T.StructType, other: T.DataType) -> DataFrame:
    """Types of ``known`` by name, ``other`` for the rest; missing columns raise."""
    header = csv_header(spark, path)
    types = {f.name: f.dataType for f in known}
    schema = T.StructType([T.StructField(c, types.get(c, other)) for c in header])
    missing = [f.name for f in known if f.name not in header]
    if missing:
        raise ValueError(f"{path} lacks columns {missing}")
    # A cell that is not of its type stops the load instead of becoming NULL.
    return spark.read.schema(schema).csv(path, header=True, mode="FAILFAST")


def load_calendar(spark: SparkSession, path: str) -> DataFrame:
    """Calendar; columns beyond the fixed ones are the integer snap flags."""
    return _read_csv(spark, path, CALENDAR_SCHEMA, T.IntegerType())


def load_sales(spark: SparkSession, path: str) -> DataFrame:
    """Wide daily sales: text ids and one integer column per day."""
    ids = {c: T.StringType() for c in ("id", *HIERARCHY_COLS)}
    return _read_csv(spark, path, _schema(ids), T.IntegerType())


def load_sell_prices(spark: SparkSession, path: str) -> DataFrame:
    return _read_csv(spark, path, PRICE_SCHEMA, T.StringType())


def load_sample_submission(spark: SparkSession, path: str) -> DataFrame:
    return _read_csv(spark, path, _schema({"id": T.StringType()}), T.DoubleType())


def load_all_data(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """The five tables, lazily."""
    paths = {name: f"{folder.rstrip('/')}/{file}" for name, file in FILES.items()}
    return {
        "calendar": load_calendar(spark, paths["calendar"]),
        "sales_validation": load_sales(spark, paths["sales_validation"]),
        "sales_evaluation": load_sales(spark, paths["sales_evaluation"]),
        "sell_prices": load_sell_prices(spark, paths["sell_prices"]),
        "sample_submission": load_sample_submission(spark, paths["sample_submission"]),
    }


def write_panel(df: DataFrame, path: str, partition_by: str = "store_id") -> None:
    """Parquet laid out by store and sorted by series and day inside each file.

    Partitioning the shuffle by series as well spreads a large store over
    several files instead of one task.
    """
    (
        df.repartition(partition_by, *[c for c in SERIES_COLS if c != partition_by])
        .sortWithinPartitions(partition_by, *SERIES_COLS, "day_num")
        .write.mode("overwrite")
        .partitionBy(partition_by)
        .parquet(path)
    )


def write_series_table(df: DataFrame, path: str, buckets: int = SERIES_BUCKETS) -> None:
    """Parquet bucketed by series and sorted by series and day, one file per bucket.

    Readers that work per series (windows, aggregates, joins on the series) get
    their rows co-located and need no shuffle. A large store is spread over all
    buckets; the number of files is the number of buckets whatever the number
    of stores.
    """
    spark = df.sparkSession
    name = f"series_{uuid.uuid4().hex}"
    laid_out = df.repartition(buckets, *SERIES_COLS).sortWithinPartitions(*SERIES_COLS, "day_num")
    writer = laid_out.write.mode("overwrite").format("parquet").bucketBy(buckets, *SERIES_COLS).sortBy(*SERIES_COLS, "day_num")
    writer.option("path", path).saveAsTable(name)
    spark.sql(f"DROP TABLE {name}")  # external: the files stay, and carry their bucket in their names
    layout = spark.createDataFrame([(buckets, df.schema.json())], "buckets int, schema string")
    layout.coalesce(1).write.mode("overwrite").json(f"{path.rstrip('/')}{LAYOUT}")


def read_series_table(spark: SparkSession, path: str) -> DataFrame:
    """A table of ``write_series_table`` with its layout made known to the planner."""
    layout = spark.read.json(f"{path.rstrip('/')}{LAYOUT}").first()
    schema = T.StructType.fromJson(json.loads(layout["schema"]))
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    keys = ", ".join(SERIES_COLS)
    name = f"series_{uuid.uuid4().hex}"
    spark.sql(
        f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY ({keys}) SORTED BY ({keys}, day_num) "
        f"INTO {layout['buckets']} BUCKETS LOCATION '{path}'"
    )
    return spark.table(name)


def write_forecasts(forecasts: DataFrame, path: str, groups: int = FORECAST_GROUPS) -> None:
    """Forecasts by series, laid out so that one series is found in one folder.

    The group is a hash of the series; its number is part of the folder name.
    """
    grouped = forecasts.withColumn("series_group", _group(F.col("store_id"), F.col("item_id"), groups))
    (
        grouped.repartition("series_group", *SERIES_COLS)
        .sortWithinPartitions("series_group", *SERIES_COLS, "h")
        .write.mode("overwrite")
        .partitionBy("series_group")
        .parquet(path)
    )


def _group(store_id: Column, item_id: Column, groups: int) -> Column:
    return F.pmod(F.xxhash64(store_id, item_id), F.lit(groups)).cast("int")


def forecast_rows(spark: SparkSession, path: str, store_id: str, item_id: str, groups: int = FORECAST_GROUPS) -> DataFrame:
    """The stored forecasts of one series, none for an unknown one; only its folder is listed."""
    here = F.col("series_group") == _group(F.lit(store_id), F.lit(item_id), groups)
    rows = spark.read.parquet(path).where(here & (F.col("store_id") == store_id) & (F.col("item_id") == item_id))
    return rows.drop("series_group")


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a path exists on whatever file system it names."""
    try:
        spark.read.format("binaryFile").load(path).limit(0).count()
        return True
    except Exception as error:  # noqa: BLE001 - only a missing path means "no"
        if "PATH_NOT_FOUND" in str(error):
            return False
        raise


def write_predictions(val: DataFrame, path: str, pred_cols: tuple[str, ...] = ("pred",)) -> None:
    """Predictions keyed by series and day, never by row position."""
    val.select(*SERIES_COLS, "day_num", *pred_cols).write.mode("overwrite").parquet(path)


def attach_predictions(val: DataFrame, path: str | None) -> DataFrame:
    """Join stored predictions; without a file the actual sales stand in."""
    spark = val.sparkSession
    if path is None or not path_exists(spark, path):
        return val.withColumn("pred", F.col("sales").cast("double"))
    stored = spark.read.parquet(path)
    return val.join(stored, [*SERIES_COLS, "day_num"], "left").withColumn("pred", F.greatest("pred", F.lit(0.0)))
