"""Retail tables derived from order lines: sales, calendar, prices.

A store is the nation of a supplier, its state the region; an item is a brand
and type, its department the brand. Every order line counts.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stratacast.constants import HIERARCHY_COLS, SERIES_COLS
from stratacast.operators.panel import Period
from stratacast.session import shuffle_partitions
from stratacast.split import Split

EPOCH = "1995-01-01"
FIRST_WEEK = 11101


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def _ship_day():
    return F.datediff(F.to_date("l_shipdate"), F.to_date(F.lit(EPOCH)))


def week_of(day):
    return F.lit(FIRST_WEEK) + F.floor((day - 1) / 7).cast("int")


def first_day_of_week(week):
    return (week - FIRST_WEEK) * 7 + 1


def last_day_of_week(week):
    return (week - FIRST_WEEK) * 7 + 7


WEEKLY_PRICE = Period("wm_yr_wk", "sell_price", week_of)


def order_lines(spark: SparkSession, folder: str) -> DataFrame:
    """One row per order line with hierarchy ids, day, units and cents."""
    lines = _table(spark, folder, "lineitem")
    part = _table(spark, folder, "part").select(
        F.col("p_partkey").alias("l_partkey"),
        F.concat_ws("|", "p_brand", "p_type").alias("item_id"),
        F.col("p_brand").alias("dept_id"),
        F.concat(F.lit("CAT_"), F.split_part("p_brand", F.lit("#"), F.lit(2)).cast("int") % 3).alias("cat_id"),
    )
    # Joined one by one: Spark knows the size of each file and broadcasts what
    # is small, where a joined dimension would have no reliable size.
    supplier = _table(spark, folder, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), "s_nationkey")
    nation = _table(spark, folder, "nation").select(
        F.col("n_nationkey").alias("s_nationkey"), F.col("n_name").alias("store_id"), "n_regionkey"
    )
    region = _table(spark, folder, "region").select(F.col("r_regionkey").alias("n_regionkey"), F.col("r_name").alias("state_id"))
    return (
        lines.join(part, "l_partkey")
        .join(supplier, "l_suppkey")
        .join(nation, "s_nationkey")
        .join(region, "n_regionkey")
        .select(
            *HIERARCHY_COLS,
            _ship_day().alias("day_num"),
            F.col("l_quantity").cast("long").alias("units"),
            F.round(F.col("l_extendedprice") * 100).cast("long").alias("cents"),
        )
    )


def daily_sales(lines: DataFrame) -> DataFrame:
    """Units per series and day; days without a sale have no row."""
    return lines.groupBy(*HIERARCHY_COLS, "day_num").agg(F.sum("units").cast("int").alias("sales"))


def priced_sales(lines: DataFrame) -> DataFrame:
    """Units per series and day with the mean price of the week, in one pass over the lines.

    The lines are laid out by series once; the sums per day, the price of the
    week and whatever windows follow use that layout. The number of partitions
    is fixed, since days without a sale are filled in after it.
    """
    laid_out = lines.repartition(shuffle_partitions(lines.sparkSession), *SERIES_COLS)
    daily = laid_out.groupBy(*HIERARCHY_COLS, "day_num").agg(
        F.sum("units").cast("int").alias("sales"), F.sum("units").alias("_units"), F.sum("cents").alias("_cents")
    )
    week = Window.partitionBy(*SERIES_COLS, "wm_yr_wk")
    return (
        daily.withColumn("wm_yr_wk", week_of(F.col("day_num")))
        .withColumns({"_week_cents": F.sum("_cents").over(week), "_week_units": F.sum("_units").over(week)})
        .withColumn("sell_price", F.expr("_week_cents div _week_units") / F.lit(100.0))
        .drop("_units", "_cents", "_week_cents", "_week_units")
    )


def weekly_prices(lines: DataFrame) -> DataFrame:
    """Mean unit price of a series in a week, in whole cents; unsold weeks have no row."""
    weekly = lines.groupBy("store_id", "item_id", week_of(F.col("day_num")).alias("wm_yr_wk"))
    return weekly.agg(F.sum("cents").alias("cents"), F.sum("units").alias("units")).select(
        "store_id", "item_id", "wm_yr_wk", (F.expr("cents div units") / F.lit(100.0)).alias("sell_price")
    )


def state_names(spark: SparkSession, folder: str) -> list[str]:
    """States become column names of the calendar, so the driver needs them."""
    return sorted(r[0] for r in _table(spark, folder, "region").select("r_name").distinct().collect())


def calendar(spark: SparkSession, first: int, last: int, states: list[str]) -> DataFrame:
    """One row per day. Spark knows the exact size of a range, so joins can broadcast it."""
    day = F.col("day_num")
    date = F.date_add(F.to_date(F.lit(EPOCH)), day)
    days = spark.range(first, last + 1).select(F.col("id").cast("int").alias("day_num")).withColumn("date", date)
    dom = F.dayofmonth("date")
    name = F.when(dom == 15, "PAYDAY").when(F.col("date") == F.last_day("date"), "MONTH_END")
    # A state's benefit days are the first days of the month; how many differs by state.
    snaps = [F.when(dom <= 10 + i, 1).otherwise(0).alias(f"snap_{s}") for i, s in enumerate(states)]
    return days.select(
        "date",
        week_of(day).alias("wm_yr_wk"),
        F.date_format("date", "EEEE").alias("weekday"),
        (F.dayofweek("date") % 7 + 1).alias("wday"),
        F.month("date").alias("month"),
        F.year("date").alias("year"),
        F.concat(F.lit("d_"), day).alias("d"),
        name.alias("event_name_1"),
        F.when(name.isNotNull(), "Recurring").alias("event_type_1"),
        F.lit(None).cast("string").alias("event_name_2"),
        F.lit(None).cast("string").alias("event_type_2"),
        *snaps,
    )


@dataclass(frozen=True)
class Retail:
    """The derived tables of one folder and the day window in use."""

    spark: SparkSession
    folder: str
    first_day: int
    last_day: int
    window_days: int | None = None

    @classmethod
    def open(cls, spark: SparkSession, folder: str, window_days: int | None = None) -> Retail:
        """Reads the day range; ``window_days`` keeps that many last days, by default all."""
        bounds = _table(spark, folder, "lineitem").select(_ship_day().alias("day")).agg(F.min("day"), F.max("day"))
        first, last = bounds.first()
        return cls(spark, folder, first, last, window_days)

    @property
    def window_from(self) -> int:
        return self.first_day if self.window_days is None else max(self.first_day, self.last_day - self.window_days + 1)

    @property
    def lines(self) -> DataFrame:
        return order_lines(self.spark, self.folder)

    @property
    def sales(self) -> DataFrame:
        return daily_sales(self.lines)

    @property
    def priced_sales(self) -> DataFrame:
        return priced_sales(self.lines)

    @property
    def prices(self) -> DataFrame:
        return weekly_prices(self.lines)

    @property
    def calendar(self) -> DataFrame:
        return calendar(self.spark, self.first_day, self.last_day, state_names(self.spark, self.folder))

    def split(self, burn_in: int = 0) -> Split:
        return Split.at_end(self.window_from + burn_in, self.last_day)
