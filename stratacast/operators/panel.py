"""From wide daily sales to the dense store x item x day panel."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stratacast.constants import (
    EVENT_COLS,
    HIERARCHY_COLS,
    NO_EVENT,
    SERIES_COLS,
)
from stratacast.functions.columns import day_number
from stratacast.session import broadcast_if_small, shuffle_partitions

ID_COLS = ("id", *HIERARCHY_COLS)


def day_columns(lo: int, hi: int) -> list[str]:
    return [f"d_{n}" for n in range(lo, hi + 1)]


def slice_window(wide: DataFrame, lo: int, hi: int) -> DataFrame:
    """Keep the id columns and the days lo..hi; raise if one is missing."""
    wanted = [*ID_COLS, *day_columns(lo, hi)]
    missing = sorted(set(wanted) - set(wide.columns), key=wanted.index)
    if missing:
        raise ValueError(f"missing columns in the wide table: {missing[:5]}")
    return wide.select(*wanted)


def wide_to_long(wide: DataFrame, ids: Sequence[str] = ID_COLS) -> DataFrame:
    """One row per series and day column, with the integer day number.

    The day columns share one type, so a row becomes an array that is exploded.
    An unpivot would plan one projection per day, hundreds of them.
    """
    days = [c for c in wide.columns if c.startswith("d_")]
    # Written as text: hundreds of columns are one expression to parse.
    cells = F.expr("array(" + ", ".join(f"`{c}`" for c in days) + ")")
    names = F.expr("array(" + ", ".join(f"'{c}'" for c in days) + ")")
    long = wide.select(*ids, F.posexplode(cells).alias("_pos", "sales"))
    long = long.withColumn("d", F.element_at(names, F.col("_pos") + 1))
    return long.select(*ids, "d", day_number(F.col("d")).alias("day_num"), F.col("sales").cast("int"))


def pivot_series(
    long: DataFrame,
    days: Sequence[int],
    keys: Sequence[str] = ID_COLS,
    day_col: str = "day_num",
    value_col: str = "sales",
    fill: int | None = None,
) -> DataFrame:
    """One row per key, one column per listed day (missing cells NULL or ``fill``).

    The day list is explicit, so Spark needs no extra pass to find it.
    """
    named = long.withColumn("_d", F.concat(F.lit("d_"), F.col(day_col)))
    wide = named.groupBy(*keys).pivot("_d", [f"d_{n}" for n in days]).agg(F.sum(value_col))
    return wide if fill is None else wide.fillna(fill)


@dataclass(frozen=True)
class Period:
    """A value that holds for whole periods of days, such as a weekly price."""

    column: str
    value: str
    of_day: Callable[[Column], Column]


def densify(
    sales: DataFrame,
    lo: int,
    hi: int,
    series: Sequence[str] = SERIES_COLS,
    day_col: str = "day_num",
    value_col: str = "sales",
    period: Period | None = None,
    laid_out: bool = False,
) -> DataFrame:
    """Give every series a row on each day of lo..hi; new rows carry 0.

    ``sales`` has one row per series and day and may reach beyond the window:
    a series seen only outside it gets zeros. Each row fills the gap up to the
    next one, so there is no skeleton table and no join, and the result stays
    hash-partitioned by series for the windows that follow. ``laid_out`` says
    that the rows are so already, and saves that shuffle.

    With ``period`` the rows carry a value of their period. A new row takes it
    from the row before or after it in the same period; a period without any
    row has none. So a price needs no table of its own and no join.
    """
    by_day = Window.partitionBy(*series).orderBy(day_col)
    if not laid_out:
        # Rows multiply after this shuffle, so its size says nothing about the work:
        # a fixed number of partitions keeps AQE from merging them.
        sales = sales.repartition(shuffle_partitions(sales.sparkSession), *series)
    carried = (period.column, period.value) if period else ()
    others = [c for c in sales.columns if c not in (day_col, value_col, *carried)]
    kind = sales.schema[value_col].dataType
    runs = sales.select(
        *others,
        F.col(day_col).alias("_at"),
        F.col(value_col).alias("_value"),
        *[x for c in carried for x in (F.col(c).alias(f"_own_{c}"), F.lead(c).over(by_day).alias(f"_next_{c}"))],
        F.when(F.lag(day_col).over(by_day).isNull(), F.lit(lo)).otherwise(F.greatest(day_col, F.lit(lo))).alias("_from"),
        F.least(F.coalesce(F.lead(day_col).over(by_day) - 1, F.lit(hi)), F.lit(hi)).alias("_to"),
    ).where("_from <= _to")
    days = runs.withColumn(day_col, F.explode(F.sequence("_from", "_to")))
    columns = [
        *others,
        day_col,
        F.when(F.col(day_col) == F.col("_at"), F.col("_value")).otherwise(F.lit(0).cast(kind)).alias(value_col),
    ]
    if period:
        days = days.withColumn("_period", period.of_day(F.col(day_col)))
        near = [
            F.when(F.col("_period") == F.col(f"_{side}_{period.column}"), F.col(f"_{side}_{period.value}")) for side in ("own", "next")
        ]
        columns += [F.col("_period").alias(period.column), F.coalesce(*near).alias(period.value)]
    return days.select(*columns)


def value_steps(
    rows: DataFrame,
    first_day: Callable[[Column], Column],
    last_day: Callable[[Column], Column],
    lo: int,
    hi: int,
    period: str = "wm_yr_wk",
    value: str = "sell_price",
    keys: Sequence[str] = HIERARCHY_COLS,
    day_col: str = "day_num",
) -> DataFrame:
    """The value of each series as steps: the days of lo..hi on which it changes, and by how much.

    ``rows`` carry a value of their period. Equal values in adjoining periods
    are one run; a run costs two steps whatever its length. Values of many
    series add up by adding their steps, so a level's summed price on any day
    is a running sum, without a row per series and day.
    """
    by_period = Window.partitionBy(*SERIES_COLS).orderBy(period)
    spans = (
        rows.where(F.col(value).isNotNull())
        .groupBy(*keys, period)
        .agg(F.first(value).alias("_v"))
        .withColumns({"_first": F.greatest(first_day(F.col(period)), F.lit(lo)), "_last": last_day(F.col(period))})
        .where((F.col("_last") >= lo) & (F.col("_first") <= hi))
    )
    joined = F.lag("_last").over(by_period) == F.col("_first") - 1
    goes_on = F.lead("_first").over(by_period) == F.col("_last") + 1
    rise = F.col("_v") - F.when(joined, F.lag("_v").over(by_period)).otherwise(0.0)
    steps = F.array(
        F.struct(F.col("_first").alias("day"), F.col("_rise").alias("step")),
        F.when(~F.col("_goes_on"), F.struct((F.col("_last") + 1).alias("day"), (-F.col("_v")).alias("step"))),
    )
    return (
        spans.withColumns({"_rise": rise, "_goes_on": F.coalesce(goes_on, F.lit(False))})
        .select(*keys, F.explode(F.array_compact(steps)).alias("_s"))
        .select(*keys, F.col("_s.day").cast("int").alias(day_col), F.col("_s.step").alias("price_step"))
        .where((F.col("price_step") != 0) & (F.col(day_col) <= hi))
    )


def count_gaps(panel: DataFrame, lo: int, hi: int, series: Sequence[str] = SERIES_COLS) -> DataFrame:
    """Series that lack days of lo..hi, with the number of missing days.

    A series with no row in the window at all lacks every day of it.
    """
    inside = F.when(F.col("day_num").between(lo, hi), F.col("day_num"))
    return (
        panel.groupBy(*series)
        .agg((F.lit(hi - lo + 1) - F.count_distinct(inside)).alias("missing_days"))
        .where("missing_days > 0")
    )


def name_missing_events(calendar: DataFrame) -> DataFrame:
    """Absent event names and types read ``NoEvent``."""
    return calendar.fillna(NO_EVENT, [c for c in EVENT_COLS if c in calendar.columns])


def attach_calendar(sales: DataFrame, calendar: DataFrame) -> DataFrame:
    """Left join on ``d``. The calendar is broadcast once counted as small."""
    columns = ["d", *[c for c in calendar.columns if c not in sales.columns]]
    return sales.join(broadcast_if_small(calendar.select(*columns)), "d", "left")


def attach_prices(panel: DataFrame, prices: DataFrame) -> DataFrame:
    """Left join of the weekly price; weeks without a price stay NULL.

    One join replaces a loop over stores. Neither side is broadcast by hand:
    both grow with the data, so Spark decides by size.
    """
    weekly = prices.select(*SERIES_COLS, "wm_yr_wk", "sell_price")
    return panel.join(weekly, [*SERIES_COLS, "wm_yr_wk"], "left")


def build_panel(sales: DataFrame, calendar: DataFrame, prices: DataFrame) -> DataFrame:
    """Long sales with calendar and price columns."""
    return attach_prices(attach_calendar(sales, name_missing_events(calendar)), prices)


def fill_price(panel: DataFrame, price_col: str = "sell_price") -> DataFrame:
    """A missing price counts 0; a table without prices counts 1 everywhere."""
    if price_col not in panel.columns:
        return panel.withColumn(price_col, F.lit(1.0))
    return panel.withColumn(price_col, F.coalesce(F.col(price_col), F.lit(0.0)))
