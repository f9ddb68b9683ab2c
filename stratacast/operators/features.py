"""Per-series features. All windows share one partitioning and one order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratacast.constants import LAGS, MONTH_PERIOD, ROLLING_WINDOWS, SERIES_COLS, WEEK_PERIOD
from stratacast.functions.columns import cyclical, day_number, event_flag, own_state_flag, relative_change

# Squares of 32-bit values are summed as a lower and an upper half.
_HALF_BITS = 31
_HALF = 1 << _HALF_BITS

_WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def series_window(day_col: str = "day_num"):
    return Window.partitionBy(*SERIES_COLS).orderBy(day_col)


def with_day_number(df: DataFrame) -> DataFrame:
    return df if "day_num" in df.columns else df.withColumn("day_num", day_number(F.col("d")))


def add_lags(df: DataFrame, lags: Sequence[int] | None = None, value_col: str = "sales") -> DataFrame:
    """``sales_lag_k``: the value k rows earlier in the series."""
    lags = LAGS if lags is None else lags
    w = series_window()
    return df.withColumns({f"{value_col}_lag_{k}": F.lag(value_col, k).over(w) for k in lags})


def add_rolling(df: DataFrame, windows: Sequence[int] | None = None, value_col: str = "sales") -> DataFrame:
    """``sales_rmean_W`` and ``sales_rstd_W`` over the W rows before each row.

    A sliding frame is evaluated afresh for each row, so its cost grows with W.
    Whole numbers have exact running sums; the difference of two running sums
    gives the same moments at a cost that does not depend on W. Squares are
    summed in two halves, which fit longs for any history of 32-bit values;
    64-bit values use decimals. Nothing is rounded before the variance is
    known, so large neighbouring values keep their deviation.
    """
    windows = ROLLING_WINDOWS if windows is None else windows
    if not windows:
        return df
    kind = df.schema[value_col].dataType
    if not isinstance(kind, _WHOLE):
        return _rolling_by_frames(df, windows, value_col)

    before = series_window().rowsBetween(Window.unboundedPreceding, -1)
    value = F.col(value_col).cast("long")
    zero = F.lit(0).cast("long")
    sums = {"_n": F.count(value).over(before), "_s": F.coalesce(F.sum(value).over(before), zero)}
    if isinstance(kind, T.LongType):
        wide = value.cast("decimal(19,0)")
        square = (wide * wide).cast("decimal(38,0)")
        sums["_s"] = F.coalesce(F.sum(value.cast("decimal(28,0)")).over(before), F.lit(0).cast("decimal(38,0)"))
        sums["_q"] = F.coalesce(F.sum(square).over(before), F.lit(0).cast("decimal(38,0)"))
    else:
        square = value * value
        sums["_q"] = F.coalesce(F.sum(square.bitwiseAND(F.lit(_HALF - 1))).over(before), zero)
        sums["_h"] = F.coalesce(F.sum(F.shiftright(square, _HALF_BITS)).over(before), zero)
    running = df.withColumns(sums)
    w = series_window()
    tails = {
        f"{c}_{k}": F.col(c) - F.coalesce(F.lag(c, k).over(w), F.lit(0).cast(running.schema[c].dataType))
        for k in windows
        for c in sums
    }
    stats = {}
    for k in windows:
        n, s = F.col(f"_n_{k}"), F.col(f"_s_{k}")
        spread = _spread(n, s, F.col(f"_q_{k}"), F.col(f"_h_{k}") if "_h" in sums else None, k)
        stats[f"{value_col}_rmean_{k}"] = F.when(n > 0, s.cast("double") / n)
        stats[f"{value_col}_rstd_{k}"] = F.when(n > 1, F.sqrt(spread / (n * (n - 1)).cast("double")))
    return running.withColumns(tails).withColumns(stats).drop(*sums, *tails)


def _spread(n: Column, s: Column, low: Column, high: Column | None, k: int) -> Column:
    """n * (sum of squares) - (sum)^2, exact, as a double.

    Without upper halves all squares are small, and longs hold the result
    unless the window is very long; otherwise decimals do.
    """
    wide = "decimal(38,0)"
    if high is None:
        return (n.cast("decimal(10,0)") * low - s * s).cast("double")
    q = high.cast("decimal(20,0)") * F.lit(_HALF).cast("decimal(11,0)") + low.cast("decimal(20,0)")
    total = s.cast("decimal(19,0)")
    exact = (n.cast("decimal(10,0)").cast(wide) * q.cast("decimal(27,0)") - (total * total)).cast("double")
    if k >= 1 << 15:
        return exact
    return F.when(high == 0, (n * low - s * s).cast("double")).otherwise(exact)


def _rolling_by_frames(df: DataFrame, windows: Sequence[int], value_col: str) -> DataFrame:
    stats = {}
    for k in windows:
        frame = series_window().rowsBetween(-k, -1)
        stats[f"{value_col}_rmean_{k}"] = F.avg(value_col).over(frame)
        stats[f"{value_col}_rstd_{k}"] = F.stddev_samp(value_col).over(frame)
    return df.withColumns(stats)


def add_calendar_features(df: DataFrame) -> DataFrame:
    """Cyclical weekday and month, event flag, and the snap flag of the row's state.

    Works on the panel and on the calendar alone; columns that the input lacks
    give a constant 0.
    """
    df = with_day_number(df)
    wday_sin, wday_cos = cyclical(F.col("wday"), WEEK_PERIOD)
    month_sin, month_cos = cyclical(F.col("month"), MONTH_PERIOD)
    event = event_flag(F.col("event_name_1")) if "event_name_1" in df.columns else F.lit(0)
    snap_cols = [c for c in df.columns if c.startswith("snap_")]
    own = "state_id" in df.columns and bool(snap_cols)
    return df.withColumns(
        {
            "wday_sin": wday_sin,
            "wday_cos": wday_cos,
            "month_sin": month_sin,
            "month_cos": month_cos,
            "is_event": event,
            "snap": own_state_flag(F.col("state_id"), snap_cols) if own else F.lit(0),
        }
    )


def add_price_momentum(df: DataFrame, step: int = 1) -> DataFrame:
    """Relative price change against the row ``step`` earlier in the series.

    The default compares with the previous row; ``step=7`` compares with the
    same weekday one week before.
    """
    if "sell_price" not in df.columns:
        return df
    before = F.lag("sell_price", step).over(series_window())
    return df.withColumn("price_momentum", relative_change(F.col("sell_price"), before))


def drop_burn_in(df: DataFrame, lags: Sequence[int] | None = None) -> DataFrame:
    """Drop the first rows of each series, where the largest lag is missing."""
    lags = LAGS if lags is None else lags
    return df.dropna(subset=[f"sales_lag_{max(lags)}"]) if lags else df


def build_features(
    panel: DataFrame,
    lags: Sequence[int] | None = None,
    windows: Sequence[int] | None = None,
) -> DataFrame:
    """The whole feature table: one shuffle by series, then windows only."""
    df = with_day_number(panel)
    df = add_rolling(add_lags(df, lags), windows)
    df = add_price_momentum(add_calendar_features(df))
    return drop_burn_in(df, lags)
