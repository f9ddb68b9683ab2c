"""Drill-down tables, leaderboards and rankings."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stratacast.constants import METHOD_NAMES
from stratacast.functions.columns import lookup


def national_daily(val: DataFrame, pred_col: str = "pred") -> DataFrame:
    """Actual and forecast totals per day."""
    return val.groupBy("day_num").agg(F.sum("sales").alias("actual"), F.sum(pred_col).alias("forecast"))


def state_daily(val: DataFrame, pred_col: str = "pred") -> DataFrame:
    return val.groupBy("state_id", "day_num").agg(F.sum("sales").alias("actual"), F.sum(pred_col).alias("forecast"))


def state_coherence(val: DataFrame, pred_col: str = "pred") -> DataFrame:
    """|national - sum of states| over the days."""
    direct = val.groupBy("day_num").agg(F.sum(pred_col).alias("direct"))
    by_state = val.groupBy("state_id", "day_num").agg(F.sum(pred_col).alias("part"))
    rolled = by_state.groupBy("day_num").agg(F.sum("part").alias("rolled"))
    return direct.join(rolled, "day_num").agg(F.sum(F.abs(F.col("direct") - F.col("rolled"))).alias("difference"))


def store_report(val: DataFrame, pred_col: str = "pred") -> DataFrame:
    """Totals and mean absolute percentage error per store; days without sales divide by 1."""
    miss = F.abs(F.col("sales") - F.col(pred_col)) / F.greatest("sales", F.lit(1))
    return val.groupBy("state_id", "store_id").agg(
        F.sum("sales").alias("actual_total"), F.sum(pred_col).alias("pred_total"), (F.avg(miss) * 100).alias("mape")
    )


def sku_series(val: DataFrame, store_id: str, item_id: str, pred_col: str = "pred") -> DataFrame:
    """Actual and forecast of one series in day order."""
    one = val.where((F.col("store_id") == store_id) & (F.col("item_id") == item_id))
    return one.select("store_id", "item_id", "day_num", "sales", F.col(pred_col).alias("forecast")).orderBy("day_num")


def top_items(val: DataFrame, store_id: str, n: int = 20) -> DataFrame:
    """The items with most rows in a store, sorted by name; ties go to the lower name."""
    counts = val.where(F.col("store_id") == store_id).groupBy("item_id").agg(F.count("*").alias("n_rows"))
    return counts.orderBy(F.desc("n_rows"), "item_id").limit(n).orderBy("item_id")


def sorted_stores(df: DataFrame) -> DataFrame:
    """States and their stores in order."""
    return df.select("state_id", "store_id").distinct().orderBy("state_id", "store_id")


def display_method(df: DataFrame) -> DataFrame:
    return df.withColumn("method", F.coalesce(lookup("method", METHOD_NAMES), "method"))


def leaderboard(levels: DataFrame, coherence: DataFrame, methods: Sequence[str]) -> DataFrame:
    """One row per level and one column per method, then the mean and the coherence error."""
    overall = levels.groupBy("method").agg(F.avg("wrmsse").alias("score"))
    rows = (
        levels.select("method", F.col("level").cast("int").alias("position"), F.col("level_name").alias("row_name"), F.col("wrmsse").alias("score"))
        .unionByName(overall.select("method", F.lit(13).alias("position"), F.lit("OVERALL").alias("row_name"), "score"))
        .unionByName(
            coherence.select(
                "method", F.lit(14).alias("position"), F.lit("COHERENCE ERROR").alias("row_name"), F.col("coherence_error").alias("score")
            )
        )
    )
    return rows.groupBy("position", "row_name").pivot("method", list(methods)).agg(F.first("score"))


def best_per_level(levels: DataFrame) -> DataFrame:
    """The method with the lowest score at each level; ties go to the lower name."""
    return levels.groupBy("level", "level_name").agg(
        F.min_by("method", F.struct("wrmsse", "method")).alias("best_method"), F.min("wrmsse").alias("wrmsse")
    )


def best_method(overall: DataFrame) -> DataFrame:
    return overall.agg(
        F.min_by("method", F.struct("wrmsse", "method")).alias("best_method"), F.min("wrmsse").alias("wrmsse")
    )


def method_ranks(overall: DataFrame, coherence: DataFrame, against: str = "pred_bu") -> DataFrame:
    """Rank by score and by coherence error, and the change against one method.

    One row per method, so the unpartitioned windows see a handful of rows.
    """
    both = overall.join(coherence, "method")
    base = F.max(F.when(F.col("method") == against, F.col("wrmsse"))).over(Window.partitionBy())
    return both.select(
        "method",
        "wrmsse",
        "coherence_error",
        F.rank().over(Window.orderBy("wrmsse")).alias("rank_wrmsse"),
        F.rank().over(Window.orderBy("coherence_error")).alias("rank_coherence"),
        ((F.try_divide(F.col("wrmsse"), base) - 1) * 100).alias("pct_vs_base"),
    )


def metrics_report(scores: DataFrame) -> DataFrame:
    """One row per method from the run log: summary, level scores and whether it is best."""
    wide = scores.groupBy("method").agg(
        F.max(F.when(F.col("key") == "wrmsse_overall", F.col("value"))).alias("wrmsse_overall"),
        F.max(F.when(F.col("key") == "coherence_error", F.col("value"))).alias("coherence_error"),
        *[F.max(F.when(F.col("key") == f"wrmsse_level_{n}", F.col("value"))).alias(f"level_{n}") for n in range(1, 13)],
    )
    first = F.row_number().over(Window.orderBy("wrmsse_overall", "method")) == 1
    return wide.withColumn("is_best", first)


def preview(df: DataFrame, n: int = 3, order: Sequence[str] = ()) -> DataFrame:
    """A few rows to look at: any, or the first of an order."""
    return (df.orderBy(*order) if order else df).limit(n)
