"""Weighted scaled error at all levels, coherence, and plain error measures."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stratacast.constants import LEVELS
from stratacast.operators.hierarchy import KEYS, aggregate_class, aggregate_level, bottom_rows, level_classes, level_name
from stratacast.operators.panel import fill_price
from stratacast.split import Split


def combine(train: DataFrame, val: DataFrame, pred_cols: Sequence[str]) -> DataFrame:
    """Training and validation rows in one frame, for scoring in one pass."""
    cols = [c for c in (*KEYS, "day_num", "sales", "sell_price") if c in train.columns]
    return train.select(*cols).unionByName(
        val.select(*[c for c in cols if c in val.columns], *pred_cols), allowMissingColumns=True
    )


def score_series(
    panel: DataFrame,
    split: Split,
    pred_cols: Sequence[str] = ("pred",),
    weights: str = "level",
    levels: Mapping[int, Sequence[str]] = LEVELS,
    day_col: str = "day_num",
    dense: bool = False,
    price_steps: DataFrame | None = None,
) -> DataFrame:
    """Scale, dollar weight and squared errors of each series at each level.

    ``panel`` holds the training and validation days together, with the
    prediction columns filled on validation days. The training statistics and
    every prediction column come out of one aggregate and one window. A
    (series, day) cell without a row counts as 0. With ``weights='level'`` a
    panel that brings its own prices must be dense: a row that is left out
    takes its price out of the level's summed price. A sparse panel, with rows
    for sales only, brings the prices as ``price_steps`` over the training
    days instead (see ``value_steps``): they add up to the summed price of a
    level on any day.

    ``weights='level'`` multiplies the level's summed price by its summed
    sales; ``weights='revenue'`` sums price times sales of the bottom series.
    ``dense`` states that every series has a row on every day: rows that are 0
    throughout then add nothing and are left out before the first shuffle,
    except one per part, which shows that the series is there.
    """
    day = F.col(day_col)
    in_use = day.between(split.train_from, split.train_to) | day.between(split.val_from, split.val_to)
    by_steps = price_steps is not None and weights == "level"
    rows = (panel if by_steps else fill_price(panel)).where(in_use)
    money = "price_step" if by_steps else "sell_price"
    if by_steps:
        rows = rows.drop("sell_price").unionByName(price_steps.select(*KEYS, day_col, money), allowMissingColumns=True)
    elif weights == "revenue":
        money = "_revenue"
        rows = rows.withColumn(money, F.col("sales") * F.col("sell_price"))
    values = ["sales", money, *pred_cols]
    if dense:
        marks = day.isin(split.train_from, split.val_from)
        for v in values:
            marks = marks | (F.coalesce(F.col(v), F.lit(0)) != 0)
        rows = rows.where(marks)
    bottom = bottom_rows(rows, values, day_col)
    result = None
    for finest, members in level_classes(levels):
        daily = aggregate_class(bottom, finest, members, values, day_col)
        keys = finest if len(members) == 1 else ["level", *finest]
        if by_steps:
            steps = Window.partitionBy(*keys).orderBy(day_col).rowsBetween(Window.unboundedPreceding, 0)
            daily = daily.withColumn("_price", F.sum(money).over(steps))
            dollars = F.col("sales") * F.col("_price")
        else:
            dollars = F.col("sales") * F.col(money) if weights == "level" else F.col(money)
        stats = _series_statistics(daily, keys, dollars, split, pred_cols, day_col)
        number = [F.lit(next(iter(members))).alias("level")] if len(members) == 1 else ["level"]
        ids = [F.col(c) if c in finest else F.lit(None).cast("string").alias(c) for c in KEYS]
        stats = stats.select(*number, *ids, *[c for c in stats.columns if c not in keys])
        result = stats if result is None else result.unionByName(stats)
    return result


def _series_statistics(
    daily: DataFrame, keys: Sequence[str], dollars: Column, split: Split, pred_cols: Sequence[str], day_col: str
) -> DataFrame:
    by_day = Window.partitionBy(*keys).orderBy(day_col)
    day, y = F.col(day_col), F.col("sales")
    is_train = day.between(split.train_from, split.train_to)
    is_val = day.between(split.val_from, split.val_to)
    daily = daily.withColumns(
        {
            "_before": F.when(F.lag(day_col).over(by_day) == day - 1, F.lag("sales").over(by_day)).otherwise(0),
            "_gap_after": F.coalesce(F.lead(day_col).over(by_day) != day + 1, F.lit(True)),
        }
    )
    # First differences: into this day, and out of it when the next day has no row.
    step = y - F.col("_before")
    into = F.when(is_train & (day > split.train_from), step * step)
    out_of = F.when(is_train & (day < split.train_to) & F.col("_gap_after"), y * y)
    squares = F.coalesce(into, F.lit(0)) + F.coalesce(out_of, F.lit(0))
    errors = {p: F.when(is_val, F.pow(y - F.col(p), F.lit(2))) for p in pred_cols}
    mean_step = F.col("_steps") / F.lit(split.train_to - split.train_from)
    return (
        daily.groupBy(*keys)
        .agg(
            F.sum(squares).alias("_steps"),
            F.coalesce(F.sum(F.when(is_train, dollars)), F.lit(0.0)).alias("dollars"),
            *[F.sum(e).alias(f"sse_{p}") for p, e in errors.items()],
            F.count_if(is_train).alias("n_train"),
            F.count_if(is_val).alias("n_val"),
        )
        .withColumn("scale", F.when(mean_step == 0, F.lit(1.0)).otherwise(mean_step))
        .drop("_steps")
    )


def matched(series: DataFrame) -> DataFrame:
    """Series seen in training and in validation; only these are scored."""
    return series.where("n_train > 0 AND n_val > 0")


def unmatched(series: DataFrame) -> DataFrame:
    """Series that scoring leaves out, with the side that is missing."""
    side = F.when(F.col("n_train") == 0, "train").otherwise("validation")
    return series.where("n_train = 0 OR n_val = 0").select("level", *KEYS, side.alias("missing_in"))


def rmsse(series: DataFrame, split: Split, pred: str = "pred") -> Column:
    return F.sqrt(series[f"sse_{pred}"] / (split.horizon * series["scale"]))


def series_weights(series: DataFrame) -> DataFrame:
    """Dollar share within the level; equal shares where a level has no dollars.

    The level totals are twelve rows, joined back instead of a window over the
    level, which would put all bottom series into one task.
    """
    scored = matched(series)
    totals = scored.groupBy("level").agg(F.sum("dollars").alias("_total"), F.count("*").alias("_n"))
    share = F.when(F.col("_total") == 0, 1 / F.col("_n")).otherwise(F.col("dollars") / F.col("_total"))
    return scored.join(F.broadcast(totals), "level").withColumn("weight", share).drop("_total", "_n")


def wrmsse_levels(series: DataFrame, split: Split, pred_cols: Sequence[str] = ("pred",)) -> DataFrame:
    """One row per prediction column and level.

    sqrt(sum(w * rmsse^2)) with w = dollars / sum(dollars) needs only three
    sums per level, so the weights are never joined to the series.
    """
    scored = matched(series)
    squares = {p: F.col(f"sse_{p}") / (split.horizon * F.col("scale")) for p in pred_cols}
    sums = scored.groupBy("level").agg(
        F.sum("dollars").alias("_total"),
        *[F.sum(F.col("dollars") * sq).alias(f"_weighted_{p}") for p, sq in squares.items()],
        *[F.avg(sq).alias(f"_plain_{p}") for p, sq in squares.items()],
    )
    per_method = F.array(
        *[
            F.struct(
                F.lit(p).alias("method"),
                F.sqrt(
                    F.when(F.col("_total") == 0, F.col(f"_plain_{p}")).otherwise(
                        F.col(f"_weighted_{p}") / F.col("_total")
                    )
                ).alias("wrmsse"),
            )
            for p in pred_cols
        ]
    )
    flat = sums.select("level", F.inline(per_method))
    return flat.select("method", "level", level_name().alias("level_name"), "wrmsse")


def wrmsse_overall(levels: DataFrame) -> DataFrame:
    """Unweighted mean of the level scores, per method."""
    return levels.groupBy("method").agg(F.avg("wrmsse").alias("wrmsse"))


# The parent levels checked against store x department.
COHERENCE_PARENTS = (("store_id",), ("dept_id",))


def coherence_error(df: DataFrame, pred_cols: Sequence[str] = ("pred",), day_col: str = "day_num") -> DataFrame:
    """Sum of |parent - sum of children| over store and department parents."""
    child = aggregate_level(df, ["store_id", "dept_id"], pred_cols, day_col)
    errors = None
    for parent_cols in COHERENCE_PARENTS:
        keys = [*parent_cols, day_col]
        parent = aggregate_level(df, parent_cols, pred_cols, day_col)
        one = _differences(parent, aggregate_level(child, parent_cols, pred_cols, day_col), keys, pred_cols, "inner")
        errors = one if errors is None else errors.unionByName(one)
    return errors.groupBy("method").agg(F.sum("error").alias("coherence_error"))


def coherence_between(
    parent: DataFrame, child: DataFrame, parent_cols: Sequence[str], pred_cols: Sequence[str], day_col: str = "day_num"
) -> DataFrame:
    """Strict form for forecasts made independently per level.

    A key present on one side only counts with its full value.
    """
    rolled = aggregate_level(child, parent_cols, pred_cols, day_col)
    flat = aggregate_level(parent, parent_cols, pred_cols, day_col)
    diffs = _differences(flat, rolled, [*parent_cols, day_col], pred_cols, "full")
    return diffs.groupBy("method").agg(F.sum("error").alias("coherence_error"))


def _differences(parent, child, keys, pred_cols, how) -> DataFrame:
    child = child.select(*keys, *[F.col(p).alias(f"_child_{p}") for p in pred_cols])
    pairs = [
        F.struct(
            F.lit(p).alias("method"),
            F.abs(F.coalesce(F.col(p), F.lit(0)) - F.coalesce(F.col(f"_child_{p}"), F.lit(0))).alias("error"),
        )
        for p in pred_cols
    ]
    return parent.join(child, keys, how).select(F.inline(F.array(*pairs)))


def rmse(val: DataFrame, pred_col: str = "pred") -> DataFrame:
    return val.agg(F.sqrt(F.avg(F.pow(F.col("sales") - F.col(pred_col), F.lit(2)))).alias("rmse"))


def prediction_range(val: DataFrame, pred_cols: Sequence[str]) -> DataFrame:
    """Smallest and largest value of each prediction column."""
    sums = val.agg(*[f(p).alias(f"{n}_{p}") for p in pred_cols for f, n in ((F.min, "min"), (F.max, "max"))])
    pairs = [
        F.struct(F.lit(p).alias("method"), F.col(f"min_{p}").alias("min_pred"), F.col(f"max_{p}").alias("max_pred"))
        for p in pred_cols
    ]
    return sums.select(F.inline(F.array(*pairs)))
