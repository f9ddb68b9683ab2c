"""Aggregation of any measures to the twelve levels, and hierarchy facts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratacast.constants import HIERARCHY_COLS, LEVEL_NAMES, LEVELS, SERIES_COLS
from stratacast.functions.columns import lookup
from stratacast.session import shuffle_partitions

KEYS = list(HIERARCHY_COLS)


def aggregate_level(df: DataFrame, group_cols: Sequence[str], values: Sequence[str], day_col: str = "day_num") -> DataFrame:
    """Daily sums at one level; a group whose values are all missing sums to 0."""
    sums = [F.coalesce(F.sum(v), F.lit(0)).alias(v) for v in values]
    return df.groupBy(*group_cols, day_col).agg(*sums)


def _grouping_sets(df: DataFrame, levels: Mapping[int, Sequence[str]], values: Sequence[str], day_col: str) -> DataFrame:
    """Several levels in one aggregate; columns a level does not use are NULL."""
    used = [c for c in KEYS if any(c in cols for cols in levels.values())]
    keys = [*used, day_col]
    # grouping_id has one bit per key, first key highest, set where aggregated away.
    ids = {
        sum(1 << (len(keys) - 1 - i) for i, c in enumerate(keys) if c not in cols and c != day_col): n
        for n, cols in levels.items()
    }
    number = lookup("_gid", ids)
    sums = [F.coalesce(F.sum(v), F.lit(0)).alias(v) for v in values]
    grouped = df.groupingSets([[*cols, day_col] for cols in levels.values()], *keys).agg(
        F.grouping_id().alias("_gid"), *sums
    )
    return _shape(grouped, number, values, day_col, used)


def _shape(df: DataFrame, number: Column, values: Sequence[str], day_col: str, used: Sequence[str]) -> DataFrame:
    keys = [F.col(c) if c in used else F.lit(None).cast("string").alias(c) for c in KEYS]
    return df.select(number.cast("int").alias("level"), *keys, day_col, *values)


def level_classes(levels: Mapping[int, Sequence[str]] = LEVELS) -> list[tuple[list[str], dict[int, Sequence[str]]]]:
    """Levels grouped by whether they keep the item and the store.

    Each class comes with the finest keys its levels can be summed from. The
    classes differ in size by orders of magnitude, so each gets its own plan.
    """
    classes: dict[tuple[bool, bool], dict[int, Sequence[str]]] = {}
    for n, cols in levels.items():
        with_item = "item_id" in cols
        classes.setdefault((with_item, with_item and "store_id" in cols), {})[n] = cols
    return [
        ([c for c in KEYS if any(c in cols for cols in members.values())], members) for members in classes.values()
    ]


def bottom_rows(df: DataFrame, values: Sequence[str], day_col: str = "day_num") -> DataFrame:
    """One row per bottom series and day with all its ancestors.

    Every class starts from this same aggregate, so Spark runs it, and all that
    lies before it, once and reuses its exchange. The rows are laid out by
    series: the aggregate needs no second shuffle, and neither does a window
    over the days of a series. The classes multiply the rows, so the number of
    partitions is fixed against merging by AQE.
    """
    laid_out = df.repartition(shuffle_partitions(df.sparkSession), *SERIES_COLS)
    return aggregate_level(laid_out, KEYS, values, day_col)


def aggregate_class(
    bottom: DataFrame, finest: Sequence[str], members: Mapping[int, Sequence[str]], values: Sequence[str], day_col: str = "day_num"
) -> DataFrame:
    """Daily sums of one class: reduce to its finest keys, then to its levels."""
    is_bottom = set(SERIES_COLS) <= set(finest)
    reduced = bottom if is_bottom else aggregate_level(bottom, finest, values, day_col)
    if len(members) > 1:
        return _grouping_sets(reduced, members, values, day_col)
    (number,) = members
    return _shape(reduced, F.lit(number), values, day_col, finest)


def aggregate_levels(
    df: DataFrame,
    values: Sequence[str],
    levels: Mapping[int, Sequence[str]] = LEVELS,
    day_col: str = "day_num",
    staged: bool = True,
) -> DataFrame:
    """Daily sums of ``values`` at every level, one row per level, key and day.

    GROUPING SETS copies each input row once per level before it aggregates.
    Sums distribute, so with ``staged`` the bottom rows are first reduced to the
    finest keys of each class, and only those reduced rows are copied for their
    levels: the bottom is shuffled at most three times instead of twelve.
    """
    if not staged:
        return _grouping_sets(df, levels, values, day_col)
    bottom = bottom_rows(df, values, day_col)
    result = None
    for finest, members in level_classes(levels):
        part = aggregate_class(bottom, finest, members, values, day_col)
        result = part if result is None else result.unionByName(part)
    return result


def level_name(column: str = "level") -> Column:
    """Display name of a level number column."""
    return lookup(column, LEVEL_NAMES)


def store_state_map(df: DataFrame) -> DataFrame:
    """The state of each store, and how many states the data names for it."""
    return df.groupBy("store_id").agg(
        F.min("state_id").alias("state_id"), F.count_distinct("state_id").alias("n_states")
    )


def check_dependencies(df: DataFrame) -> None:
    """Raise if a store lies in two states, or an item in two departments."""
    for child, parent in (("store_id", "state_id"), ("item_id", "dept_id"), ("dept_id", "cat_id")):
        bad = df.groupBy(child).agg(F.count_distinct(parent).alias("n")).where("n > 1").take(1)
        if bad:
            raise ValueError(f"{child} {bad[0][0]!r} has {bad[0]['n']} values of {parent}")


def hierarchy_cardinality(df: DataFrame, cols: Sequence[str] = HIERARCHY_COLS, n_sample: int = 5) -> DataFrame:
    """Distinct values per hierarchy column with the first few in sorted order.

    Values are reduced to distinct (column, value) rows first; the sample is
    taken from ranks, so no full value list is gathered anywhere.
    """
    missing = [c for c in cols if c not in df.columns]
    if missing:
        raise ValueError(f"missing hierarchy columns: {missing}")
    values = distinct_values(df, cols)
    counts = values.groupBy("column_name").agg(F.count("value").alias("n_distinct"))
    samples = None
    for c in cols:
        first = values.where(F.col("column_name") == c).orderBy("value").limit(n_sample)
        samples = first if samples is None else samples.unionByName(first)
    shown = samples.groupBy("column_name").agg(F.array_join(F.array_sort(F.collect_list("value")), ", ").alias("sample"))
    return counts.join(F.broadcast(shown), "column_name")


def distinct_values(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Distinct (column, value) rows of string columns, in one shuffle."""
    return df.select(*cols).unpivot([], list(cols), "column_name", "value").where("value IS NOT NULL").distinct()


def hierarchy_info(df: DataFrame) -> DataFrame:
    """Sorted distinct values of each hierarchy column, one row per value.

    Rows instead of one list per column: an item list grows with the data.
    """
    return distinct_values(df, KEYS)


def count_series(df: DataFrame) -> DataFrame:
    return df.select(*SERIES_COLS).distinct().agg(F.count("*").alias("n_series"))


def summing_membership(bottom: DataFrame) -> DataFrame:
    """The summing matrix of the reduced hierarchy as rows.

    ``bottom`` has one row per (state, store, dept). Each of its nodes belongs
    to the total, its state, its store, its department, and itself.
    """
    parents = {
        "total": F.lit("Total"),
        "state": F.col("state_id"),
        "store": F.col("store_id"),
        "dept": F.col("dept_id"),
        "store_dept": F.concat_ws("_", "store_id", "dept_id"),
    }
    rows = [F.struct(F.lit(level).alias("node_level"), node.alias("node")) for level, node in parents.items()]
    return bottom.select("store_id", "dept_id", F.inline(F.array(*rows)))
