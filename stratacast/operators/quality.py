"""Data audit: nulls, types, distinct counts, narrowing, key coverage."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratacast.constants import BYTES_PER_LONG_ROW, SERIES_COLS
from stratacast.functions.columns import lookup

# Ranges of the signed integer types, narrowest first.
INT_RANGES = (
    ("tinyint", -128, 127),
    ("smallint", -32768, 32767),
    ("int", -2147483648, 2147483647),
)
FLOAT_MAX = 3.4028234663852886e38
# Fixed value: text with fewer distinct values than this share of rows is categorical.
CATEGORY_RATIO = 0.5

_INTS = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_FLOATS = (T.FloatType, T.DoubleType)
# Bytes of one value by type; text is measured.
_WIDTHS = {"tinyint": 1, "boolean": 1, "smallint": 2, "int": 4, "float": 4, "date": 4, "bigint": 8, "double": 8,
           "timestamp": 8, "timestamp_ntz": 8}

_FACT = "_at int, value string, rows long, nulls long, lo double, hi double, bytes long"
# Different values that a task holds before it hands them on.
_HELD_VALUES = 500_000


def _tick(name: str) -> Column:
    return F.col(f"`{name}`")


def _is(df: DataFrame, name: str, kinds) -> bool:
    return isinstance(df.schema[name].dataType, kinds)


def null_audit(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Null count and percentage of the columns that have any, per table."""
    result = None
    for name, df in tables.items():
        counts = df.agg(F.count("*").alias("_rows"), *[F.count_if(_tick(c).isNull()).alias(c) for c in df.columns])
        flat = counts.unpivot(["_rows"], df.columns, "column_name", "nulls").select(
            F.lit(name).alias("table_name"), "column_name", "nulls", F.expr("100 * try_divide(nulls, _rows)").alias("pct")
        )
        result = flat if result is None else result.unionByName(flat)
    return result.where("nulls > 0")


def dtype_summary(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Number of columns per type, per table; the input is the schemas."""
    rows = [(name, dtype) for name, df in tables.items() for _, dtype in df.dtypes]
    spark = next(iter(tables.values())).sparkSession
    return spark.createDataFrame(rows, "table_name string, dtype string").groupBy("table_name", "dtype").agg(
        F.count("*").alias("n_columns")
    )


def distinct_counts(df: DataFrame, cols: Sequence[str], approximate: bool = False) -> DataFrame:
    """Distinct non-null values per column.

    Exact counting spreads (column, value) pairs over the cluster in one
    shuffle and counts them, so no task gathers the values of one column.
    ``approximate`` needs no shuffle of values at all.
    """
    if approximate:
        one = df.agg(*[F.approx_count_distinct(_tick(c)).alias(c) for c in cols])
        return one.unpivot([], list(cols), "column_name", "n_distinct")
    texts = [_tick(c).cast("string").alias(c) for c in cols]
    pairs = df.select(*texts).unpivot([], list(cols), "column_name", "value").distinct()
    return pairs.groupBy("column_name").agg(F.count("value").alias("n_distinct"))


def column_profile(df: DataFrame, approximate: bool = False) -> DataFrame:
    """Position, type, null count and distinct values of each column."""
    counts = df.agg(*[F.count_if(_tick(c).isNull()).alias(c) for c in df.columns])
    nulls = counts.unpivot([], df.columns, "column_name", "nulls")
    types = df.sparkSession.createDataFrame(
        [(i, c, t) for i, (c, t) in enumerate(df.dtypes, 1)], "position int, column_name string, dtype string"
    )
    # One row per column of the table on each side.
    return types.join(F.broadcast(nulls), "column_name").join(
        F.broadcast(distinct_counts(df, df.columns, approximate)), "column_name"
    ).select("position", "column_name", "dtype", "nulls", "n_distinct")


def narrowing_plan(df: DataFrame) -> DataFrame:
    """For each column the narrowest type that holds its values.

    Whole numbers go to the smallest signed type, fractions to float when the
    range allows; half precision is never used, as it loses cents. Text is
    marked categorical when it has few distinct values for its rows.
    """
    numbers = [c for c in df.columns if _is(df, c, (*_INTS, *_FLOATS))]
    texts = [c for c in df.columns if _is(df, c, T.StringType)]
    extremes = df.agg(
        F.count("*").alias("_rows"),
        *[F.min(_tick(c)).cast("double").alias(f"min_{c}") for c in numbers],
        *[F.max(_tick(c)).cast("double").alias(f"max_{c}") for c in numbers],
    )
    none = F.lit(None).cast("double")
    rows = [
        F.struct(
            F.lit(c).alias("column_name"),
            F.lit(t).alias("from_type"),
            (F.col(f"`min_{c}`") if c in numbers else none).alias("min_value"),
            (F.col(f"`max_{c}`") if c in numbers else none).alias("max_value"),
        )
        for c, t in df.dtypes
    ]
    plan = extremes.select("_rows", F.inline(F.array(*rows)))
    if texts:
        plan = plan.join(F.broadcast(distinct_counts(df, texts)), "column_name", "left")
    else:
        plan = plan.withColumn("n_distinct", F.lit(None).cast("long"))
    is_int = F.col("from_type").isin("tinyint", "smallint", "int", "bigint")
    is_float = F.col("from_type").isin("float", "double")
    fits = [F.when(is_int & (F.col("min_value") >= lo) & (F.col("max_value") <= hi), F.lit(t)) for t, lo, hi in INT_RANGES]
    to_float = F.when(is_float & (F.col("min_value") >= -FLOAT_MAX) & (F.col("max_value") <= FLOAT_MAX), F.lit("float"))
    is_text = F.col("from_type") == "string"
    return plan.select(
        "column_name",
        "from_type",
        F.coalesce(*fits, to_float, F.col("from_type")).alias("to_type"),
        "min_value",
        "max_value",
        "n_distinct",
        F.coalesce(is_text & (F.col("n_distinct") / F.col("_rows") < CATEGORY_RATIO), F.lit(False)).alias("is_categorical"),
    )


def narrow_schema(df: DataFrame) -> DataFrame:
    """Cast every column to its narrowest type; reads one row per column."""
    targets = {r["column_name"]: r["to_type"] for r in narrowing_plan(df).select("column_name", "to_type").collect()}
    return df.select(*[_tick(c).cast(targets[c]).alias(c) for c in df.columns])


def _bytes(df: DataFrame) -> Column:
    """Bytes of one row: fixed widths, plus the length of its text."""
    fixed = sum(_WIDTHS.get(t, 0) for _, t in df.dtypes)
    texts = [F.coalesce(F.octet_length(_tick(c)), F.lit(0)) for c, t in df.dtypes if t == "string"]
    total = F.lit(fixed).cast("long")
    for t in texts:
        total = total + t
    return total


def dataset_report(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Rows, columns and size before and after narrowing, with a total row."""
    result = None
    for name, df in tables.items():
        size = df.agg(
            F.count("*").alias("rows"),
            F.sum(_bytes(df)).alias("_before"),
            *[F.sum(F.octet_length(_tick(c))).alias(f"_text_{c}") for c, t in df.dtypes if t == "string"],
        )
        # One row of totals, used as scalars beside the plan's one row per column.
        rows, before = size.select("rows").scalar(), size.select("_before").scalar()
        texts = [c for c, t in df.dtypes if t == "string"]
        text = F.coalesce(*[F.when(F.col("column_name") == c, size.select(f"`_text_{c}`").scalar()) for c in texts], F.lit(0))
        width = lookup("to_type", _WIDTHS)
        code = F.when(F.col("n_distinct") <= 127, 1).when(F.col("n_distinct") <= 32767, 2).otherwise(4)
        after = (
            F.when(F.col("is_categorical"), code * rows).when(F.col("to_type") == "string", text).otherwise(width * rows)
        )
        one = (
            narrowing_plan(df)
            .select(after.alias("_after"))
            .agg(F.sum("_after").cast("long").alias("bytes_after"))
            .select(
                F.lit(name).alias("table_name"),
                rows.alias("n_rows"),
                F.lit(len(df.columns)).cast("long").alias("n_columns"),
                before.alias("bytes_before"),
                "bytes_after",
            )
        )
        result = one if result is None else result.unionByName(one)
    total = result.rollup("table_name").agg(
        *[F.sum(c).alias(c) for c in ("n_rows", "n_columns", "bytes_before", "bytes_after")]
    )
    saved = F.expr("100 * try_divide(bytes_before - bytes_after, bytes_before)")
    return total.withColumn("table_name", F.coalesce("table_name", F.lit("TOTAL"))).withColumn("pct_saved", saved)


def column_facts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """One row per table and column: type, rows, nulls, distinct values, range of numbers, bytes of text.

    Each table is read once, however many columns it has. A task keeps counts
    and the different values of every column, and hands on the values, not the
    rows; a wide table is never turned into one row per cell. Distinct values
    are exact. A table without rows has its columns with counts of 0.
    """
    result = None
    for name, df in tables.items():
        schema = df.sparkSession.createDataFrame(
            [(i, c, t) for i, (c, t) in enumerate(df.dtypes)], "_at int, column_name string, dtype string"
        )
        plain = [F.col(f"`{c}`").cast("string" if t.startswith("decimal") else t).alias(f"c{i}") for i, (c, t) in enumerate(df.dtypes)]
        told = df.select(*plain).mapInArrow(_facts_of_batches, _FACT)
        values = told.groupBy("_at", "value").agg(
            F.sum("rows").alias("rows"), F.sum("nulls").alias("nulls"), F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.sum("bytes").alias("bytes")
        )
        facts = values.groupBy("_at").agg(
            F.sum("rows").alias("n_rows"),
            F.sum("nulls").alias("nulls"),
            F.count("value").alias("n_distinct"),
            F.min("lo").alias("min_value"),
            F.max("hi").alias("max_value"),
            F.sum("bytes").alias("text_bytes"),
        )
        none = F.lit(0).cast("long")
        one = schema.join(facts, "_at", "left").select(
            F.lit(name).alias("table_name"),
            (F.col("_at") + 1).alias("position"),
            "column_name",
            "dtype",
            *[F.coalesce(c, none).alias(c) for c in ("n_rows", "nulls", "n_distinct")],
            "min_value",
            "max_value",
            F.coalesce("text_bytes", none).alias("text_bytes"),
        )
        result = one if result is None else result.unionByName(one)
    return result


def _facts_of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per column the counts of the task, and its different values; values are handed on when many are held."""
    seen: dict[int, set[str]] = {}
    counts: dict[int, list] = {}
    held = 0

    def rows(out: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*out, strict=True))
        kinds = (pa.int32(), pa.string(), pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.int64())
        arrays = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
        return pa.RecordBatch.from_arrays(arrays, names=["_at", "value", "rows", "nulls", "lo", "hi", "bytes"])

    def values() -> pa.RecordBatch:
        return rows([(i, v, 0, 0, None, None, 0) for i, found in seen.items() for v in found])

    for batch in batches:
        for i, column in enumerate(batch.columns):
            total = counts.setdefault(i, [0, 0, None, None, 0])
            total[0] += len(column)
            total[1] += column.null_count
            different = pc.unique(column.drop_null())
            if pa.types.is_integer(column.type) or pa.types.is_floating(column.type):
                ends = pc.min_max(different)
                for at, pick, end in ((2, min, ends["min"].as_py()), (3, max, ends["max"].as_py())):
                    if end is not None:
                        total[at] = float(end) if total[at] is None else pick(total[at], float(end))
            elif pa.types.is_string(column.type) or pa.types.is_large_string(column.type):
                total[4] += pc.sum(pc.binary_length(column)).as_py() or 0
            found = seen.setdefault(i, set())
            held -= len(found)
            found.update(different.cast(pa.string()).to_pylist())
            held += len(found)
        if held > _HELD_VALUES:
            yield values()
            seen, held = {}, 0
    if held:
        yield values()
    if counts:
        yield rows([(i, None, n, nulls, lo, hi, size) for i, (n, nulls, lo, hi, size) in counts.items()])


def narrowing(facts: DataFrame) -> DataFrame:
    """The facts with the narrowest type that holds a column's values, and whether a text is categorical."""
    is_int = F.col("dtype").isin("tinyint", "smallint", "int", "bigint")
    is_float = F.col("dtype").isin("float", "double")
    fits = [F.when(is_int & (F.col("min_value") >= lo) & (F.col("max_value") <= hi), F.lit(t)) for t, lo, hi in INT_RANGES]
    to_float = F.when(is_float & (F.col("min_value") >= -FLOAT_MAX) & (F.col("max_value") <= FLOAT_MAX), F.lit("float"))
    few = F.col("n_distinct") < CATEGORY_RATIO * F.col("n_rows")
    return facts.withColumns(
        {
            "to_type": F.coalesce(*fits, to_float, F.col("dtype")),
            "is_categorical": F.coalesce((F.col("dtype") == "string") & few, F.lit(False)),
        }
    )


def dataset_sizes(facts: DataFrame) -> DataFrame:
    """Rows, columns and bytes before and after narrowing per table, with a total row, from the facts alone."""
    n = F.col("n_rows")
    code = F.when(F.col("n_distinct") <= 127, 1).when(F.col("n_distinct") <= 32767, 2).otherwise(4)
    text = F.col("dtype") == "string"
    before = F.when(text, F.col("text_bytes")).otherwise(F.coalesce(lookup("dtype", _WIDTHS), F.lit(0)) * n)
    after = (
        F.when(F.col("is_categorical"), code * n)
        .when(text, F.col("text_bytes"))
        .otherwise(F.coalesce(lookup("to_type", _WIDTHS), F.lit(0)) * n)
    )
    per_table = narrowing(facts).groupBy("table_name").agg(
        F.max("n_rows").alias("n_rows"),
        F.count("*").alias("n_columns"),
        F.sum(before).cast("long").alias("bytes_before"),
        F.sum(after).cast("long").alias("bytes_after"),
    )
    sums = [F.sum(c).alias(c) for c in ("n_rows", "n_columns", "bytes_before", "bytes_after")]
    saved = F.expr("100 * try_divide(bytes_before - bytes_after, bytes_before)")
    total = per_table.rollup("table_name").agg(*sums)
    return total.withColumn("table_name", F.coalesce("table_name", F.lit("TOTAL"))).withColumn("pct_saved", saved)


def key_coverage(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """How the distinct values of a join key overlap, in one row.

    Both sides are reduced before the shuffle and compared in one aggregate.
    """
    sides = left.select(F.col(key).alias("k"), F.lit(1).alias("l"), F.lit(0).alias("r")).unionByName(
        right.select(F.col(key).alias("k"), F.lit(0).alias("l"), F.lit(1).alias("r"))
    )
    seen = sides.where("k IS NOT NULL").groupBy("k").agg(F.max("l").alias("l"), F.max("r").alias("r"))
    result = seen.agg(
        F.count_if(F.col("l") == 1).alias("n_left"),
        F.count_if(F.col("r") == 1).alias("n_right"),
        F.count_if((F.col("l") == 1) & (F.col("r") == 1)).alias("n_overlap"),
        F.count_if((F.col("l") == 1) & (F.col("r") == 0)).alias("left_only"),
        F.count_if((F.col("l") == 0) & (F.col("r") == 1)).alias("right_only"),
    )
    match = (F.col("left_only") == 0) & (F.col("right_only") == 0)
    return result.select(F.lit(key).alias("key"), "*", match.alias("keys_match"))


def keys_only_in(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Distinct keys of ``left`` that ``right`` lacks."""
    return left.select(*keys).distinct().join(right.select(*keys).distinct(), list(keys), "left_anti")


def window_presence(sales: DataFrame, lo: int, hi: int) -> DataFrame:
    """How many of the expected window days the sales contain."""
    days = sales.select("day_num").where(F.col("day_num").between(lo, hi)).distinct()
    return days.agg(F.count("*").alias("found")).select(
        "found", F.lit(hi - lo + 1).cast("long").alias("expected"), (F.col("found") == hi - lo + 1).alias("complete")
    )


def wide_window_presence(wide: DataFrame, lo: int, hi: int) -> tuple[int, int]:
    """The same for a wide table, from its schema alone."""
    have = set(wide.columns)
    return sum(f"d_{n}" in have for n in range(lo, hi + 1)), hi - lo + 1


def size_estimate(sales: DataFrame, n_days: int, bytes_per_row: int = BYTES_PER_LONG_ROW) -> DataFrame:
    """Rows and rough megabytes of the long table before joins."""
    series = sales.select(*SERIES_COLS).distinct().agg(F.count("*").alias("n_series"))
    rows = F.col("n_series") * n_days
    return series.select(
        "n_series",
        F.lit(n_days).cast("long").alias("n_days"),
        rows.alias("est_rows"),
        (rows * bytes_per_row / F.lit(1024.0 * 1024.0)).alias("est_mb"),
    )


def price_gaps(panel: DataFrame) -> DataFrame:
    """Rows without a price after the price join."""
    return panel.agg(F.count("*").alias("n_rows"), F.count_if(F.col("sell_price").isNull()).alias("price_nulls"))
