"""Hashed word k-grams packed with their positions, built inside each row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A packed gram is one long: hash bits above, word position below.
POSITION_BITS = 28
POSITION_MASK = (1 << POSITION_BITS) - 1


def _packed(hash_value: Column, position: Column) -> Column:
    return hash_value.bitwiseAND(F.lit(~POSITION_MASK)).bitwiseOR(position.cast("long"))


def gram_hashes(hashes: str, n: int) -> Column:
    """One packed hash per run of n words; the column holds one hash per word.

    Elements are read one by one: ``slice`` in a lambda costs several times as much.
    """
    count = F.size(hashes) - (n - 1)

    def gram(i: Column) -> Column:
        return _packed(F.xxhash64(*[F.get(hashes, i + j) for j in range(n)], F.lit(n)), i)

    return F.when(count > 0, F.transform(F.sequence(F.lit(0), count - 1), gram)).otherwise(
        F.array().cast("array<bigint>")
    )


def with_word_hashes(df: DataFrame) -> DataFrame:
    return df.withColumn("_hashes", F.transform("_words", lambda w: F.xxhash64(w)))


def marked(packed: Column, length: int) -> Column:
    """Packed hashes with their run length."""
    return F.transform(packed, lambda p: F.struct(p.alias("p"), F.lit(length).alias("n")))


def count_mark(count: Column) -> Column:
    """A mark of run length 0 that carries a number in place of a hash."""
    return F.array(F.struct(F.shiftleft(count.cast("long"), POSITION_BITS).alias("p"), F.lit(0).alias("n")))


def unpacked(df: DataFrame, key: str, marks: Column) -> DataFrame:
    """(key, _print, _at, _len): one row per mark."""
    return df.select(key, F.explode(marks).alias("_mark")).select(
        key,
        F.shiftright("_mark.p", POSITION_BITS).alias("_print"),
        F.col("_mark.p").bitwiseAND(F.lit(POSITION_MASK)).cast("int").alias("_at"),
        F.col("_mark.n").alias("_len"),
    )
