"""Column helpers shared by the operators of this subpackage."""

from __future__ import annotations

import string
import zlib

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Between words of letters and digits: ASCII controls, blanks and punctuation (text lower-cased before).
ITEM_GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
# White space between words.
PLAIN_GAP = r"[\x20\x09-\x0D]+"


def whole_text(text: Column) -> Column:
    return F.coalesce(text.cast("string"), F.lit(""))


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z and nothing else.

    ``lower`` does just that on pure ASCII and is much faster there than the
    character map needed for texts with other letters.
    """
    mapped = F.translate(text, string.ascii_uppercase, string.ascii_lowercase)
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(mapped)


def item_words(text: Column) -> Column:
    """Words of letters and digits of the lower-cased text; a null has none."""
    return F.array_remove(F.split(ascii_lower(whole_text(text)), ITEM_GAP), "")


def plain_words(text: Column) -> Column:
    """Words between white space; a null has none."""
    return F.array_remove(F.split(whole_text(text), PLAIN_GAP), "")


def broadcast_within(df: DataFrame, max_rows: int) -> DataFrame:
    """Hint a broadcast of a table of fixed-width rows once it has been counted.

    For numbers only: a row bound is a byte bound there. A larger table stays
    an ordinary shuffle join.
    """
    return F.broadcast(df) if df.limit(max_rows + 1).count() <= max_rows else df


def fold_of(doc_id: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``."""
    return F.crc32(doc_id.cast("string").cast("binary")) % folds


def fold_of_value(doc_id: object, folds: int) -> int:
    return zlib.crc32(str(doc_id).encode()) % folds
