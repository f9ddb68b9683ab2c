"""Column expressions. All are built-in Spark functions, so they stay in codegen."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from stratacast.constants import NO_EVENT


def day_number(d: Column) -> Column:
    """``'d_1414'`` to ``1414``."""
    return F.split_part(d, F.lit("_"), F.lit(2)).cast("int")


def lookup(column: str, mapping: Mapping[object, object]) -> Column:
    """The mapped value of a column, NULL if it has none.

    Written as one CASE expression: a chain of column objects costs a round
    trip to the JVM for each of its parts.
    """

    def sql(value: object) -> str:
        return "'" + value.replace("'", "''") + "'" if isinstance(value, str) else str(value)

    cases = " ".join(f"WHEN {sql(k)} THEN {sql(v)}" for k, v in mapping.items())
    return F.expr(f"CASE {column} {cases} END")


def cyclical(value: Column, period: int) -> tuple[Column, Column]:
    """Sine and cosine of a value that repeats with ``period``."""
    angle = value * F.lit(2 * math.pi / period)
    return F.sin(angle), F.cos(angle)


def event_flag(event_name: Column) -> Column:
    """1 where a named event falls on the day; a missing name is no event."""
    return F.when(event_name.isNotNull() & (event_name != NO_EVENT), 1).otherwise(0)


def own_state_flag(state: Column, columns: Sequence[str], prefix: str = "snap_") -> Column:
    """The ``snap_<state>`` column that belongs to the row's own state, else 0."""
    picked = [F.when(state == c.removeprefix(prefix), F.col(f"`{c}`")) for c in columns]
    return F.coalesce(*picked, F.lit(0)).cast("int")


def relative_change(now: Column, before: Column) -> Column:
    """(now - before) / before; 0 where either is missing or before is 0."""
    return F.coalesce(F.when(before != 0, (now - before) / before), F.lit(0.0))


def clip_at_zero(value: Column) -> Column:
    """Negative predictions become 0; a missing prediction stays missing."""
    return F.when(value < 0, F.lit(0.0)).otherwise(value)


def round_cents(value: Column) -> Column:
    """Two decimals, half to even."""
    return F.bround(value, 2)
