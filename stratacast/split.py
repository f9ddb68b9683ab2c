"""Training and validation day ranges."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratacast.constants import HORIZON_DAYS


@dataclass(frozen=True)
class Split:
    """First and last day of training and of validation, both inclusive."""

    train_from: int
    train_to: int
    val_from: int
    val_to: int

    @classmethod
    def at_end(cls, first_day: int, last_day: int, horizon: int = HORIZON_DAYS) -> Split:
        return cls(first_day, last_day - horizon, last_day - horizon + 1, last_day)

    @property
    def horizon(self) -> int:
        return self.val_to - self.val_from + 1

    @property
    def train_days(self) -> int:
        return self.train_to - self.train_from + 1

    def train(self, df: DataFrame, day_col: str = "day_num") -> DataFrame:
        return df.where(F.col(day_col).between(self.train_from, self.train_to))

    def validation(self, df: DataFrame, day_col: str = "day_num") -> DataFrame:
        return df.where(F.col(day_col).between(self.val_from, self.val_to))
