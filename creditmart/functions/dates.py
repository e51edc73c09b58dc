"""Snapshot-month expressions and the train / out-of-time date windows."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, functions as F


def month_start(c: Column) -> Column:
    return F.trunc(c, "month")


def month_starts(start: str, end: str) -> list[date]:
    """First days of the months from the month of ``start`` up to ``end`` (inclusive)."""
    first, last = date.fromisoformat(start), date.fromisoformat(end)
    months = range(first.year * 12 + first.month - 1, last.year * 12 + last.month)
    return [date(m // 12, m % 12 + 1, 1) for m in months]


def as_date(d: str | date | Column) -> Column:
    return d if isinstance(d, Column) else F.lit(str(d)).cast("date")


@dataclass(frozen=True)
class ModelWindows:
    """Closed date windows around a training date, as constant expressions Catalyst folds.

    The out-of-time window is the ``oot_months`` before the training date; the train/test window
    is the ``train_months`` before that.
    """

    train_date: str | date | Column
    train_months: int = 12
    oot_months: int = 2

    @property
    def oot_start(self) -> Column:
        return F.add_months(as_date(self.train_date), -self.oot_months)

    @property
    def oot_end(self) -> Column:
        return F.date_sub(as_date(self.train_date), 1)

    @property
    def train_start(self) -> Column:
        return F.add_months(self.oot_start, -self.train_months)

    @property
    def train_end(self) -> Column:
        return F.date_sub(self.oot_start, 1)

    def covers(self, c: Column) -> Column:
        return c.between(self.train_start, self.oot_end)

    def split_name(self, c: Column) -> Column:
        """'train_test', 'oot', or NULL outside both windows."""
        return F.when(c.between(self.oot_start, self.oot_end), "oot").when(
            c.between(self.train_start, self.train_end), "train_test"
        )
