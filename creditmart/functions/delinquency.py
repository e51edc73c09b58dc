"""Days-past-due arithmetic and default flags."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def installments_missed(overdue: Column, due: Column) -> Column:
    """Instalments the overdue amount stands for, rounded up; 0 where the ratio is undefined."""
    ratio = F.try_divide(overdue.cast("double"), due.cast("double"))
    return F.coalesce(F.ceil(ratio).try_cast("int"), F.lit(0))


def first_missed_date(snapshot: Column, missed: Column) -> Column:
    """Snapshot moved back by the missed months (clamped to month end); NULL when none is missed."""
    return F.when(missed > 0, F.add_months(snapshot, -missed))


def days_past_due(snapshot: Column, overdue: Column, first_missed: Column) -> Column:
    """Days since the first missed instalment; 0 when nothing is overdue.

    Overdue money without a due amount leaves the first missed date, and so this, NULL.
    """
    return F.when(overdue > 0, F.datediff(snapshot, first_missed)).otherwise(F.lit(0))


def at_least_flag(c: Column, threshold: float) -> Column:
    """1 at or above the threshold, else 0 (NULL counts as 0)."""
    return F.when(c >= threshold, F.lit(1)).otherwise(F.lit(0))


def label_definition(dpd: int, mob: int) -> str:
    return f"{dpd}dpd_{mob}mob"
