"""Loan performance: months on book, days past due, default labels and bad rates."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, functions as F

from creditmart.functions import delinquency as D
from creditmart.functions.dates import as_date


def add_delinquency(
    df: DataFrame,
    due: str = "due_amt",
    overdue: str = "overdue_amt",
    snapshot: str = "snapshot_date",
) -> DataFrame:
    """Add installments_missed, first_missed_date and dpd.

    The missed count is taken from the amounts as they are; afterwards NULLs in all numeric columns
    become 0, and the dates are worked out from the filled values.
    """
    missed = df.withColumn("installments_missed", D.installments_missed(F.col(overdue), F.col(due))).na.fill(0)
    dated = missed.withColumn(
        "first_missed_date", D.first_missed_date(F.col(snapshot), F.col("installments_missed"))
    )
    return dated.withColumn(
        "dpd", D.days_past_due(F.col(snapshot), F.col(overdue), F.col("first_missed_date"))
    )


def default_labels(
    df: DataFrame,
    dpd: int = 60,
    mob: int = 6,
    ids: tuple[str, ...] = ("loan_id", "Customer_ID"),
    snapshot: str = "snapshot_date",
) -> DataFrame:
    """Loans at ``mob`` months on book, labelled 1 when at least ``dpd`` days past due."""
    return df.where(F.col("mob") == mob).select(
        *ids,
        D.at_least_flag(F.col("dpd"), dpd).alias("label"),
        F.lit(D.label_definition(dpd, mob)).alias("label_def"),
        snapshot,
    )


def bad_rate_curve(
    df: DataFrame,
    dpd: int = 60,
    started_before: str | date | Column | None = None,
    start: str = "loan_start_date",
    by: str = "mob",
) -> DataFrame:
    """Share of rows at least ``dpd`` days past due per month on book, over completed loans."""
    completed = df if started_before is None else df.where(F.col(start) < as_date(started_before))
    return (
        completed.groupBy(by)
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.sum(D.at_least_flag(F.col("dpd"), dpd)).alias("n_bad"),
            F.avg(D.at_least_flag(F.col("dpd"), dpd)).alias("bad_rate"),
        )
        .orderBy(by)
    )
