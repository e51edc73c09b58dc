"""Array expressions for delimited lists."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def trim_each(arr: Column) -> Column:
    """Trim every element.

    The lambda matters: passed bare, ``F.trim`` would get the element index as its second
    argument (the characters to trim).
    """
    return F.transform(arr, lambda x: F.trim(x))


def drop_blank(arr: Column) -> Column:
    return F.filter(arr, lambda x: x.isNotNull() & (x != ""))


def default_if_empty(arr: Column, value: str) -> Column:
    return F.when(F.size(arr) == 0, F.array(F.lit(value))).otherwise(arr)


def split_list(c: Column, missing: str = "No loan", conjunction: str = " and ") -> Column:
    """'Auto Loan, and Personal Loan' to ['Auto Loan', 'Personal Loan']; nothing to [missing]."""
    text = F.regexp_replace(F.coalesce(c, F.lit(missing)), conjunction, ", ")
    return default_if_empty(drop_blank(trim_each(F.split(text, ","))), missing)
