"""Casts that turn bad input into NULL instead of failing the job under ANSI mode."""

from __future__ import annotations

from pyspark.sql import Column, functions as F
from pyspark.sql.types import DataType, IntegerType, LongType


def as_double(c: Column) -> Column:
    return c.try_cast("double")


def as_int(c: Column) -> Column:
    """Truncating integer cast: text such as '3.5' gives 3, not NULL."""
    return c.try_cast("double").try_cast("int")


def cast_or_null(c: Column, target: DataType | str) -> Column:
    """``try_cast``; text with a fraction is truncated for integer targets (``c`` must be text then)."""
    if isinstance(target, (IntegerType, LongType)) or target in ("int", "integer", "bigint", "long"):
        return F.coalesce(c.try_cast(target), c.try_cast("double").try_cast(target))
    return c.try_cast(target)
