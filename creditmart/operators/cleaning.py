"""Cleaning of dirty numbers, outliers and gaps.

Statistics are fitted first, as a few plain numbers, and applied as literals: the cleaning itself is
then a filter and projection without a shuffle, and the same fit can be applied to later snapshots.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import IntegralType, StringType

from creditmart.functions.casting import as_int
from creditmart.functions.text import DIGITS_AND_DOT, DIGITS_ONLY, parse_count, parse_number
from creditmart.operators.quantiles import Quantile, fit_quantiles


@dataclass(frozen=True)
class NumberRule:
    """How a dirty numeric column is read: kept characters, target kind and decimals."""

    pattern: str = DIGITS_AND_DOT
    integer: bool = False
    scale: int = 2


def clean_numeric(df: DataFrame, rules: Mapping[str, NumberRule]) -> DataFrame:
    """Read dirty number columns in one projection. Columns that are numeric already are not
    turned to text and stripped (1.2E7 would lose its exponent), only cast and rounded."""
    text = {f.name for f in df.schema if isinstance(f.dataType, StringType)}

    def read(name: str) -> Column:
        rule, c = rules[name], F.col(name)
        if rule.integer:
            return parse_count(c, rule.pattern) if name in text else as_int(c)
        return parse_number(c, rule.pattern, rule.scale) if name in text else F.round(c.cast("double"), rule.scale)

    return df.withColumns({name: read(name) for name in rules if name in df.columns})


def round_columns(df: DataFrame, names: Iterable[str], scale: int = 2) -> DataFrame:
    """Round (half up); text columns are read as doubles first."""
    text = {f.name for f in df.schema if isinstance(f.dataType, StringType)}
    return df.withColumns(
        {n: F.round(F.col(n).try_cast("double") if n in text else F.col(n), scale) for n in names}
    )


def fill_zero(df: DataFrame, names: Iterable[str] | None = None) -> DataFrame:
    """NULL to 0 in the named columns, or in every numeric column."""
    return df.na.fill(0, subset=list(names)) if names is not None else df.na.fill(0)


def nonnegative(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column) >= 0)


def trim_upper_tail(df: DataFrame, column: str, p: float = 0.997, rel_err: float = 0.0) -> DataFrame:
    """Keep the rows strictly below the column's p-quantile; rows with NULL there go too."""
    return below(df, column, fit_quantiles(df, [Quantile(column, p, "cut")], rel_err)["cut"])


def below(df: DataFrame, column: str, cut: float | None) -> DataFrame:
    return df.where(F.col(column) < F.lit(cut).cast("double"))


def fit_caps(df: DataFrame, p: Mapping[str, float], rel_err: float = 0.0) -> dict[str, float | None]:
    """Upper caps of several columns, found together."""
    return fit_quantiles(df, [Quantile(c, at, c) for c, at in p.items()], rel_err)


def apply_caps(df: DataFrame, caps: Mapping[str, float | None]) -> DataFrame:
    """Cap at the fitted values; NULL stays NULL and integer columns stay integer."""
    types = {f.name: f.dataType for f in df.schema}

    def capped(name: str, cap: float) -> Column:
        value = F.lit(int(cap)).cast(types[name]) if isinstance(types[name], IntegralType) else F.lit(float(cap))
        return F.when(F.col(name) > value, value).otherwise(F.col(name))

    return df.withColumns({name: capped(name, cap) for name, cap in caps.items() if cap is not None})


def winsorize_upper(df: DataFrame, p: Mapping[str, float], rel_err: float = 0.0) -> DataFrame:
    return apply_caps(df, fit_caps(df, p, rel_err))


def read_digits(df: DataFrame, column: str, pattern: str = DIGITS_ONLY) -> DataFrame:
    """The column's digits as a whole number."""
    is_text = isinstance(df.schema[column].dataType, StringType)
    return df.withColumn(column, parse_count(F.col(column), pattern) if is_text else as_int(F.col(column)))


def fit_median(df: DataFrame, column: str, rel_err: float = 0.0) -> float | None:
    return fit_quantiles(df, [Quantile(column, 0.5, "m")], rel_err)["m"]


def impute_median(
    df: DataFrame, column: str, upper: float = 100, pattern: str = DIGITS_ONLY, rel_err: float = 0.0, median: float | None = None
) -> DataFrame:
    """Read the column's digits and replace missing or implausibly large values by the median.

    The median is of all values read, the implausible ones included, unless a fitted one is given.
    """
    parsed = read_digits(df, column, pattern)
    median = fit_median(parsed, column, rel_err) if median is None else median
    fixed = F.when((F.col(column) > upper) | F.col(column).isNull(), F.lit(median).cast("double"))
    return parsed.withColumn(column, fixed.otherwise(F.col(column).cast("double")))
