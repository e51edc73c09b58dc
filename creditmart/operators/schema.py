"""Schema enforcement and projections by schema."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import (
    DataType, DoubleType, FloatType, IntegerType, NumericType, StringType, StructField,
)

from creditmart.functions.casting import cast_or_null


def enforce_schema(df: DataFrame, types: Mapping[str, DataType | str], only_present: bool = False) -> DataFrame:
    """Cast the named columns, all in one projection; unreadable values become NULL.

    A named column that is missing is an error unless ``only_present``. Columns that have their type
    already are passed through untouched, so that filters on them still reach the scan.
    """
    missing = [c for c in types if c not in df.columns]
    if missing and not only_present:
        raise ValueError(f"columns missing from the input: {missing}")

    def typed(field: StructField) -> Column:
        c, target = F.col(field.name), types.get(field.name, field.dataType)
        if target in (field.dataType, field.dataType.simpleString()):
            return c
        is_text = isinstance(field.dataType, StringType)
        return (cast_or_null(c, target) if is_text else c.try_cast(target)).alias(field.name)

    return df.select(*[typed(field) for field in df.schema])


def rejected_cells(df: DataFrame, types: Mapping[str, DataType | str]) -> Column:
    """An array of the cells (column, text, rule) whose text the cast to the named type cannot read; blank text is such a cell."""
    cells = []
    for field in df.schema:
        target = types.get(field.name, field.dataType)
        if isinstance(field.dataType, StringType) and target not in (field.dataType, field.dataType.simpleString()):
            c, rule = F.col(field.name), target if isinstance(target, str) else target.simpleString()
            cell = F.struct(F.lit(field.name).alias("column"), c.alias("text"), F.lit(rule).alias("rule"))
            cells.append(F.when(c.isNotNull() & cast_or_null(c, target).isNull(), cell))
    if not cells:
        return F.array().cast("array<struct<column:string,text:string,rule:string>>")
    return F.array_compact(F.array(*cells))


def enforce_with_rejects(df: DataFrame, types: Mapping[str, DataType | str], only_present: bool = False, name: str = "_rejected") -> DataFrame:
    """The typed rows, with the cells of each that no cast could read in one more column: both in one pass."""
    kept = df.withColumn(name, rejected_cells(df, types))
    return enforce_schema(kept, types, only_present)


def quarantine(typed: DataFrame, keys: Iterable[str], name: str = "_rejected") -> DataFrame:
    """The unreadable cells, a row each: the row's keys, column, text and rule."""
    return typed.where(F.size(name) > 0).select(*keys, F.inline(name))


def drop_columns(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """Drop by name, ignoring case and names that are absent."""
    unwanted = {n.lower() for n in names}
    return df.select(*[c for c in df.columns if c.lower() not in unwanted])


def numeric_columns(df: DataFrame, all_numeric: bool = False) -> list[str]:
    """Names of int, float and double columns, or of every numeric column."""
    kinds = NumericType if all_numeric else (IntegerType, FloatType, DoubleType)
    return [f.name for f in df.schema if isinstance(f.dataType, kinds)]


def select_numeric(df: DataFrame, all_numeric: bool = False) -> DataFrame:
    return df.select(*numeric_columns(df, all_numeric))


def columns_with_prefix(df: DataFrame, prefix: str) -> list[str]:
    return [c for c in df.columns if c.startswith(prefix)]


def select_prefix(df: DataFrame, prefix: str, keep: Iterable[str] = ()) -> DataFrame:
    return df.select(*keep, *columns_with_prefix(df, prefix))


def columns_except(df: DataFrame, excluded: Iterable[str]) -> list[str]:
    unwanted = set(excluded)
    return [c for c in df.columns if c not in unwanted]


def select_except(df: DataFrame, excluded: Iterable[str]) -> DataFrame:
    return df.select(*columns_except(df, excluded))
