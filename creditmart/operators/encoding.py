"""Category encoders. The output schema depends on the vocabulary, which is either given (stable
across snapshots) or read from the data and sorted. A limit on its size is optional."""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import ArrayType

from creditmart.functions.arrays import split_list
from creditmart.session import materialized


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).distinct()


def array_vocabulary(df: DataFrame, column: str) -> DataFrame:
    """Distinct elements of an array column."""
    return df.select(F.explode(column).alias(column)).distinct()


def vocabularies(df: DataFrame, columns: Sequence[str], max_size: int | None = None) -> dict[str, list]:
    """Sorted distinct non-NULL text values (elements, for array columns) of several columns, found
    in one pass. With ``max_size``, a column with more values is refused."""

    def tagged(name: str) -> Column:
        is_array = isinstance(df.schema[name].dataType, ArrayType)
        values = F.array_distinct(name) if is_array else F.array(F.col(name))
        return F.transform(values, lambda v: F.struct(F.lit(name).alias("name"), v.alias("value")))

    entries = F.flatten(F.array(*[tagged(name) for name in columns]))
    pairs = df.select(F.inline(entries)).where("value IS NOT NULL").distinct()
    found: dict[str, list] = {name: [] for name in columns}
    if max_size is not None:
        pairs = pairs.limit(max_size * len(columns) + 1)
    for row in pairs.collect():
        found[row["name"]].append(row["value"])
    for name, values in found.items():
        if max_size is not None and len(values) > max_size:
            raise ValueError(f"{name} has more than {max_size} distinct values; it is not a category")
    return {name: sorted(values) for name, values in found.items()}


def vocabulary(df: DataFrame, column: str, max_size: int | None = None) -> list:
    return vocabularies(df, [column], max_size)[column]


def flag_name(prefix: str, value: object) -> str:
    return f"{prefix}_{re.sub('[ .-]', '_', str(value)).lower()}"


def _flag_names(prefix: str, values: Sequence, taken: Iterable[str]) -> dict[str, object]:
    """Column name of each value; two values, or a value and a column, may not share one."""
    names: dict[str, object] = {}
    used = {c.lower() for c in taken}
    for value in values:
        name = flag_name(prefix, value)
        if name in names or name in used:
            raise ValueError(f"column name {name!r} of category {value!r} is already taken")
        names[name] = value
    return names


def one_hot(df: DataFrame, column: str, values: Sequence | None = None, prefix: str | None = None) -> DataFrame:
    """Add one 0/1 column per category; NULL and unlisted values are 0 in all of them."""
    values = vocabulary(df, column) if values is None else values
    names = _flag_names(prefix or column.lower(), values, df.columns)
    flags = {n: F.when(F.col(column) == F.lit(v), F.lit(1)).otherwise(F.lit(0)) for n, v in names.items()}
    return df.withColumns(flags) if flags else df


def multi_hot(
    df: DataFrame,
    column: str,
    prefix: str,
    values: Sequence[str] | None = None,
    missing: str = "No loan",
    reference: Iterable[str] | None = None,
) -> DataFrame:
    """Add one 0/1 column per item of a delimited list column. Items in ``reference`` (by default
    the one standing for an empty list) get no column."""
    listed = "_items"
    items = df.withColumn(listed, split_list(F.col(column), missing))
    values = vocabulary(items, listed) if values is None else values
    skipped = {missing} if reference is None else set(reference)
    names = _flag_names(prefix, [v for v in values if v not in skipped], df.columns)
    flags = [F.array_contains(listed, F.lit(v)).cast("int").alias(n) for n, v in names.items()]
    return items.select(*df.columns, *flags)


# Sparse features: categories as places in one long vector, for vocabularies too large for a column each.


def _categories(df: DataFrame, columns: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """(`keep`, column, value): every category of every row once; array columns give their elements."""

    def tagged(name: str) -> Column:
        values = F.array_distinct(name) if isinstance(df.schema[name].dataType, ArrayType) else F.array(name)
        return F.transform(values, lambda v: F.struct(F.lit(name).alias("column"), v.cast("string").alias("value")))

    return df.select(*keep, F.inline(F.flatten(F.array(*[tagged(c) for c in columns])))).where("value IS NOT NULL")


def vocabulary_table(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, value, place, n_rows): all categories with their places in the vector, from 0 without gaps.

    Places go by column and by the hash of the value, so that they are counted in many small windows, and are the same for
    the same categories on any cluster.
    """
    found = _categories(df, columns).groupBy("column", "value").agg(F.count(F.lit(1)).alias("n_rows"))
    digest = F.md5(F.encode("value", "UTF-8"))
    found = materialized(found.withColumns({"_hash": digest, "_part": F.substring(digest, 1, 2)}))
    parts = found.groupBy("column", "_part").agg(F.count(F.lit(1)).alias("n"))
    earlier = Window.orderBy("column", "_part").rowsBetween(Window.unboundedPreceding, -1)  # at most 256 rows a column
    starts = parts.withColumn("_start", F.coalesce(F.sum("n").over(earlier), F.lit(0))).drop("n")
    inside = Window.partitionBy("column", "_part").orderBy("_hash", "value")
    ranked = found.withColumn("_rank", F.row_number().over(inside)).join(starts, ["column", "_part"])
    return ranked.select("column", "value", (F.col("_start") + F.col("_rank") - 1).cast("int").alias("place"), "n_rows")


def sparse_features(df: DataFrame, key: str, columns: Sequence[str], vocabulary: DataFrame) -> DataFrame:
    """(`key`, size, indices, values): each row's categories as a sparse 0/1 vector; `key` identifies a row.

    Categories that the vocabulary lacks are left out. The vocabulary is joined, so it may have any number of categories.
    """
    size = vocabulary.agg((F.coalesce(F.max("place"), F.lit(-1)) + 1).alias("size")).scalar()
    met = _categories(df, columns, [key]).join(vocabulary.select("column", "value", "place"), ["column", "value"])
    lists = met.groupBy(key).agg(F.sort_array(F.collect_set("place")).alias("indices"))
    whole = df.select(key).join(lists, key, "left").withColumn("indices", F.coalesce("indices", F.array().cast("array<int>")))
    return whole.select(key, size.cast("int").alias("size"), "indices", F.transform("indices", lambda _: F.lit(1.0)).alias("values"))
