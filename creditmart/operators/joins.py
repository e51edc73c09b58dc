"""Equi-joins. Spark picks the strategy from real sizes; a hot key can be salted explicitly."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from creditmart.session import materialized


def equi_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Join on equally named keys; any other column name may occur on one side only."""
    keys = list(keys)
    shared = {c.lower() for c in left.columns} & {c.lower() for c in right.columns} - {k.lower() for k in keys}
    if shared:
        raise ValueError(f"columns on both sides that are not keys: {sorted(shared)}")
    return left.join(right, keys, how)


def hot_key_hashes(df: DataFrame, keys: Sequence[str], share: float = 0.01) -> list[int]:
    """Hashes of the keys that hold more than ``share`` of the rows: at most 1/share of them. The rows are read once; their
    counts are stored, for they are needed twice."""
    counts = materialized(df.groupBy(F.xxhash64(*keys).alias("h")).agg(F.count(F.lit(1)).alias("n")))
    total = counts.agg(F.sum("n")).scalar()
    return [r["h"] for r in counts.where(F.col("n") > F.lit(share) * total).select("h").collect()]


def lookup_join(
    fact: DataFrame, dimension: DataFrame, keys: Sequence[str], how: str = "inner", salts: int = 0
) -> DataFrame:
    """Join facts to a dimension with one row per key.

    With ``salts`` the rows of hot keys are spread over that many tasks, and only those keys'
    dimension rows are repeated as often. A row's task depends on its content and its partition:
    equal rows are spread too, and a task that is run again sends its rows where they went before.
    """
    hot = hot_key_hashes(fact, keys) if salts > 1 else []
    if not hot:
        return equi_join(fact, dimension, keys, how)
    is_hot = F.xxhash64(*keys).isin(hot)
    row = F.xxhash64(*fact.columns, F.spark_partition_id())
    spread = F.when(is_hot, F.pmod(row, F.lit(salts))).otherwise(F.lit(0)).cast("int")
    copies = F.when(is_hot, F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
    salted = equi_join(
        fact.withColumn("_salt", spread),
        dimension.withColumn("_salt", F.explode(copies)),
        [*keys, "_salt"],
        how,
    )
    return salted.drop("_salt")


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def require_unique(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The frame itself, after checking that the keys identify its rows. All tasks look at once, not a few first."""
    found = duplicate_keys(df, keys)
    twice = found.agg(F.first(F.struct(*found.columns))).first()[0]
    if twice is not None:
        raise ValueError(f"key {tuple(twice[k] for k in keys)} occurs {twice['n']} times")
    return df


def as_of_join(fact: DataFrame, dimension: DataFrame, keys: Sequence[str], on: str, salts: int = 0) -> DataFrame:
    """Each fact row with its key's newest dimension row not dated after it; facts without one are left out.

    Facts and dimension rows go into one frame, sorted by key and date, and a running window carries the last dimension row on
    to the facts after it: one shuffle, whatever lies between the dates. A key has one dimension row a date. ``salts`` spreads
    the facts of hot keys over that many tasks, each of which gets those keys' dimension rows. NULL keys and dates meet nothing.
    """
    values = [c for c in dimension.columns if c not in (*keys, on)]
    shared = {c.lower() for c in fact.columns} & {c.lower() for c in values}
    if shared:
        raise ValueError(f"columns on both sides that are not keys: {sorted(shared)}")
    hot = hot_key_hashes(fact, keys) if salts > 1 else []
    found = F.struct(F.col(on).alias("_since"), *values).alias("_found")
    # Facts are shuffled as they are: their keys and dates serve as those of the frame, and have columns beside them only where
    # the dimension's are of other types. A dimension row has NULL in the other columns.
    types, others = ({f.name.lower(): f.dataType for f in df.schema} for df in (fact, dimension))
    met = {c.lower(): c if types[c.lower()] == others[c.lower()] else f"_at_{c}" for c in (*keys, on)}
    beside = [F.col(c).alias(n) for c, n in met.items() if n.lower() != c]
    lacking = [F.lit(None).cast(types[c.lower()]).alias(c) for c in fact.columns if met.get(c.lower(), "").lower() != c.lower()]
    facts = fact.select(*fact.columns, *beside, F.lit(1).alias("_kind"), F.lit(None).cast(dimension.select(found).schema[0].dataType).alias("_found"))
    dated = dimension.select(*[F.col(c).alias(n) for c, n in met.items()], *lacking, F.lit(0).alias("_kind"), found)
    parts = [met[k.lower()] for k in keys]
    if hot:
        is_hot, parts = F.xxhash64(*keys).isin(hot), [*parts, "_salt"]
        row = F.xxhash64(*fact.columns, F.spark_partition_id())
        facts = facts.withColumn("_salt", F.when(is_hot, F.pmod(row, F.lit(salts))).otherwise(F.lit(0)).cast("int"))
        copies = F.when(is_hot, F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
        dated = dated.withColumn("_salt", F.explode(copies))
    both = facts.unionByName(dated)
    for c in met.values():
        both = both.where(F.col(c).isNotNull())
    before = Window.partitionBy(*parts).orderBy(met[on.lower()], "_kind").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    carried = both.withColumn("_found", F.last("_found", ignorenulls=True).over(before)).where("_kind = 1 AND _found IS NOT NULL")
    return carried.select(*fact.columns, "_found.*").drop("_since")
