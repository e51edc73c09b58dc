"""Ranks and running totals over a whole table, without a single-task window.

A global running total is split into ranges of the key: totals per range (few rows) give each range
its starting value, and a window inside each range does the rest.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window, functions as F

#: Keys in a range, and the fewest and most ranges: the totals per range go through one task.
RANGE_ROWS, FEWEST, MOST = 10_000, 8, 100_000
HASH_PREFIX = 4


def running_totals(groups: DataFrame, key: str, sums: Sequence[str], ranges: int | None = None) -> DataFrame:
    """Add ``<sum>_before`` (total over smaller keys) and ``<sum>_next`` (value of the next larger
    key, NULL at the end) to a table with one row per numeric key, which is read twice or more.

    The number of ranges follows the number of keys unless given."""
    if ranges is None:
        ranges = min(max(groups.count() // RANGE_ROWS, FEWEST), MOST)
    steps = [i / ranges for i in range(1, ranges)]
    cuts = groups.agg(F.percentile_approx(F.col(key).cast("double"), steps, max(10_000, 4 * ranges))).first()[0] or [0.0]
    splits = [float("-inf"), *sorted(set(cuts)), float("inf")]
    keyed = groups.where(F.col(key).isNotNull()).withColumn("_key", F.col(key).cast("double"))
    ranged = Bucketizer(splits=splits, inputCol="_key", outputCol="_range").transform(keyed).drop("_key")

    # At most one row per range, so the unpartitioned window and the broadcast are bounded.
    by_range = Window.orderBy("_range")
    before = by_range.rowsBetween(Window.unboundedPreceding, -1)
    starts = ranged.groupBy("_range").agg(
        *[F.sum(s).alias(s) for s in sums], *[F.min_by(s, key).alias(f"{s}_first") for s in sums]
    )
    starts = starts.select(
        "_range",
        *[F.coalesce(F.sum(s).over(before), F.lit(0)).alias(f"{s}_start") for s in sums],
        *[F.lead(f"{s}_first").over(by_range).alias(f"{s}_following") for s in sums],
    )
    in_range = Window.partitionBy("_range").orderBy(key)
    smaller = in_range.rowsBetween(Window.unboundedPreceding, -1)
    return ranged.join(F.broadcast(starts), "_range").select(
        *groups.columns,
        *[(F.col(f"{s}_start") + F.coalesce(F.sum(s).over(smaller), F.lit(0))).alias(f"{s}_before") for s in sums],
        *[F.coalesce(F.lead(s).over(in_range), F.col(f"{s}_following")).alias(f"{s}_next") for s in sums],
    )


def row_hash(ids: Sequence[str], seed: int) -> Column:
    """Hex digest that orders rows at random but reproducibly."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), *[F.col(c).cast("string") for c in ids]))


def hash_rank(df: DataFrame, stratum: str, ids: Sequence[str], seed: int, name: str = "rank") -> DataFrame:
    """Exact 1-based rank of each row in its stratum, in hash order; ``ids`` identify a row.

    Rows are windowed by (stratum, hash prefix), which splits even a stratum that holds most rows
    into tens of thousands of equal parts. The parts' starting ranks are joined on the same two
    keys, so the rows are shuffled once. Rows without a stratum are left out.
    """
    hashed = df.withColumn("_hash", row_hash(ids, seed)).withColumn("_part", F.substring("_hash", 1, HASH_PREFIX))
    in_stratum = Window.partitionBy(stratum).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    # At most 16^HASH_PREFIX rows per stratum.
    starts = (
        hashed.groupBy(stratum, "_part")
        .agg(F.count(F.lit(1)).alias("n"))
        .select(stratum, "_part", F.coalesce(F.sum("n").over(in_stratum), F.lit(0)).alias("_start"))
    )
    in_part = Window.partitionBy(stratum, "_part").orderBy("_hash", *ids)
    return (
        hashed.join(starts, [stratum, "_part"])
        .select(*df.columns, (F.col("_start") + F.row_number().over(in_part)).cast("bigint").alias(name))
    )


def hash_cutoffs(df: DataFrame, stratum: str, ids: Sequence[str], seed: int, share: float) -> dict:
    """Per stratum, the (hash, ids...) of the row whose hash-order rank is round(share * rows).

    Strata of which no row is wanted are left out. Two passes: count hash prefixes, then rank only
    the rows that share the deciding prefix.
    """
    hashed = df.where(F.col(stratum).isNotNull()).select(stratum, *[c for c in ids if c != stratum]).withColumn("_hash", row_hash(ids, seed))
    hashed = hashed.withColumn("_part", F.substring("_hash", 1, HASH_PREFIX))
    whole = Window.partitionBy(stratum)
    running = whole.orderBy("_part").rowsBetween(Window.unboundedPreceding, 0)
    counts = hashed.groupBy(stratum, "_part").agg(F.count(F.lit(1)).alias("n"))
    deciding = (
        counts.withColumn("upto", F.sum("n").over(running))
        .withColumn("wanted", F.round(F.lit(share) * F.sum("n").over(whole)).cast("bigint"))
        .where((F.col("upto") >= F.col("wanted")) & (F.col("upto") - F.col("n") < F.col("wanted")))
        .select(stratum, "_part", (F.col("wanted") - F.col("upto") + F.col("n")).alias("_wanted"))
    )
    order = Window.partitionBy(stratum).orderBy("_hash", *ids)
    rows = (
        hashed.join(deciding, [stratum, "_part"])
        .withColumn("_place", F.row_number().over(order))
        .where(F.col("_place") == F.col("_wanted"))
        .collect()
    )
    return {r[stratum]: (r["_hash"], *[r[c] for c in ids]) for r in rows}
