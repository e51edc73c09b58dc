"""Statistics of a table's snapshots as rows that can be kept and merged: a new snapshot costs that snapshot.

A state is a row for each snapshot and column: how many values there are, their mean, range and sums of powers of the distance
to the mean, and a KLL sketch of them. Merged states are those of all their rows together; moments come out as if all rows had
been read at once (but for rounding), sketches keep their promised error of rank.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

#: Size of a sketch: the error of a rank is about 1/K of the rows, in 99 of 100 cases below 2/K.
K = 1_000


def _cells(df: DataFrame, columns: Sequence[str], by: Sequence[str]) -> DataFrame:
    """A row for each value: `by`, the column's name, the value as double; NaN is a missing value."""
    known = [F.struct(F.lit(c).alias("column"), F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double")).alias("v")) for c in columns]
    return df.select(*by, F.inline(F.array(*known)))


def moments(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ("snapshot_date",)) -> DataFrame:
    """States (`by`, column, rows, n, mean, m2, m3, m4, least, most) in one aggregation; m2 to m4 are sums of powers."""
    v, n = F.col("v"), F.count("v")
    m2 = F.var_pop(v) * n
    found = _cells(df, columns, by).groupBy(*by, "column").agg(
        F.count(F.lit(1)).alias("rows"), n.alias("n"), F.avg(v).alias("mean"), m2.alias("m2"),
        F.coalesce(F.nanvl(F.skewness(v), F.lit(0.0)) * n * F.pow(m2 / F.nullif(n, F.lit(0)), 1.5), F.lit(0.0)).alias("m3"),
        F.coalesce((F.nanvl(F.kurtosis(v), F.lit(-3.0)) + 3) * n * F.pow(m2 / F.nullif(n, F.lit(0)), 2), F.lit(0.0)).alias("m4"),
        F.min(v).alias("least"), F.max(v).alias("most"),
    )
    # equal values do not vary; the rounding of merged buffers would show as variation
    same = F.col("least") == F.col("most")
    return found.withColumns({"mean": F.when(same, F.col("least")).otherwise(F.col("mean"))} | {m: F.when(same, 0.0).otherwise(F.col(m)) for m in ("m2", "m3", "m4")})


def merged(states: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """The states of fewer groups: those of the named columns, or of everything."""
    groups = [*by, "column"]
    everyone = Window.partitionBy(*groups)
    mean = F.try_divide(F.sum(F.col("n") * F.col("mean")).over(everyone), F.sum("n").over(everyone))
    # the mean of equal values is that value, without the rounding of sums that would show as variation
    least, most = F.min("least").over(everyone), F.max("most").over(everyone)
    mean = F.when(least == most, least).otherwise(mean)
    n, d = F.col("n"), F.col("mean") - F.col("whole")
    powers = {
        "m2": F.col("m2") + n * d * d,
        "m3": F.col("m3") + 3 * d * F.col("m2") + n * F.pow(d, 3),
        "m4": F.col("m4") + 4 * d * F.col("m3") + 6 * d * d * F.col("m2") + n * F.pow(d, 4),
    }
    moved = states.withColumn("whole", mean).withColumns(powers | {"mean": F.col("whole")})
    return moved.groupBy(*groups).agg(
        F.sum("rows").alias("rows"), F.sum("n").alias("n"), F.first("mean", ignorenulls=True).alias("mean"),
        *[F.coalesce(F.sum(m), F.lit(0.0)).alias(m) for m in powers], F.min("least").alias("least"), F.max("most").alias("most"),
    )


def profile_of(states: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Count, nulls, mean, sample deviation, range, skewness and excess kurtosis from states."""
    n, m2 = F.col("n"), F.col("m2")
    return states.select(
        *by, "column", n.alias("count"), (F.col("rows") - n).alias("null_count"), "mean",
        F.when(n > 1, F.sqrt(m2 / (n - 1))).alias("stddev"), F.col("least").alias("min"), F.col("most").alias("max"),
        F.when(m2 > 0, F.sqrt(n.cast("double")) * F.col("m3") / F.pow(m2, 1.5)).alias("skewness"),
        F.when(m2 > 0, n * F.col("m4") / (m2 * m2) - 3).alias("kurtosis"),
    )


def sketches(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ("snapshot_date",), k: int = K) -> DataFrame:
    """(`by`, column, n, sketch): a KLL sketch of each snapshot and column, as a binary column."""
    cells = _cells(df, columns, by).where("v IS NOT NULL")
    return cells.groupBy(*by, "column").agg(F.count("v").alias("n"), F.kll_sketch_agg_double("v", k).alias("sketch"))


def merged_sketches(states: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    return states.groupBy(*by, "column").agg(F.sum("n").alias("n"), F.kll_merge_agg_double("sketch").alias("sketch"))


def quantiles_of(states: DataFrame, wanted: Mapping[str, float], by: Sequence[str] = ()) -> DataFrame:
    """The columns of each state with a column for every wanted quantile."""

    def at(p: float) -> Column:
        return F.kll_sketch_get_quantile_double("sketch", F.lit(float(p)))

    return states.select(*by, "column", "n", *[at(p).alias(name) for name, p in wanted.items()])
