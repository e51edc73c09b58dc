"""Profiles of a table: column statistics, frequencies, correlations, histograms and densities.

All columns are measured in one pass; results are long tables with one row per column, pair, bin or
grid point.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from creditmart.operators.quantiles import Quantile, approx_quantiles, exact_quantiles
from creditmart.operators.schema import numeric_columns


def _long(row: DataFrame, entries: Sequence[Column]) -> DataFrame:
    """One wide row to one row per struct."""
    return row.select(F.inline(F.array(*entries)))


def _spread(part: str, i: int) -> Column:
    """The measured part of column i. Equal values have exact ones: rounding of merged buffers would show as variation."""
    same = (F.col(f"min_{i}") == F.col(f"max_{i}")) & ~F.isnan(f"max_{i}")
    equal = {"mean": F.col(f"min_{i}"), "stddev": F.when(F.col(f"count_{i}") > 1, 0.0)}
    return F.when(same, equal.get(part, F.lit(None).cast("double"))).otherwise(F.col(f"{part}_{i}"))


def numeric_profile(df: DataFrame, columns: Sequence[str] | None = None, median: str = "exact") -> DataFrame:
    """Per column: count, nulls, mean, sample stddev, min, max, skewness, excess kurtosis, median.

    Skewness and kurtosis are of the population. ``median`` is 'exact' or 'approx' (one sketch).
    """
    columns = list(columns or numeric_columns(df))
    wanted = [Quantile(c, 0.5, c) for c in columns]
    medians = exact_quantiles(df, wanted) if median == "exact" else approx_quantiles(df, wanted, 1e-4)
    aggs = [F.count(F.lit(1)).alias("rows")]
    for i, c in enumerate(columns):
        v = F.col(c).cast("double")
        aggs += [
            F.count(v).alias(f"count_{i}"), F.avg(v).alias(f"mean_{i}"), F.stddev(v).alias(f"stddev_{i}"),
            F.min(v).alias(f"min_{i}"), F.max(v).alias(f"max_{i}"),
            F.skewness(v).alias(f"skewness_{i}"), F.kurtosis(v).alias(f"kurtosis_{i}"),
        ]
    entries = [
        F.struct(
            F.lit(c).alias("column"),
            F.col(f"count_{i}").alias("count"),
            (F.col("rows") - F.col(f"count_{i}")).alias("null_count"),
            *[_spread(part, i).alias(part) for part in ("mean", "stddev")],
            *[F.col(f"{part}_{i}").alias(part) for part in ("min", "max")],
            *[_spread(part, i).alias(part) for part in ("skewness", "kurtosis")],
            F.lit(medians[c]).cast("double").alias("median"),
        )
        for i, c in enumerate(columns)
    ]
    return _long(df.agg(*aggs), entries)


def describe(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Per column: count, mean, std, min, quartiles (linear interpolation) and max."""
    columns = list(columns or numeric_columns(df))
    quartiles = {"p25": 0.25, "p50": 0.5, "p75": 0.75}
    q = exact_quantiles(df, [Quantile(c, p, f"{c}.{n}", "linear") for c in columns for n, p in quartiles.items()])
    aggs = []
    for i, c in enumerate(columns):
        v = F.col(c).cast("double")
        aggs += [
            F.count(v).alias(f"count_{i}"), F.avg(v).alias(f"mean_{i}"), F.stddev(v).alias(f"stddev_{i}"),
            F.min(v).alias(f"min_{i}"), F.max(v).alias(f"max_{i}"),
        ]
    entries = [
        F.struct(
            F.lit(c).alias("column"),
            F.col(f"count_{i}").alias("count"), _spread("mean", i).alias("mean"), _spread("stddev", i).alias("std"),
            F.col(f"min_{i}").alias("min"),
            *[F.lit(q[f"{c}.{n}"]).cast("double").alias(n) for n in quartiles],
            F.col(f"max_{i}").alias("max"),
        )
        for i, c in enumerate(columns)
    ]
    return _long(df.agg(*aggs), entries)


def column_info(df: DataFrame) -> DataFrame:
    """Per column: non-null count and type."""
    counts = df.agg(*[F.count(c).alias(f"c{i}") for i, c in enumerate(df.columns)])
    entries = [
        F.struct(
            F.lit(f.name).alias("column"),
            F.col(f"c{i}").alias("non_null"),
            F.lit(f.dataType.simpleString()).alias("dtype"),
        )
        for i, f in enumerate(df.schema)
    ]
    return _long(counts, entries)


def value_counts(df: DataFrame, column: str, normalize: bool = False, keep_null: bool = True) -> DataFrame:
    """Rows per value, most frequent first; with ``normalize`` also their percentage."""
    rows = df if keep_null else df.where(F.col(column).isNotNull())
    counts = rows.groupBy(column).agg(F.count(F.lit(1)).alias("count"))
    if normalize:
        total = counts.agg(F.sum("count")).scalar()
        counts = counts.withColumn("pct", F.col("count") * 100.0 / total)
    return counts.orderBy(F.desc("count"), column)


def _known(column: str) -> Column:
    """The column as double, NaN as NULL."""
    return F.nanvl(F.col(column).cast("double"), F.lit(None).cast("double"))


#: Columns whose pairs are measured by an aggregate each; more go through products of blocks of rows.
FEW = 6


def correlations(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Pearson matrix in long form (a, b, r, i, j with 0-based positions).

    Each pair uses the rows where both are known; NaN counts as missing. A pair of which one is constant has no correlation.
    """
    columns = list(columns or numeric_columns(df))
    names = F.expr(f"array({', '.join(repr(c) for c in columns)})")
    known = df.select(*[_known(c).alias(f"c{i}") for i, c in enumerate(columns)])
    if len(columns) <= FEW:
        pairs = list(combinations(range(len(columns)), 2))
        entries = [F.struct(F.lit(i).alias("i"), F.lit(j).alias("j"), F.col(f"r{i}_{j}").alias("r")) for i, j in pairs]
        entries += [F.struct(F.lit(j).alias("i"), F.lit(i).alias("j"), F.col(f"r{i}_{j}").alias("r")) for i, j in pairs]
        found = known.agg(F.lit(1), *[_corr(F.col(f"c{i}"), F.col(f"c{j}")).alias(f"r{i}_{j}") for i, j in pairs])
        found = _long(found, entries + [F.struct(F.lit(i).alias("i"), F.lit(i).alias("j"), F.lit(1.0).alias("r")) for i in range(len(columns))])
    else:
        found = _masked_gram(known)
    return found.select(names[F.col("i")].alias("a"), names[F.col("j")].alias("b"), F.nanvl("r", F.lit(None).cast("double")).alias("r"), "i", "j")


#: Variation that is rounding only, as a share of the squares it is left over from.
NOISE = 1e-13


def _masked_gram(known: DataFrame) -> DataFrame:
    """(i, j, r) of all pairs of columns that may have gaps, in one pass of matrix products.

    Gaps become 0 and a mask tells them apart: products of values and masks give, for every pair, the rows where both are
    known, either one's sums and squares there, and the cross products. Each batch is centred on its own means, so that little is
    lost in the differences, and merged with those before by the distance of the means, which are kept as distances to a value of
    the column. Tasks give a row for each pair, which are merged alike. The rows are read once.
    """
    columns = known.columns

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = len(columns)
        n, mean, square, cross = np.zeros((4, k, k))
        origin: list[float | None] = [None] * k
        for batch in batches:
            m = np.column_stack([batch.column(i).is_valid().to_numpy(zero_copy_only=False) for i in range(k)]).astype(np.float64)
            centre, values = np.zeros(k), []
            for i in range(k):
                v, own = batch.column(i).drop_null().to_numpy(), np.zeros(batch.num_rows)
                if len(v):
                    origin[i] = v[0] if origin[i] is None else origin[i]
                    v = v - origin[i]
                    centre[i] = v.mean()
                    own[m[:, i] > 0] = v - centre[i]
                values.append(own)
            x = np.column_stack(values)
            count, s, q = m.T @ m, x.T @ m, (x * x).T @ m
            some = np.maximum(count, 1)
            spread = q - s * s / some
            spread = np.where(spread > q * NOISE, spread, 0 * q)
            both, d = n + count, centre[:, None] + s / some - mean
            d = np.where(count > 0, d, 0)
            weight = n * count / np.maximum(both, 1)
            square += spread + d * d * weight
            cross += x.T @ x - s * s.T / some + d * d.T * weight
            mean += d * count / np.maximum(both, 1)
            n = both
        i, j = (x.reshape(-1).astype(np.int32) for x in np.indices((k, k)))
        at = np.repeat(np.array([0.0 if o is None else o for o in origin])[:, None], k, axis=1)
        sums = [x.reshape(-1) for x in (n, at, at.T, mean, mean.T, square, square.T, cross)]
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in (i, j, *sums)], names=["i", "j", "n", "ox", "oy", "mx", "my", "qx", "qy", "c"])

    parts = known.mapInArrow(products, "i int, j int, n double, ox double, oy double, mx double, my double, qx double, qy double, c double").where("n > 0")
    pair = Window.partitionBy("i", "j")
    moved = {v: F.col(f"o{v}") - F.min(f"o{v}").over(pair) for v in "xy"}
    parts = parts.withColumns({f"m{v}": moved[v] + F.col(f"m{v}") for v in "xy"} | {f"s{v}": F.abs(moved[v]) + F.abs(f"m{v}") for v in "xy"})
    d = {v: F.col(f"m{v}") - F.col(f"a{v}") for v in "xy"}
    parts = parts.withColumns({f"a{v}": F.sum(F.col("n") * F.col(f"m{v}")).over(pair) / F.sum("n").over(pair) for v in "xy"})
    sums = parts.groupBy("i", "j").agg(
        F.sum("n").alias("n"), F.max("sx").alias("sx"), F.max("sy").alias("sy"),
        *[F.sum(F.col(f"q{v}") + F.col("n") * d[v] * d[v]).alias(f"q{v}") for v in "xy"], F.sum(F.col("c") + F.col("n") * d["x"] * d["y"]).alias("c"),
    )
    k = len(columns)
    sums = known.sparkSession.range(k * k).selectExpr(f"int(id div {k}) AS i", f"int(id % {k}) AS j").join(sums, ["i", "j"], "left")
    vary = [F.col(f"q{v}") > F.col("n") * F.pow(NOISE * F.col(f"s{v}"), 2) for v in "xy"]
    r = F.greatest(F.lit(-1.0), F.least(F.lit(1.0), F.col("c") / F.sqrt("qx") / F.sqrt("qy")))
    return sums.select("i", "j", F.when(F.col("i") == F.col("j"), 1.0).when(vary[0] & vary[1], r).alias("r"))


def _corr(a: Column, b: Column) -> Column:
    """Pearson's r over the rows where both are known, NULL where either is constant (F.corr fails there in ANSI mode)."""
    both = [F.when(b.isNotNull(), a), F.when(a.isNotNull(), b)]
    vary = [F.min(c) < F.max(c) for c in both]  # deviations of equal values may be rounding
    return F.when(vary[0] & vary[1], F.try_divide(F.covar_pop(a, b), F.stddev_pop(both[0]) * F.stddev_pop(both[1])))


def correlation_matrix(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The same matrix by matrix products, however few the columns are."""
    known = df.select(*[_known(c).alias(f"c{i}") for i, c in enumerate(columns)])
    names = F.expr(f"array({', '.join(repr(c) for c in columns)})")
    return _masked_gram(known).select(names[F.col("i")].alias("a"), names[F.col("j")].alias("b"), "r", "i", "j")


def high_correlations(matrix: DataFrame, threshold: float = 0.7) -> DataFrame:
    """Pairs of different columns with |r| above the threshold, strongest first."""
    pairs = matrix.where((F.col("i") < F.col("j")) & (F.abs("r") > threshold))
    return pairs.orderBy(F.abs("r").desc(), "a", "b").select("a", "b", "r")


def lower_triangle(matrix: DataFrame) -> DataFrame:
    """The matrix below its diagonal."""
    return matrix.where(F.col("j") < F.col("i"))


def histogram(df: DataFrame, columns: Sequence[str], bins: int = 10) -> DataFrame:
    """Rows per equal-width bin between each column's minimum and maximum; empty bins count 0.

    Bins are closed on the left, the last one also on the right. NaN counts as missing; a column without values has no bins.
    """
    ranges = df.agg(
        *[F.min(_known(c)).alias(f"lo{i}") for i, c in enumerate(columns)],
        *[F.max(_known(c)).alias(f"hi{i}") for i, c in enumerate(columns)],
    ).first()
    known = [i for i in range(len(columns)) if ranges[f"lo{i}"] is not None]
    if not known:
        return df.sparkSession.createDataFrame([], "column string, bin int, lower double, upper double, n bigint")

    def bin_of(i: int) -> Column:
        lo, hi = ranges[f"lo{i}"], ranges[f"hi{i}"]
        if lo == hi:
            return F.when(_known(columns[i]).isNotNull(), F.lit(0))
        at = F.floor((_known(columns[i]) - F.lit(lo)) / F.lit(hi - lo) * F.lit(float(bins)))
        return F.when(at.isNotNull(), F.least(at.cast("int"), F.lit(bins - 1)))

    def edge(i: int, k: Column) -> Column:
        lo, hi = ranges[f"lo{i}"], ranges[f"hi{i}"]
        return F.lit(lo) + k * F.lit((hi - lo) / bins)

    entries = [F.struct(F.lit(columns[i]).alias("column"), bin_of(i).alias("bin")) for i in known]
    counts = (
        df.select(F.inline(F.array(*entries)))
        .where(F.col("bin").isNotNull())
        .groupBy("column", "bin")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    k = F.col("id").cast("int")
    frame = df.sparkSession.range(bins).select(
        k.alias("bin"),
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(columns[i]).alias("column"), edge(i, k).alias("lower"), edge(i, k + 1).alias("upper")
                    )
                    for i in known
                ]
            )
        ),
    )
    return frame.join(counts, ["column", "bin"], "left").select(
        "column", "bin", "lower", "upper", F.coalesce("n", F.lit(0)).cast("bigint").alias("n")
    )


# Beyond this many bandwidths a Gaussian kernel is below the precision of a double.
KERNEL_REACH = 8.5


def density(df: DataFrame, column: str, points: int = 200, cut: float = 3.0) -> DataFrame:
    """``densities`` of one column: rows (x, density)."""
    return densities(df, [column], points, cut).select("x", "density")


def densities(df: DataFrame, columns: Sequence[str], points: int = 200, cut: float = 3.0) -> DataFrame:
    """Gaussian kernel densities (Scott's bandwidth) of all columns in two passes: rows (column, x, density) on an even grid
    that reaches ``cut`` bandwidths beyond the data. A column of fewer than two different values has none.

    A value adds to the grid points within its kernel's reach only. The bandwidth shrinks with the
    number of rows, so on a large table these are few, and they are summed before the shuffle.
    Rows are counted by value first; NaN counts as missing.
    """
    s = df.agg(
        *[
            a.alias(f"{name}{i}")
            for i, c in enumerate(columns)
            for name, a in (
                ("n", F.count(_known(c))), ("std", F.stddev(_known(c))), ("lo", F.min(_known(c))), ("hi", F.max(_known(c))),
            )
        ]
    ).first()
    grids = []
    for i, c in enumerate(columns):
        n, std = s[f"n{i}"], s[f"std{i}"]
        if n and std and s[f"lo{i}"] < s[f"hi{i}"]:
            width = std * n ** -0.2
            start = s[f"lo{i}"] - cut * width
            step = (s[f"hi{i}"] + cut * width - start) / (points - 1)
            grids.append((c, n * width * math.sqrt(2 * math.pi), width, start, step))
    if not grids:
        return df.sparkSession.createDataFrame([], "column string, x double, density double")
    entries = [
        F.struct(
            F.lit(c).alias("column"), _known(c).alias("v"), F.lit(scale).alias("scale"), F.lit(width).alias("width"),
            F.lit(start).alias("start"), F.lit(step).alias("step"),
        )
        for c, scale, width, start, step in grids
    ]
    shape = ("column", "scale", "width", "start", "step")
    values = df.select(F.inline(F.array(*entries))).where("v is not null")
    values = values.groupBy(*shape, "v").agg(F.count(F.lit(1)).alias("n"))

    def grid_index(x: Column) -> Column:
        return F.least(F.greatest(x, F.lit(0)), F.lit(points - 1)).cast("int")

    reach = KERNEL_REACH * F.col("width")
    first = grid_index(F.ceil((F.col("v") - (F.col("start") + reach)) / F.col("step")))
    last = grid_index(F.floor((F.col("v") - (F.col("start") - reach)) / F.col("step")))
    touched = values.where(first <= last).select(*shape, "v", "n", F.explode(F.sequence(first, last)).alias("k"))
    x = F.col("start") + F.col("k") * F.col("step")
    kernel = F.exp(-0.5 * F.pow((x - F.col("v")) / F.col("width"), 2))
    sums = touched.groupBy("column", "k").agg(F.sum(F.col("n") * kernel / F.col("scale")).alias("density"))
    lines = F.array(
        *[
            F.struct(F.lit(c).alias("column"), (F.lit(start) + F.col("k") * F.lit(step)).alias("x"))
            for c, _, _, start, step in grids
        ]
    )
    grid = df.sparkSession.range(points).select(F.col("id").cast("int").alias("k"))
    grid = grid.select("k", F.inline(lines))
    return grid.join(sums, ["column", "k"], "left").select("column", "x", F.coalesce("density", F.lit(0.0)).alias("density"))


def distributions(
    df: DataFrame, columns: Sequence[str] | None = None, bins: int = 30, points: int = 200
) -> dict[str, DataFrame]:
    """What distribution plots of the numeric columns show: ``bins``, ``densities`` and ``statistics``."""
    columns = list(columns or numeric_columns(df))
    return {
        "bins": histogram(df, columns, bins),
        "densities": densities(df, columns, points),
        "statistics": numeric_profile(df, columns),
    }
