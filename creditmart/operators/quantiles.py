"""Quantiles over columns of any size.

``percentile`` and ``percentile_disc`` keep every distinct value of a column in one aggregation buffer, which a large
continuous column does not survive. The exact operator selects by digits instead: every value is turned into a whole number
of 64 bits in the same order, and rows are counted by the number's upper 16 bits, then, under the upper bits that hold a
wanted rank, by the next 16, and so on. All columns and ranks are found together, in at most four passes; a pass shuffles
counts only, and only what the wanted ranks need reaches the driver. Few rows left under the wanted bits are counted by the
whole number at once, and bits under which all rows are equal need no further pass. Tasks count blocks of values by numpy.
"""

from __future__ import annotations

import math
import struct
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Row, Window, functions as F
from pyspark.sql.types import IntegralType

#: Bits of a digit, and rows that are counted by their whole number.
DIGIT, COUNT_ALL_BELOW = 16, 100_000
#: Values that a task counts at a time.
BLOCK = 1 << 20
# The parts of a double.
FRACTION, BIAS, LEAST_NORMAL = 52, 1023, 2.0**-1022


@dataclass(frozen=True)
class Quantile:
    """One wanted quantile of a column; ``method`` is 'disc' (a data value) or 'linear'."""

    column: str
    p: float
    name: str
    method: str = "disc"

    def combine(self, n: int, values: list[float]) -> float | None:
        if not values:
            return None
        if self.method == "disc":
            return values[0]
        at = self.p * (n - 1)
        return values[0] + (values[1] - values[0]) * (at - math.floor(at))


def order_key(value: Column) -> Column:
    """A double as a whole number in the same order: its IEEE 754 bits, negative for a negative one. NaN comes last.

    The exact quantiles make the same keys from blocks of values.
    """
    size = F.abs(value)
    power = F.floor(F.log2(size))
    # the logarithm may be rounded over the next power
    power = F.when(F.pow(F.lit(2.0), power) > size, power - 1).when(F.pow(F.lit(2.0), power) * 2 <= size, power + 1).otherwise(power)
    fraction = ((size / F.pow(F.lit(2.0), power) - 1) * 2.0**FRACTION).cast("bigint")
    bits = (
        F.when(F.isnan(value) | (size == float("inf")), F.lit(2 * BIAS + 1) * (1 << FRACTION) + F.isnan(value).cast("bigint"))
        .when(size < LEAST_NORMAL, (size / 2.0**-1074).cast("bigint"))
        .otherwise((power + BIAS) * (1 << FRACTION) + fraction)
    )
    return F.when((value < 0) & ~F.isnan(value), -bits).otherwise(bits)


def key_value(key: int) -> float:
    """The double that has the key."""
    size = struct.unpack(">d", struct.pack(">Q", abs(key)))[0]
    return -size if key < 0 else size


def exact_quantiles(df: DataFrame, quantiles: list[Quantile]) -> dict[str, float | int | None]:
    """Exact quantiles as ``{name: value}``; NULLs are ignored, an empty column gives None.

    Values of whole-number columns are compared and returned as whole numbers, others as doubles.
    """
    columns = list(dict.fromkeys(q.column for q in quantiles))
    whole = [isinstance(df.schema[c].dataType, IntegralType) for c in columns]
    values = df.select(*[F.col(c).cast("bigint" if w else "double").alias(f"c{i}") for i, (c, w) in enumerate(zip(columns, whole))])
    place = {c: i for i, c in enumerate(columns)}
    total, wanted = _first_digit(values, whole, [(i, place[q.column], q) for i, q in enumerate(quantiles)])
    shift = 64 - DIGIT
    while shift:
        open_ = {at: w for at, w in wanted.items() if w.least < w.most}
        if not open_:
            break
        left = sum({(w.c, w.prefix): w.n for w in open_.values()}.values())
        after = max(shift - DIGIT, 0) if left > COUNT_ALL_BELOW else 0
        wanted |= _next_digit(values, whole, open_, shift, after)
        shift = after
    found = {at: w.least if whole[w.c] else key_value(w.least) for at, w in wanted.items()}
    return {
        q.name: q.combine(total.get(place[q.column], 0), [found[i, k] for k in range(2) if (i, k) in found])
        for i, q in enumerate(quantiles)
    }


@dataclass(frozen=True)
class _Place:
    """Where a wanted rank is: column, upper bits of the value, rank among the rows with these bits, their number, least and greatest."""

    c: int
    prefix: int
    rank: int
    n: int
    least: int
    most: int


#: By (quantile, which of its ranks).
_Wanted = dict[tuple[int, int], _Place]
_COUNTS = "c int, prefix bigint, n bigint, least bigint, most bigint"


def _counter(whole: Sequence[bool], after: int, shift: int = 64, known: dict[int, list[int]] | None = None) -> Callable:
    """Rows of a task by column and the key's bits down to ``after``, of all columns or of rows under ``known`` bits down to ``shift``."""
    under = None if known is None else {c: np.array(sorted(p), np.int64) for c, p in known.items()}

    def keys(column: pa.Array, is_whole: bool) -> np.ndarray:
        v = column.drop_null().to_numpy(zero_copy_only=False)
        if is_whole:
            return v.astype(np.int64)
        bits = np.abs(v).view(np.int64)
        nan = (2 * BIAS + 1 << FRACTION) + 1
        return np.where(np.isnan(v), nan, np.where(v < 0, -bits, bits))

    def counted(c: int, blocks: list[np.ndarray]) -> pa.RecordBatch:
        k = np.sort(np.concatenate(blocks))
        digit = k >> after
        first = np.flatnonzero(np.r_[True, digit[1:] != digit[:-1]])
        last = np.r_[first[1:], len(k)]
        columns = [np.full(len(first), c, np.int32), digit[first], last - first, k[first], k[last - 1]]
        return pa.RecordBatch.from_arrays([pa.array(x) for x in columns], names=["c", "prefix", "n", "least", "most"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: dict[int, list[np.ndarray]] = {c: [] for c in (range(len(whole)) if under is None else under)}
        size = dict.fromkeys(kept, 0)
        for batch in batches:
            for c, blocks in kept.items():
                k = keys(batch.column(c), whole[c])
                if under is not None:
                    upper = k >> shift
                    at = np.minimum(np.searchsorted(under[c], upper), len(under[c]) - 1)
                    k = k[under[c][at] == upper]
                if len(k):
                    blocks.append(k)
                    size[c] += len(k)
                if size[c] >= BLOCK:
                    yield counted(c, blocks)
                    blocks.clear()
                    size[c] = 0
        for c, blocks in kept.items():
            if blocks:
                yield counted(c, blocks)

    return run


def _summed(values: DataFrame, count: Callable) -> DataFrame:
    counts = values.mapInArrow(count, _COUNTS).groupBy("c", "prefix")
    return counts.agg(F.sum("n").alias("n"), F.min("least").alias("least"), F.max("most").alias("most"))


def _first_digit(values: DataFrame, whole: Sequence[bool], asked: list[tuple[int, int, Quantile]]) -> tuple[dict[int, int], _Wanted]:
    """Rows of each column, and for every wanted rank the first digit: one pass."""
    counts = _summed(values, _counter(whole, 64 - DIGIT))
    own = Window.partitionBy("c")
    upto = own.orderBy("prefix").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.withColumns({"total": F.sum("n").over(own), "before": F.coalesce(F.sum("n").over(upto), F.lit(0))})
    rows = [(i, c, float(q.p), q.method == "disc") for i, c, q in asked]
    ask = values.sparkSession.createDataFrame(rows, "i int, qc int, p double, disc boolean")
    at = F.col("p") * (F.col("total") - 1)
    ranks = F.when(F.col("disc"), F.array(F.greatest(F.lit(1), F.ceil(F.col("p") * F.col("total"))))).otherwise(F.array(F.floor(at) + 1, F.ceil(at) + 1))
    met = counts.join(F.broadcast(ask), F.col("c") == F.col("qc")).select("*", F.posexplode(ranks).alias("k", "rank"))
    met = met.where((F.col("rank") > F.col("before")) & (F.col("rank") <= F.col("before") + F.col("n")))
    found = met.withColumn("rank", F.col("rank") - F.col("before")).collect()
    return {r["c"]: r["total"] for r in found}, {(r["i"], r["k"]): _place(r) for r in found}


def _place(r: Row) -> _Place:
    return _Place(*[r[f] for f in ("c", "prefix", "rank", "n", "least", "most")])


def _next_digit(values: DataFrame, whole: Sequence[bool], wanted: _Wanted, shift: int, after: int) -> _Wanted:
    """The wanted ranks with the upper bits known down to ``after``: one pass over the rows under the known ones."""
    known: dict[int, set[int]] = {}
    for w in wanted.values():
        known.setdefault(w.c, set()).add(w.prefix)
    counts = _summed(values, _counter(whole, after, shift, {c: list(p) for c, p in known.items()}))
    counts = counts.withColumn("known", F.shiftright("prefix", shift - after))
    upto = Window.partitionBy("c", "known").orderBy("prefix").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.withColumn("before", F.coalesce(F.sum("n").over(upto), F.lit(0)))
    ask = [(*at, w.c, w.prefix, w.rank) for at, w in wanted.items()]
    ranks = values.sparkSession.createDataFrame(ask, "i int, k int, rc int, under bigint, rank bigint")
    inside = (F.col("rank") > F.col("before")) & (F.col("rank") <= F.col("before") + F.col("n"))
    met = counts.join(F.broadcast(ranks), (F.col("c") == F.col("rc")) & (F.col("known") == F.col("under")) & inside)
    return {(r["i"], r["k"]): _place(r) for r in met.withColumn("rank", F.col("rank") - F.col("before")).collect()}


def approx_quantiles(df: DataFrame, quantiles: list[Quantile], rel_err: float = 0.01) -> dict[str, float | None]:
    """One pass; each value's rank is within ``rel_err`` of the wanted one."""
    return approx_quantile_frame(df, quantiles, rel_err).first().asDict()


def approx_quantile_frame(df: DataFrame, quantiles: list[Quantile], rel_err: float = 0.01) -> DataFrame:
    accuracy = max(1, math.ceil(1 / rel_err))
    return df.agg(
        *[F.percentile_approx(F.col(q.column).cast("double"), q.p, accuracy).alias(q.name) for q in quantiles]
    )


def fit_quantiles(df: DataFrame, quantiles: list[Quantile], rel_err: float = 0.0) -> dict[str, float | int | None]:
    """Exact values, or sketched ones when a rank error is allowed."""
    return exact_quantiles(df, quantiles) if rel_err == 0 else approx_quantiles(df, quantiles, rel_err)


def quantile_frame(df: DataFrame, quantiles: list[Quantile], rel_err: float = 0.0) -> DataFrame:
    """The quantiles as rows ``(column, p, value)``."""
    values = fit_quantiles(df, quantiles, rel_err)
    rows = [(q.column, float(q.p), None if values[q.name] is None else float(values[q.name])) for q in quantiles]
    return df.sparkSession.createDataFrame(rows, "column string, p double, value double")
