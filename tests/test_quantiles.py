"""Exact quantiles against sorting, with the search forced to narrow on small data."""

import math
import random

import numpy as np
import pytest

from creditmart.operators import quantiles
from creditmart.operators.quantiles import Quantile, approx_quantiles, exact_quantiles, quantile_frame

PS = (0.0, 0.001, 0.25, 0.5, 0.95, 0.997, 1.0)


def data(kind, n, rng):
    if kind == "uniform":
        return [rng.random() for _ in range(n)]
    if kind == "hot":  # a third of all rows share one value, and there are gaps and NULLs
        return [5.0 if i % 3 == 0 else None if i % 7 == 0 else float(rng.randrange(20)) for i in range(n)]
    if kind == "heavy_tail":
        return [10.0 ** rng.uniform(-200, 200) for _ in range(n)]
    if kind == "two":
        return [float(i % 2) for i in range(n)]
    return [-1.5] * n


@pytest.mark.parametrize("limit", [1, 50, 100_000])
@pytest.mark.parametrize("kind", ["uniform", "hot", "heavy_tail", "two", "constant"])
def test_exact(spark, monkeypatch, kind, limit):
    monkeypatch.setattr(quantiles, "COUNT_ALL_BELOW", limit)
    values = data(kind, 5_001, random.Random(kind))
    df = spark.createDataFrame([(v,) for v in values], "v double").repartition(4)
    known = np.sort([v for v in values if v is not None])
    wanted = [Quantile("v", p, f"d{p}") for p in PS] + [Quantile("v", p, f"l{p}", "linear") for p in PS]
    got = exact_quantiles(df, wanted)
    for p in PS:
        assert got[f"d{p}"] == known[max(1, math.ceil(p * len(known))) - 1]
        assert got[f"l{p}"] == pytest.approx(np.quantile(known, p), rel=1e-12)


def test_keys_keep_the_order(spark):
    rng = random.Random(1)
    values = [0.0, -0.0, 1.0, -1.0, 2.0**-1074, 2.0**-1022, 1.5 * 2.0**-1030, 1.7976931348623157e308, float("inf"), float("-inf")]
    values += [2.0**i * m for i in range(-1073, 1024) for m in (1.0, 1 - 2.0**-53, 1 + 2.0**-52)]
    values += [rng.choice([1, -1]) * rng.random() * 10.0 ** rng.uniform(-320, 308) for _ in range(3000)]
    values = [v for v in values if math.isfinite(v)] + [float("inf"), float("-inf")]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    rows = df.select("v", quantiles.order_key(df.v).alias("k")).collect()
    assert all(quantiles.key_value(r.k) == r.v for r in rows)
    by_key = sorted(rows, key=lambda r: r.k)
    assert [r.v for r in by_key] == sorted(values)
    nan = spark.createDataFrame([(float("nan"),), (float("inf"),), (1.0,)], "v double")
    assert math.isnan(exact_quantiles(nan, [Quantile("v", 1.0, "m")])["m"])


def test_whole_numbers_stay_whole(spark, monkeypatch):
    monkeypatch.setattr(quantiles, "COUNT_ALL_BELOW", 1)
    big = (1 << 62) + 1
    df = spark.createDataFrame([(big + i, -i) for i in range(9)], "a long, b long")
    got = exact_quantiles(df, [Quantile("a", 0.5, "a"), Quantile("b", 0.5, "b"), Quantile("b", 0.0, "least")])
    assert got == {"a": big + 4, "b": -4, "least": -8}


def test_empty_and_several_columns(spark):
    df = spark.createDataFrame([(1, None, 3.5), (2, None, 1.5)], "a int, b double, c double")
    got = exact_quantiles(df, [Quantile("a", 0.5, "a"), Quantile("b", 0.5, "b"), Quantile("c", 0.5, "c", "linear")])
    assert got == {"a": 1.0, "b": None, "c": 2.5}


def test_approx_rank_error(spark):
    df = spark.range(10_000).selectExpr("cast(id as double) as v")
    got = approx_quantiles(df, [Quantile("v", 0.95, "q")], 0.01)["q"]
    assert abs(got / 10_000 - 0.95) <= 0.01
    assert quantile_frame(df, [Quantile("v", 0.5, "m")]).collect()[0]["value"] == 4999.0


def test_equal_rows_need_no_further_pass(spark, monkeypatch):
    """Tasks count in blocks, and a column of few values is done once its values differ in the bits seen."""
    passes = []
    one = quantiles._next_digit
    monkeypatch.setattr(quantiles, "_next_digit", lambda *a: passes.append(a) or one(*a))
    monkeypatch.setattr(quantiles, "COUNT_ALL_BELOW", 1)
    monkeypatch.setattr(quantiles, "BLOCK", 100)
    df = spark.range(0, 4_000, 1, 3).selectExpr("7 AS same", "double(id % 2) AS two", "CASE WHEN id % 5 = 0 THEN double('NaN') ELSE -0.0D END AS odd")
    wanted = [Quantile(c, p, f"{c}.{p}") for c in ("same", "two", "odd") for p in (0.25, 0.75)]
    got = exact_quantiles(df, wanted)
    assert [got[q.name] for q in wanted] == [7, 7, 0.0, 1.0, 0.0, 0.0] and not passes
    assert exact_quantiles(spark.range(0, 4_000, 1, 3), [Quantile("id", 0.5, "m")]) == {"m": 1999} and passes


def test_sketch_range_joins_once(spark, monkeypatch):
    """The passes of the exact limits read a stored table, not the join again."""
    from creditmart.catalog import profile_queries

    plans = []
    one = profile_queries.exact_quantiles
    monkeypatch.setattr(profile_queries, "exact_quantiles", lambda df, q: plans.append(df._jdf.queryExecution().optimizedPlan().toString()) or one(df, q))
    found = profile_queries.sketch_range(spark, "/root/testdata/sf0.001").collect()
    assert len(found) == 8 and all(r["in_range"] for r in found)
    assert len(plans) == 1 and "Join" not in plans[0]
