"""Cleaning, encoding, joins, schema and profile operators on hand-made frames."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from creditmart.operators import cleaning, encoding, joins, profile, schema


def test_enforce_schema(spark):
    df = spark.createDataFrame([("1.7", "x", "keep")], "a string, b string, c string")
    out = schema.enforce_schema(df, {"a": "int", "b": "double", "missing": "int"}, only_present=True)
    assert out.dtypes == [("a", "int"), ("b", "double"), ("c", "string")]
    assert out.first() == (1, None, "keep")
    with pytest.raises(ValueError, match="missing"):
        schema.enforce_schema(df, {"missing": "int"})


def test_projections(spark):
    df = spark.createDataFrame([(1, 2, 3.0, "x")], "fe_1 int, fe_2 bigint, B double, c string")
    assert schema.select_numeric(df).columns == ["fe_1", "B"]
    assert schema.select_numeric(df, all_numeric=True).columns == ["fe_1", "fe_2", "B"]
    assert schema.select_prefix(df, "fe_").columns == ["fe_1", "fe_2"]
    assert schema.drop_columns(df, ["b", "C", "zzz"]).columns == ["fe_1", "fe_2"]
    assert schema.select_except(df, ["c"]).columns == ["fe_1", "fe_2", "B"]


def test_clean_numeric_leaves_numbers_alone(spark):
    df = spark.createDataFrame([("-1_", 1.2e7, 3.456)], "t string, d double, r double")
    rules = {c: cleaning.NumberRule() for c in ("t", "d", "r", "absent")}
    assert cleaning.clean_numeric(df, rules).first() == (1.0, 1.2e7, 3.46)


def test_trim_drops_the_tail_and_nulls(spark):
    df = spark.createDataFrame([(float(i),) for i in range(1, 1001)] + [(None,)], "v double")
    kept = cleaning.trim_upper_tail(df, "v", 0.997)
    assert kept.count() == 996
    assert kept.agg(F.max("v")).first()[0] == 996.0


def test_winsorize_keeps_nulls_and_types(spark):
    rows = [(i, float(i)) for i in range(1, 101)] + [(None, None)]
    df = spark.createDataFrame(rows, "n int, x double")
    out = cleaning.winsorize_upper(df, {"n": 0.95, "x": 0.5})
    assert out.dtypes == [("n", "int"), ("x", "double")]
    assert out.agg(F.max("n"), F.max("x"), F.count("n")).first() == (95, 50.0, 100)
    assert out.where("n is null and x is null").count() == 1


def test_caps_can_be_applied_to_other_rows(spark):
    caps = cleaning.fit_caps(spark.range(1, 101), {"id": 0.95})
    assert [r[0] for r in cleaning.apply_caps(spark.range(94, 99), caps).collect()] == [94, 95, 95, 95, 95]


def test_impute_median(spark):
    ages = ["23_", "-500", "23.5", None, "", "40", "31"]
    df = spark.createDataFrame([(a,) for a in ages], "Age string")
    # digits: 23, 500, 235, NULL, NULL, 40, 31; median of the five known is 40
    assert [r[0] for r in cleaning.impute_median(df, "Age").collect()] == [23.0, 40.0, 40.0, 40.0, 40.0, 40.0, 31.0]


def test_one_hot(spark):
    df = spark.createDataFrame([("Not Sure",), ("a-b.c",), (None,)], "Kind string")
    out = encoding.one_hot(df, "Kind")
    assert out.columns == ["Kind", "kind_not_sure", "kind_a_b_c"]
    assert [tuple(r)[1:] for r in out.collect()] == [(1, 0), (0, 1), (0, 0)]
    fixed = encoding.one_hot(df, "Kind", ["Not Sure", "Never"])
    assert [tuple(r)[1:] for r in fixed.collect()] == [(1, 0), (0, 0), (0, 0)]


def test_name_collisions_are_refused(spark):
    df = spark.createDataFrame([("a b",), ("a-b",)], "k string")
    with pytest.raises(ValueError, match="already taken"):
        encoding.one_hot(df, "k")
    with pytest.raises(ValueError, match="already taken"):
        encoding.one_hot(df.withColumn("k_x", F.lit(1)), "k", ["x"])


def test_multi_hot_equals_membership(spark):
    lists = ["Auto Loan, and Home Loan", "Home Loan", None, "", "Credit-Builder Loan,  and Auto Loan"]
    df = spark.createDataFrame([(v,) for v in lists], "t string")
    out = encoding.multi_hot(df, "t", "loan_type")
    assert out.columns == ["t", "loan_type_auto_loan", "loan_type_credit_builder_loan", "loan_type_home_loan"]
    for row in out.collect():
        text = row["t"] or ""
        assert tuple(row)[1:] == tuple(int(n in text) for n in ("Auto Loan", "Credit-Builder Loan", "Home Loan"))


def test_vocabulary_bound(spark):
    df = spark.range(50).withColumn("s", F.col("id").cast("string"))
    with pytest.raises(ValueError, match="not a category"):
        encoding.vocabulary(df, "s", max_size=10)
    assert encoding.vocabularies(df.where("id < 2"), ["s"]) == {"s": ["0", "1"]}


@pytest.mark.parametrize("how", ["inner", "left"])
def test_salted_join_equals_plain(spark, how):
    # copies of one row make up a third of all; other keys are missing from the dimension
    fact = spark.range(0, 3000, 1, 6).selectExpr(
        "case when id % 3 = 0 then 'hot' else cast(id % 400 as string) end as k", "if(id % 3 = 0, 0, id) as v"
    )
    dim = spark.range(300).selectExpr("cast(id as string) as k", "id * 2 as d").union(
        spark.createDataFrame([("hot", -1)], "k string, d bigint")
    )
    assert len(joins.hot_key_hashes(fact, ["k"])) == 1
    plain = joins.lookup_join(fact, dim, ["k"], how)
    salted = joins.lookup_join(fact, dim, ["k"], how, salts=8)
    assert salted.columns == plain.columns
    assert plain.where("k = 'hot'").count() == 1000
    assert sorted(map(str, salted.collect())) == sorted(map(str, plain.collect()))


def test_join_guards(spark):
    a = spark.createDataFrame([(1, 2)], "k int, v int")
    with pytest.raises(ValueError, match="both sides"):
        joins.equi_join(a, a, ["k"])
    with pytest.raises(ValueError, match="occurs 2 times"):
        joins.require_unique(a.union(a), ["k"])
    assert joins.require_unique(a, ["k"]) is a


def test_profile_against_numpy(spark):
    rng = np.random.default_rng(1)
    x = rng.gamma(2.0, size=501)
    df = spark.createDataFrame([(float(v), None if i % 5 == 0 else i) for i, v in enumerate(x)], "x double, n int")
    row = {r["column"]: r for r in profile.numeric_profile(df).collect()}
    d = x - x.mean()
    assert row["x"]["count"] == 501 and row["n"]["null_count"] == 101
    assert row["x"]["stddev"] == pytest.approx(x.std(ddof=1))
    assert row["x"]["skewness"] == pytest.approx((d**3).mean() / (d**2).mean() ** 1.5)
    assert row["x"]["kurtosis"] == pytest.approx((d**4).mean() / (d**2).mean() ** 2 - 3)
    assert row["x"]["median"] == np.sort(x)[250]
    described = {r["column"]: r for r in profile.describe(df, ["x"]).collect()}["x"]
    assert [described["p25"], described["p75"]] == pytest.approx(list(np.quantile(x, [0.25, 0.75])))
    info = {r["column"]: (r["non_null"], r["dtype"]) for r in profile.column_info(df).collect()}
    assert info == {"x": (501, "double"), "n": (400, "int")}


def test_histogram_against_numpy(spark):
    x = np.random.default_rng(2).normal(size=1000)
    df = spark.createDataFrame([(float(v), 7.0) for v in x], "x double, c double")
    rows = profile.histogram(df, ["x", "c"], bins=8).orderBy("column", "bin").collect()
    counts, edges = np.histogram(x, bins=8)
    assert [r["n"] for r in rows if r["column"] == "x"] == list(counts)
    assert [r["lower"] for r in rows if r["column"] == "x"] == pytest.approx(list(edges[:-1]))
    assert [r["n"] for r in rows if r["column"] == "c"] == [1000] + [0] * 7


def test_density(spark):
    x = np.random.default_rng(3).normal(size=300)
    df = spark.createDataFrame([(float(v),) for v in x], "x double")
    rows = profile.density(df, "x", points=80).orderBy("x").collect()
    h = x.std(ddof=1) * 300**-0.2
    for r in rows[::13]:
        want = np.exp(-0.5 * ((r["x"] - x) / h) ** 2).sum() / (300 * h * math.sqrt(2 * math.pi))
        assert r["density"] == pytest.approx(want)
    area = np.trapezoid([r["density"] for r in rows], [r["x"] for r in rows])
    assert area == pytest.approx(1, abs=0.01)
    missing = df.union(spark.createDataFrame([(float("nan"),), (None,)], "x double"))
    assert [r["density"] for r in profile.density(missing, "x", points=80).orderBy("x").collect()] == pytest.approx([r["density"] for r in rows])


def test_density_far_from_data(spark):
    df = spark.createDataFrame([(0.0,)] * 500 + [(1.0,)] * 500 + [(1000.0,)], "x double")
    rows = profile.density(df, "x", points=50).orderBy("x").collect()
    assert len(rows) == 50
    assert rows[25]["density"] == pytest.approx(0, abs=1e-12)


def test_correlations(spark):
    rng = np.random.default_rng(4)
    a = rng.normal(size=200)
    b = a * 2 + rng.normal(size=200) * 0.1
    c = rng.normal(size=200)
    df = spark.createDataFrame([tuple(map(float, r)) for r in zip(a, b, c)], "a double, b double, c double")
    want = np.corrcoef([a, b, c])
    for matrix in (profile.correlations(df), profile.correlation_matrix(df, ["a", "b", "c"])):
        rows = matrix.collect()
        assert len(rows) == 9
        for r in rows:
            assert r["r"] == pytest.approx(want[r["i"]][r["j"]])
        assert [(r["a"], r["b"]) for r in profile.high_correlations(matrix).collect()] == [("a", "b")]
        assert profile.lower_triangle(matrix).count() == 3


def test_value_counts(spark):
    df = spark.createDataFrame([("a",), ("b",), ("b",), (None,), ("c",)], "k string")
    assert [tuple(r) for r in profile.value_counts(df, "k").collect()] == [("b", 2), (None, 1), ("a", 1), ("c", 1)]
    shares = profile.value_counts(df, "k", normalize=True, keep_null=False).collect()
    assert [tuple(r) for r in shares] == [("b", 2, 50.0), ("a", 1, 25.0), ("c", 1, 25.0)]


def test_more_categories_than_a_thousand(spark):
    df = spark.range(1_001).select(F.col("id").cast("string").alias("c"))
    assert len(encoding.one_hot(df, "c").columns) >= 1_001


def test_caps_leave_large_whole_numbers_alone(spark):
    df = spark.createDataFrame([(9007199254740993,), (5,)], "n bigint")
    assert [r["n"] for r in cleaning.apply_caps(df, {"n": 1e18}).collect()] == [9007199254740993, 5]


def test_shared_folder_needs_a_name_on_a_cluster():
    from creditmart import session

    class Context:
        master = "spark://host:7077"

        @staticmethod
        def getCheckpointDir():
            return None

    class Conf:
        @staticmethod
        def get(key, default=None):
            return default

    class Session:
        conf, sparkContext = Conf, Context

    with pytest.raises(RuntimeError, match="checkpoint.dir"):
        session.shared_folder(Session)


def test_nan_is_missing_in_bins_and_densities(spark):
    rows = [(float(i), None) for i in range(20)] + [(float("nan"), None), (None, None)]
    df = spark.createDataFrame(rows, "v double, empty double")
    bins = profile.histogram(df, ["v", "empty"], bins=4).collect()
    assert sorted((r["bin"], r["lower"], r["n"]) for r in bins) == [(0, 0.0, 5), (1, 4.75, 5), (2, 9.5, 5), (3, 14.25, 5)]
    clean = df.where("v is not null and not isnan(v)")
    curve = lambda d: sorted((r["x"], round(r["density"], 12)) for r in profile.density(d, "v", 30).collect())
    assert curve(df) == curve(clean)
    tables = profile.distributions(df, bins=4, points=30)
    assert {r["column"] for r in tables["densities"].collect()} == {"v"}
    assert {r["column"] for r in tables["statistics"].collect()} == {"v", "empty"}


def test_correlations_with_gaps(spark):
    rng = np.random.default_rng(3)
    a, b = rng.normal(size=60), rng.normal(size=60)
    gaps = [None if i % 7 == 0 else float("nan") if i % 7 == 1 else float(x + y) for i, (x, y) in enumerate(zip(a, b))]
    df = spark.createDataFrame(list(zip(a.tolist(), b.tolist(), gaps, [1.0] * 60)), "a double, b double, c double, d double")
    found = {(r["a"], r["b"]): r["r"] for r in profile.correlations(df).collect()}
    keep = np.array([g is not None and not math.isnan(g) for g in gaps])
    c = np.array([g for g, k in zip(gaps, keep) if k])
    assert found["a", "b"] == pytest.approx(np.corrcoef(a, b)[0, 1])
    assert found["c", "a"] == found["a", "c"] == pytest.approx(np.corrcoef(a[keep], c)[0, 1])
    assert found["a", "d"] is None and found["d", "d"] == 1.0


def test_many_correlations_read_the_rows_once(spark):
    """No job runs before the result is asked for, and columns far from 0 or equal where the other is known come out right."""
    df = spark.range(0, 3_000, 1, 5).selectExpr(
        "id % 7 AS a", "1e9 + id % 7 + (id % 3) / 10D AS b", "IF(id % 2 = 0, NULL, id % 5) AS c", "0.1D AS d",
        "IF(id % 2 = 1, 0.3D, id) AS e", "double(NULL) AS f", "IF(id % 3 = 0, double('NaN'), id * id) AS g",
    )
    seen = spark.sparkContext._jsc.sc().dagScheduler().nextJobId()
    matrix = profile.correlations(df, df.columns)
    assert spark.sparkContext._jsc.sc().dagScheduler().nextJobId() == seen
    got = {(r["a"], r["b"]): r["r"] for r in matrix.collect()}
    rows = df.toPandas()
    assert len(got) == 49
    for x in rows.columns:
        for y in rows.columns:
            pair = rows[[x, y]].astype(float).dropna() if x != y else None
            if pair is None:
                assert got[x, y] == 1.0
            elif len(pair) == 0 or pair[x].nunique() == 1 or pair[y].nunique() == 1:
                assert got[x, y] is None
            else:
                assert got[x, y] == pytest.approx((pair - pair.mean())[x].corr((pair - pair.mean())[y]), abs=1e-9)
