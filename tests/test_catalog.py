"""Every registered query runs, and agrees with its SQL, on the smallest tables."""

import glob

import pytest
from parity import compare, connect
from pyspark.sql import functions as F

import __spark_entry__ as entry
from creditmart.catalog import mart_queries, tables as T
from creditmart.plans.datamart_jobs import SOURCE_FILES, Build

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_matches_sql(spark, duck, name):
    df = entry.queries()[name](spark, SF)
    assert compare(df, duck, entry.oracle_sql()[name]) == ""
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan and "Python" not in plan


@pytest.mark.parametrize("name", ["winsorize_p95", "one_hot", "multi_hot", "clean_numeric", "enforce_schema"])
def test_applying_a_fit_does_not_shuffle_the_rows(spark, name):
    df = entry.queries()[name](spark, SF)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning" not in plan and "SinglePartition" not in plan


def test_filters_reach_the_scan(spark):
    plan = entry.queries()["filter_completed"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint,l_suppkey:bigint,l_linenumber:int,l_shipdate" in plan
    trimmed = entry.queries()["outlier_trim"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(o_totalprice), LessThan(o_totalprice," in trimmed


def test_the_aggregation_s_shuffle_serves_the_join(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = entry.queries()["join_left_2key"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert plan.count("Exchange hashpartitioning(Customer_ID") == 2  # loans, and partial sums


def test_lines_meet_their_order_with_what_the_measures_need(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = T.clickstream(spark, SF)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    lines = plan[plan.index("Exchange hashpartitioning(l_orderkey") :]  # what is below, and so before, the join's shuffle
    assert "% 100" in lines and "% 10)" in lines and "trunc(month" in lines


def test_source_files_are_compressed_and_of_limited_rows(spark, monkeypatch):
    monkeypatch.setattr(mart_queries, "FILE_ROWS", 100)
    views = {"financials": T.financials, "attributes": T.attributes, "clickstream": T.clickstream, "lms": T.raw_ledger}
    root = mart_queries._source_files(spark, SF, *views)
    for name, view in views.items():
        path = f"{root}/{SOURCE_FILES[name]}"
        files = glob.glob(f"{path}/part-*")
        assert all(f.endswith(".csv.gz") for f in files) and len(files) >= view(spark, SF).count() / 100
        got, want = (df.groupBy("Customer_ID", F.col("snapshot_date").cast("date")).count() for df in (Build(spark, root, None).source(name), view(spark, SF)))
        assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()


@pytest.mark.parametrize("name", sorted(entry.queries().keys() - entry.oracle_sql().keys()))
def test_runs(spark, name):
    assert len(entry.queries()[name](spark, SF).collect()) > 0


def test_entry(spark):
    assert [r["mob"] for r in entry.entry(spark).collect()] == list(range(1, 8))
