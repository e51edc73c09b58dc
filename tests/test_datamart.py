"""The datamart end to end from CSV files: layers, pruning, re-runs, and the per-date entry points."""

import glob
import os
from datetime import date

import pytest
from pyspark.sql import functions as F

from creditmart import api, jobs
from creditmart.catalog import mart_queries, tables as T
from creditmart.functions.dates import month_starts
from creditmart.operators import joins
from creditmart.plans import gold, silver
from creditmart.plans.datamart_jobs import SOURCE_FILES, Build
from creditmart.sources import datamart as dm
from creditmart.sources.schemas import FINANCIAL_TYPES, LABEL_SCHEMA, LOAN_DAILY_SCHEMA

SF = "/root/testdata/sf0.001"
MONTHS = month_starts("1997-01-15", "1997-06-01")
VIEWS = {"lms": T.raw_ledger, "financials": T.financials, "attributes": T.attributes, "clickstream": T.clickstream}


@pytest.fixture(scope="module")
def sources(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("source"))
    for name, view in VIEWS.items():
        view(spark, SF).coalesce(1).write.option("header", True).option("escape", '"').csv(f"{root}/{SOURCE_FILES[name]}")
    return root


@pytest.fixture(scope="module")
def built(spark, sources, tmp_path_factory):
    build = Build(spark, sources, dm.Datamart(spark, str(tmp_path_factory.mktemp("mart"))), dpd=30)
    return build, build.backfill(MONTHS)


def in_months(df):
    return df.where(F.col("snapshot_date").isin(MONTHS))


def rows(df):
    return sorted(str(r) for r in df.select(*sorted(df.columns)).collect())


def test_row_counts_of_all_stages(spark, built):
    _, counts = built
    loans = in_months(T.raw_ledger(spark, SF))
    assert counts["bronze.lms"] == counts["silver.loan_daily"] == loans.count()
    assert counts["bronze.financials"] == T.financials(spark, SF).count()
    assert counts["silver.clickstream"] == in_months(T.clickstream(spark, SF)).count()
    assert counts["gold.label_store"] == loans.where("try_cast(installment_num as int) = 6").count()
    assert counts["silver.financial_attributes"] > 0


def test_schemas(built):
    build, _ = built
    loans = build.mart.read("silver", "loan_daily")
    assert dict(loans.dtypes) == {f.name: f.dataType.simpleString() for f in LOAN_DAILY_SCHEMA}
    assert dict(build.mart.read("gold", "label_store").dtypes) == {f.name: f.dataType.simpleString() for f in LABEL_SCHEMA}


def test_one_snapshot_reads_one_directory(built):
    build, _ = built
    one = build.mart.read("silver", "loan_daily", [MONTHS[2]])
    files = one.inputFiles()
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(snapshot_date" in plan
    assert {r[0] for r in one.select("snapshot_date").distinct().collect()} == {MONTHS[2]}
    assert files


def test_rerun_replaces_only_its_months(built):
    build, _ = built
    before = rows(build.mart.read("gold", "label_store"))
    build.bronze(MONTHS[:2], ["lms"])
    build.silver_loans(MONTHS[:2])
    build.gold_labels(MONTHS[:2])
    assert rows(build.mart.read("gold", "label_store")) == before


def test_rerun_with_fewer_months_leaves_nothing_behind(spark, built, tmp_path):
    build, _ = built
    mart = dm.Datamart(spark, str(tmp_path))
    loans = build.mart.read("silver", "loan_daily")
    labels = gold.label_store(loans, 30, 5)
    mart.write(labels, "gold", "label_store", snapshots=MONTHS)
    kept, gone = MONTHS[:2], [m for m in MONTHS[2:4]]
    outside = rows(mart.read("gold", "label_store", MONTHS[4:], LABEL_SCHEMA))
    fewer = gold.label_store(dm.at_snapshots(loans, kept), 60, 4)
    mart.write(fewer, "gold", "label_store", snapshots=[*kept, *gone])
    assert rows(mart.read("gold", "label_store", [*kept, *gone], LABEL_SCHEMA)) == rows(fewer)
    assert rows(mart.read("gold", "label_store", MONTHS[4:], LABEL_SCHEMA)) == outside


def test_feature_store_rows(spark, built):
    build, _ = built
    store = build.mart.read("gold", "feature_store")
    clicks = build.mart.read("silver", "clickstream")
    customers = build.mart.read("silver", "financial_attributes")
    want = clicks.join(customers.select("Customer_ID"), "Customer_ID").count()
    assert store.count() == want
    assert "has_SSN" in store.columns and "fe_20" in store.columns


def test_fixed_vocabulary_gives_fixed_columns(spark):
    vocab = silver.Vocabularies(["Auto Loan", "Unheard-of Loan"], ["Good"], ["Yes", "No"])
    out = silver.customer_features(T.financials(spark, SF), None, vocab)
    flags = [c for c in out.columns if c.startswith(("loan_type_", "credit_mix_", "payment_of_min"))]
    assert flags == ["loan_type_auto_loan", "loan_type_unheard_of_loan", "credit_mix_good", "payment_of_min_amount_yes"]
    assert out.agg(F.sum("loan_type_unheard_of_loan")).first()[0] == 0


def test_caps_are_of_the_rows_that_remain(spark):
    numbers = silver.financial_numbers(T.financials(spark, SF))
    out = silver.financial_outliers(numbers)
    assert out.agg(F.min("Num_Bank_Accounts")).first()[0] >= 0
    kept = numbers.where(F.col("Num_Bank_Accounts") >= 0).where(
        F.col("Monthly_Balance") < numbers.selectExpr("percentile_disc(0.997) within group (order by Monthly_Balance)").first()[0]
    )
    assert out.count() == kept.count()
    cap = kept.selectExpr("percentile_disc(0.95) within group (order by Num_of_Loan)").first()[0]
    assert out.agg(F.max("Num_of_Loan")).first()[0] == cap


def test_feature_store_as_of(spark):
    clicks = spark.createDataFrame(
        [("a", date(2024, 1, 1), 1.0), ("a", date(2024, 3, 1), 2.0), ("b", date(2024, 1, 1), 3.0)],
        "Customer_ID string, snapshot_date date, fe_1 double",
    )
    customers = spark.createDataFrame(
        [("a", date(2024, 2, 1), 10), ("a", date(2024, 3, 1), 20), ("a", date(2024, 4, 1), 30), ("b", date(2023, 1, 1), 40)],
        "Customer_ID string, snapshot_date date, x int",
    )
    with pytest.raises(ValueError, match="occurs 3 times"):
        gold.feature_store(clicks, customers, "2024-02-01")
    with pytest.raises(ValueError, match="occurs 2 times"):
        gold.feature_store(clicks, customers.union(customers.limit(1)), as_of=True)
    plain = gold.feature_store(clicks, customers, "2024-02-01", duplicates=True)
    assert sorted((r.Customer_ID, r.fe_1, r.x) for r in plain.collect()) == [
        ("a", 1.0, 10), ("a", 1.0, 20), ("a", 1.0, 30), ("b", 3.0, 40),
    ]
    dated = gold.feature_store(clicks, customers, as_of=True)
    assert sorted((r.Customer_ID, r.fe_1, r.x) for r in dated.collect()) == [("a", 2.0, 20), ("b", 3.0, 40)]


def test_month_calendar_and_filters(spark):
    df = spark.createDataFrame([(date(2023, 1, 15),), (date(2023, 4, 1),), (None,)], "snapshot_date date")
    assert [str(r[0]) for r in dm.month_calendar(df, "snapshot_date").collect()] == [
        "2023-01-01", "2023-02-01", "2023-03-01", "2023-04-01",
    ]
    assert dm.up_to(df, "2023-01-15").count() == 1
    assert dm.between(df, "2023-01-15", "2023-04-01").count() == 2
    assert dm.at_snapshot(df, "2023-04-01").count() == 1
    assert dm.at_snapshot(spark.range(3), "2023-04-01").count() == 3


def test_csv_columns_may_come_in_any_order(spark, tmp_path):
    path = tmp_path / SOURCE_FILES["attributes"]
    path.write_text('snapshot_date,SSN,Age,extra,Occupation,Name,Customer_ID\n2024-01-01,1-2,30_,e,"A, ""B""",N,c1\n')
    build = Build(spark, str(tmp_path), dm.Datamart(spark, str(tmp_path / "mart")))
    row = build.source("attributes").first()
    assert (row["Customer_ID"], row["Occupation"], row["Age"], row["extra"]) == ("c1", 'A, "B"', "30_", "e")
    path.write_text("Customer_ID,Name\nc1,N\n")
    with pytest.raises(ValueError, match="lacks the columns"):
        build.source("attributes")


def test_bronze_keeps_text_and_unknown_columns(spark, tmp_path):
    names = [*FINANCIAL_TYPES, "branch"]
    cells = dict.fromkeys(names, "1") | {"Customer_ID": "007", "snapshot_date": "2024-01-01", "branch": "x"}
    cells |= {"Num_Bank_Accounts": "3.0", "Num_Credit_Card": "5_", "Interest_Rate": "4.5", "Delay_from_due_date": "-2"}
    path = tmp_path / SOURCE_FILES["financials"]
    path.write_text(",".join(names) + "\n" + ",".join(cells[n] for n in names) + "\n")
    build = Build(spark, str(tmp_path), dm.Datamart(spark, str(tmp_path / "mart")), join_attributes=False)
    build.bronze([], ["financials"])
    kept = build.bronze_frame("financials").first()
    assert (kept["Customer_ID"], kept["Num_Bank_Accounts"], kept["Num_Credit_Card"], kept["branch"]) == ("007", "3.0", "5_", "x")
    read = silver.financial_numbers(build.bronze_frame("financials")).first()
    assert [read[c] for c in ("Num_Bank_Accounts", "Num_Credit_Card", "Interest_Rate", "Delay_from_due_date")] == [3, 5, 4.5, -2]
    assert read["branch"] == "x"


def test_command_line(spark, sources, tmp_path, built, capsys):
    build, counts = built
    monthly = ["--source", sources, "--datamart", str(tmp_path), "--dpd", "30"]
    jobs.main(["--stage", "bronze", "--snapshotdate", "1997-03-01", *monthly])
    mart = dm.Datamart(spark, str(tmp_path))
    assert rows(mart.read("bronze", "lms")) == rows(build.bronze_frame("lms", ["1997-03-01"]))
    jobs.main(["--stage", "backfill", "--start", "1997-01-01", "--end", "1997-06-01", *monthly])
    assert rows(mart.read("gold", "label_store")) == rows(build.mart.read("gold", "label_store"))
    assert f"gold.feature_store: {counts['gold.feature_store']} rows" in capsys.readouterr().out


def test_entry_points_per_date(spark, sources, tmp_path, built):
    build, _ = built
    day = "1997-03-01"
    root = str(tmp_path)
    bronze, lms = f"{root}/bronze/", f"{root}/bronze/lms/"
    silver_dir, loans_dir = f"{root}/silver/", f"{root}/silver/loan_daily/"
    assert api.generate_first_of_month_dates("1997-01-15", "1997-02-01") == ["1997-01-01", "1997-02-01"]
    ledger = api.process_bronze_table(day, lms, spark, sources)
    assert ledger.count() == build.bronze_frame("lms", [day]).count()
    frames = api.process_bronze_feature_tables(day, bronze, spark, sources)
    assert set(frames) == {"financials", "attributes", "clickstream"}
    loans = api.process_silver_table(day, lms, loans_dir, spark)
    assert rows(loans) == rows(build.mart.read("silver", "loan_daily", [day]))
    customers = api.process_customer_features(bronze, silver_dir, spark)
    assert rows(customers) == rows(build.mart.read("silver", "financial_attributes"))
    api.process_silver_cs_features(day, bronze, silver_dir, spark)
    labels = api.process_labels_gold_table(day, loans_dir, f"{root}/gold/label_store/", spark, dpd=30, mob=6)
    assert rows(labels) == rows(build.mart.read("gold", "label_store", [day]))
    store = api.process_features_gold_table(day, "1997-06-01", silver_dir, f"{root}/gold/feature_store/", spark)
    assert rows(store) == rows(build.mart.read("gold", "feature_store", [day]))
    assert api.process_silver_table("2030-01-01", lms, f"{root}/silver/none/", spark).count() == 0
    attributes = api.process_customer_attributes(f"{root}/bronze/attributes", spark)
    assert "has_SSN" in attributes.columns and "SSN" not in attributes.columns
    flags = api.one_hot_encode_categorical(frames["attributes"].limit(50), "Occupation")
    assert any(c.startswith("occupation_") for c in flags.columns)


def test_failure_before_publishing_leaves_the_old_months(spark, built, tmp_path, monkeypatch):
    build, _ = built
    mart = dm.Datamart(spark, str(tmp_path))
    loans = build.mart.read("silver", "loan_daily")
    mart.write(gold.label_store(loans, 30, 6), "gold", "label_store", snapshots=MONTHS)
    before, state = rows(mart.read("gold", "label_store")), mart.manifest("gold", "label_store").state()

    def fails(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(dm.Datamart, "publish", fails)
        with pytest.raises(RuntimeError, match="lost"):
            mart.write(gold.label_store(loans, 90, 4), "gold", "label_store", snapshots=MONTHS)
    assert rows(mart.read("gold", "label_store")) == before
    with pytest.raises(Exception, match="(?i)divi"):  # and so does one while writing
        mart.write(loans.withColumn("x", F.expr("1 / (dpd - dpd)")), "gold", "label_store", snapshots=MONTHS)
    assert mart.manifest("gold", "label_store").state() == state and rows(mart.read("gold", "label_store")) == before


def test_manifests_expire_with_their_writes(spark, tmp_path):
    mart, day = dm.Datamart(spark, str(tmp_path)), date(2024, 1, 1)
    frame = spark.createDataFrame([(1, day), (2, date(2024, 2, 1)), (3, None)], "x int, snapshot_date date")
    for _ in range(4):
        assert mart.write(frame, "a", "t") == 3
    assert mart.manifest("a", "t").state().number == 4 and mart.manifest("a", "t")._numbers() == [3, 4]
    assert len(list((tmp_path / "a" / "t").glob("_write=*"))) == 2
    assert sorted(r.x for r in mart.read("a", "t").collect()) == [1, 2, 3]
    mart.write(frame.where("x = 9"), "a", "t", snapshots=[day, "2024-02-01"])
    assert [r.x for r in mart.read("a", "t").collect()] == [3] and mart.read("a", "t", [day]).count() == 0
    audit = {(r.stage, r.snapshot_date, r.n_rows) for r in mart.audit({"t": ("a", "t")}).collect()}
    assert audit == {("t", None, 1)}


def test_second_writer_keeps_the_snapshots_of_the_first(spark, tmp_path):
    mart = dm.Datamart(spark, str(tmp_path))
    frame = spark.createDataFrame([(1, date(2024, 1, 1))], "x int, snapshot_date date")
    mart.write(frame, "a", "t")
    late = mart.manifest("a", "t")
    stale, reads = late.state(), []
    mart.write(frame.withColumn("snapshot_date", F.lit(date(2024, 2, 1))), "a", "t")
    plain = late.state
    late.state = lambda *n: plain(*n) if n or reads else reads.append(1) or stale  # it has read before the first published
    late.publish(stale.schema, {"2024-03-01": dm.Entry(stale.entries["2024-01-01"].write, 1)})
    assert sorted(mart.manifest("a", "t").state().entries) == ["2024-01-01", "2024-02-01", "2024-03-01"]


def test_folders_without_a_manifest_are_read_as_they_are(spark, tmp_path):
    frame = spark.createDataFrame([(1, date(2024, 1, 1)), (2, date(2024, 2, 1))], "x int, snapshot_date date")
    frame.write.partitionBy("snapshot_date").parquet(str(tmp_path / "a" / "t"))
    mart = dm.Datamart(spark, str(tmp_path))
    assert mart.read("a", "t").count() == 2 and mart.read("a", "t", ["2024-02-01"]).first().x == 2


def test_static_tables_are_replaced_whole(spark, tmp_path):
    mart = dm.Datamart(spark, str(tmp_path))
    frame = spark.createDataFrame([(1, date(2024, 1, 1)), (2, date(2024, 2, 1))], "x int, snapshot_date date")
    mart.write_static(frame.union(frame), "a", "s")
    assert mart.write_static(frame, "a", "s") == 2
    assert rows(mart.read("a", "s")) == rows(frame) and mart.read("a", "s", ["2024-02-01"]).first().x == 2


def test_silver_and_gold_are_compressed_by_zstd(spark, tmp_path):
    mart, sizes = dm.Datamart(spark, str(tmp_path)), {}
    for layer in ("bronze", "silver", "gold"):
        mart.write(T.ledger(spark, SF), layer, "lms")
        files = glob.glob(f"{tmp_path}/{layer}/lms/_write=*/*/part-*")
        assert files and all(f.endswith(".zstd.parquet") for f in files) == (layer != "bronze")
        sizes[layer] = sum(map(os.path.getsize, files))
        assert rows(mart.read(layer, "lms")) == rows(T.ledger(spark, SF))
    assert max(sizes["silver"], sizes["gold"]) < sizes["bronze"]


def test_gathered_ledger_is_shuffled_before_its_texts_are_made(spark, tmp_path):
    gathered = T.ledger(spark, SF, gather=True)
    plan = gathered._jdf.queryExecution().executedPlan().toString()
    assert 0 < plan.index("concat(") < plan.index("REBALANCE_PARTITIONS_BY_COL")
    assert rows(gathered) == rows(T.ledger(spark, SF))
    mart = mart_queries._ledger_mart(spark, SF)
    months = glob.glob(f"{mart.root.removeprefix('file:')}/bronze/lms/_write=*/snapshot_date=*")
    assert len(months) > 80 and all(len(glob.glob(f"{m}/part-*")) == 1 for m in months)


def test_csv_tables(spark, tmp_path):
    mart = dm.Datamart(spark, str(tmp_path), "csv")
    frame = spark.createDataFrame([(1, 'a, "b"', date(2024, 1, 1)), (2, "c", date(2024, 2, 1))], "x int, t string, snapshot_date date")
    assert mart.write(frame, "a", "t") == 2 and rows(mart.read("a", "t", schema=frame.schema)) == rows(frame)
    assert mart.read("a", "t", ["2024-02-01"], frame.schema).first().t == "c"


def test_as_of_with_salts_and_gaps(spark):
    rng = __import__("random").Random(3)
    days = [date(2024, 1 + m, d) for m in range(6) for d in (1, 9, 20)]
    facts = [(rng.choice("aaaaab"), rng.choice([*days, None]), i) for i in range(300)] + [(None, days[3], 900)]
    dims = sorted({(k, d) for k in "abc" for d in rng.sample(days, 7)}) + [(None, days[0]), ("a", None)]
    fact = spark.createDataFrame(facts, "k string, day date, f int")
    dim = spark.createDataFrame([(k, d, i) for i, (k, d) in enumerate(dims)], "k string, day date, x int")
    number = {p: i for i, p in enumerate(dims)}
    want = set()
    for k, d, f in facts:
        known = [e for c, e in dims if c == k and k and e and d and e <= d]
        if known:
            want.add((k, d, f, number[k, max(known)]))
    for salts in (0, 5):
        got = joins.as_of_join(fact, dim, ["k"], "day", salts)
        assert {tuple(r) for r in got.collect()} == want and got.count() == len(want)
    plan = joins.as_of_join(fact, dim, ["k"], "day")._jdf.queryExecution().executedPlan().toString()
    assert "Generate" not in plan and "Join" not in plan
    with pytest.raises(ValueError, match="both sides"):
        joins.as_of_join(fact, dim.withColumnRenamed("x", "F"), ["k"], "day")


def test_as_of_shuffles_a_fact_once_and_as_it_is(spark):
    fact = spark.createDataFrame([(1, date(2024, 2, 1), 7), (1, date(2024, 1, 1), 8)], "K int, day date, f int")
    dim = spark.createDataFrame([(1, date(2024, 1, 15), "x")], "k int, day date, x string")
    found = joins.as_of_join(fact, dim, ["k"], "day")
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("struct(") == 1 and "_salt" not in plan  # the dimension's values; facts have no copy of their keys
    assert found.columns == ["K", "day", "f", "x"] and [tuple(r) for r in found.collect()] == [(1, date(2024, 2, 1), 7, "x")]
    wide = dim.withColumns({"k": F.col("k").cast("double"), "day": F.col("day").cast("timestamp")})
    other = joins.as_of_join(fact, wide, ["k"], "day")
    assert other.schema == found.schema and other.collect() == found.collect()
