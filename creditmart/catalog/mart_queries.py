"""Scans, sinks, ingestion and job control. These write tables first, then read them back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from creditmart.catalog import tables as T
from creditmart.catalog.registry import query
from creditmart.functions.dates import month_starts
from creditmart.plans import gold, silver
from creditmart.plans.datamart_jobs import SOURCE_FILES, Build
from creditmart.sources import datamart as dm
from creditmart.sources.schemas import LOAN_FILE

DAY = "1998-06-01"
FIRST, LAST = "1997-01-15", "1997-12-01"
#: Most rows of a source file. A compressed file is read by one task.
FILE_ROWS = 500_000


def _source_files(spark: SparkSession, sf_dir: str, *names: str) -> str:
    """Write the source views as compressed CSV files of a new folder."""
    views = {
        "lms": T.raw_ledger,
        "financials": T.financials,
        "attributes": T.attributes,
        "clickstream": T.clickstream,
    }
    root = f"{T.scratch_root(spark)}/source"
    for name in names:
        files = views[name](spark, sf_dir).write.option("header", True).option("escape", '"')
        files = files.option("compression", "gzip").option("zlib.compress.level", "BEST_SPEED").option("maxRecordsPerFile", FILE_ROWS)
        files.csv(f"{root}/{SOURCE_FILES[name]}")
    return root


def _build(spark: SparkSession, sf_dir: str, *names: str) -> Build:
    return Build(spark, _source_files(spark, sf_dir, *names), dm.Datamart(spark, T.scratch_root(spark)), dpd=30)


@query(
    T.with_views("raw_ledger")
    + """SELECT snapshot_date, count(*) AS n_rows, count(overdue_amt) AS n_overdue,
    count(TRY_CAST(due_amt AS DOUBLE)) AS n_due, max(loan_id) AS last_loan
    FROM raw_ledger GROUP BY snapshot_date"""
)
def scan_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{_source_files(spark, sf_dir, 'lms')}/{SOURCE_FILES['lms']}"
    return (
        dm.read_csv(spark, path, LOAN_FILE)
        .groupBy("snapshot_date")
        .agg(
            F.count(F.lit(1)).alias("n_rows"),
            F.count("overdue_amt").alias("n_overdue"),
            F.count(F.col("due_amt").try_cast("double")).alias("n_due"),
            F.max("loan_id").alias("last_loan"),
        )
    )


def _ledger_mart(spark: SparkSession, sf_dir: str) -> dm.Datamart:
    mart = dm.Datamart(spark, T.scratch_root(spark))
    mart.write(T.ledger(spark, sf_dir, gather=True), "bronze", "lms", gather=False)
    return mart


@query(
    T.with_views("ledger")
    + f"SELECT loan_id, Customer_ID, installment_num, snapshot_date FROM ledger WHERE snapshot_date = DATE '{DAY}'"
)
def scan_parquet(spark: SparkSession, sf_dir: str) -> DataFrame:
    one = _ledger_mart(spark, sf_dir).read("bronze", "lms", [DAY])
    return one.select("loan_id", "Customer_ID", "installment_num", "snapshot_date")


@query(
    T.with_views("ledger")
    + """SELECT snapshot_date, count(*) AS n_rows, count(due_amt) AS n_due,
    CAST(sum(installment_num) AS BIGINT) AS installments FROM ledger GROUP BY snapshot_date"""
)
def scan_all_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        _ledger_mart(spark, sf_dir)
        .read("bronze", "lms")
        .groupBy("snapshot_date")
        .agg(
            F.count(F.lit(1)).alias("n_rows"),
            F.count("due_amt").alias("n_due"),
            F.sum("installment_num").alias("installments"),
        )
    )


# A blank cell of a CSV file is a missing value.
@query(
    T.with_views("raw_ledger")
    + f"""SELECT * REPLACE (nullif(installment_num, '') AS installment_num) FROM raw_ledger
    WHERE snapshot_date = DATE '{DAY}'"""
)
def bronze_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    build = _build(spark, sf_dir, "lms")
    build.bronze([DAY], ["lms"])
    return build.bronze_frame("lms", [DAY])


@query(
    T.with_views("financials", "attributes", "clickstream")
    + f"""SELECT 'attributes' AS stage, snapshot_date, count(*) AS n_rows FROM attributes GROUP BY 2
    UNION ALL SELECT 'financials', snapshot_date, count(*) FROM financials GROUP BY 2
    UNION ALL SELECT 'clickstream', snapshot_date, count(*) FROM clickstream
    WHERE snapshot_date = DATE '{DAY}' GROUP BY 2"""
)
def bronze_multi(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = ("financials", "attributes", "clickstream")
    build = _build(spark, sf_dir, *names)
    build.bronze([DAY], names)
    return dm.snapshot_counts({name: build.bronze_frame(name) for name in names})


@query(
    """SELECT CAST(unnest(generate_series(date_trunc('month', min(l_shipdate)), max(l_shipdate), INTERVAL 1 MONTH))
    AS DATE) AS snapshot_date FROM lineitem"""
)
def month_calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dm.month_calendar(T.table(spark, sf_dir, "lineitem"), "l_shipdate")


RAW_LOAN_DAILY = (
    T.with_views("raw_ledger")
    + """, typed AS (SELECT loan_id, Customer_ID, TRY_CAST(loan_start_date AS DATE) AS loan_start_date,
    CAST(trunc(TRY_CAST(tenure AS DOUBLE)) AS INTEGER) AS tenure,
    CAST(trunc(TRY_CAST(installment_num AS DOUBLE)) AS INTEGER) AS installment_num,
    TRY_CAST(loan_amt AS FLOAT) AS loan_amt, TRY_CAST(due_amt AS FLOAT) AS due_amt,
    TRY_CAST(paid_amt AS FLOAT) AS paid_amt, TRY_CAST(overdue_amt AS FLOAT) AS overdue_amt,
    TRY_CAST(balance AS FLOAT) AS balance, snapshot_date FROM raw_ledger), """
)
RAW_LOAN_DAILY += ", ".join(
    f"{name} AS ({T.VIEWS[name].replace('FROM ledger', 'FROM typed')})" for name in ("missed", "dated", "loan_daily")
)


@query(
    RAW_LOAN_DAILY
    + """ SELECT loan_id, Customer_ID, CAST(CASE WHEN dpd >= 30 THEN 1 ELSE 0 END AS INTEGER) AS label,
    '30dpd_6mob' AS label_def, snapshot_date FROM loan_daily
    WHERE mob = 6 AND snapshot_date BETWEEN DATE '1997-01-01' AND DATE '1997-12-01'"""
)
def backfill_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    months = month_starts(FIRST, LAST)
    build = _build(spark, sf_dir, "lms")
    build.bronze(months, ["lms"])
    build.silver_loans(months)
    build.gold_labels(months)
    return build.mart.read("gold", "label_store")


@query(
    T.with_views("loan_daily")
    + """SELECT 'bronze' AS stage, snapshot_date, count(*) AS n_rows FROM ledger GROUP BY 2
    UNION ALL SELECT 'silver', snapshot_date, count(*) FROM loan_daily GROUP BY 2
    UNION ALL SELECT 'gold', snapshot_date, count(*) FROM loan_daily WHERE mob = 6 GROUP BY 2"""
)
def stage_row_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counted while each table was written: the source is read once, silver from bronze, gold from silver."""
    mart = _ledger_mart(spark, sf_dir)
    mart.write(silver.loan_daily(mart.read("bronze", "lms")), "silver", "loan_daily", gather=False)
    mart.write(gold.label_store(mart.read("silver", "loan_daily")), "gold", "label_store", gather=False)
    return mart.audit({"bronze": ("bronze", "lms"), "silver": ("silver", "loan_daily"), "gold": ("gold", "label_store")})


@query(
    T.with_views("loan_daily")
    + """, first AS (SELECT *, 6 AS m, 30 AS d FROM loan_daily WHERE snapshot_date BETWEEN DATE '1997-01-01' AND DATE '1997-12-01'),
    again AS (SELECT *, 4 AS m, 60 AS d FROM loan_daily WHERE snapshot_date BETWEEN DATE '1997-03-01' AND DATE '1997-04-01'),
    rows AS (SELECT * FROM first WHERE snapshot_date NOT BETWEEN DATE '1997-03-01' AND DATE '1997-06-01' UNION ALL SELECT * FROM again)
    SELECT loan_id, Customer_ID, CAST(CASE WHEN dpd >= d THEN 1 ELSE 0 END AS INTEGER) AS label,
    concat(CAST(d AS VARCHAR), 'dpd_', CAST(m AS VARCHAR), 'mob') AS label_def, snapshot_date FROM rows WHERE mob = m"""
)
def rerun_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A year of labels, of which four months are run again with other parameters: two of them have no rows any more."""
    mart = dm.Datamart(spark, T.scratch_root(spark))
    year, again = month_starts("1997-01-01", "1997-12-01"), month_starts("1997-03-01", "1997-06-01")
    mart.write(silver.loan_daily(dm.at_snapshots(T.ledger(spark, sf_dir), year)), "silver", "loan_daily", snapshots=year)
    mart.write(gold.label_store(mart.read("silver", "loan_daily"), 30, 6), "gold", "label_store", gather=False, snapshots=year)
    late = mart.read("silver", "loan_daily", again[:2])
    mart.write(gold.label_store(late, 60, 4), "gold", "label_store", gather=False, snapshots=again)
    return mart.read("gold", "label_store")


@query(T.with_views("financials") + "SELECT max(snapshot_date) AS latest FROM financials")
def latest_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return T.financials(spark, sf_dir).agg(F.max("snapshot_date").alias("latest"))


