"""Entry points per step, for callers that run the datamart one date at a time.

Each takes directories and a session, writes its tables below the directory, and returns the frame
it wrote. ``creditmart.plans.datamart_jobs.Build.backfill`` does the same for many dates in one job.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from creditmart.functions.dates import month_starts
from creditmart.operators import encoding, profile
from creditmart.plans import gold, silver
from creditmart.plans.datamart_jobs import STATIC_SOURCES, Build
from creditmart.sources.datamart import Datamart, at_snapshot
from creditmart.sources.schemas import (
    ATTRIBUTE_FILE, CLICKSTREAM_FILE, CLICKSTREAM_SCHEMA, FINANCIAL_FILE, LABEL_SCHEMA, LOAN_DAILY_SCHEMA,
    LOAN_FILE,
)

SOURCE_DIR = "data"


def _at(spark: SparkSession, directory: str) -> tuple[Datamart, str]:
    """The datamart whose layer is the given directory."""
    root, _, layer = directory.rstrip("/").rpartition("/")
    return Datamart(spark, root or "."), layer


def process_bronze_table(
    snapshot_date_str: str, bronze_lms_directory: str, spark: SparkSession, source_dir: str = SOURCE_DIR
) -> DataFrame:
    """Ingest one snapshot of the loan ledger into ``<directory>/loan_daily``."""
    mart, layer = _at(spark, bronze_lms_directory)
    loans = at_snapshot(Build(spark, source_dir, mart).source("lms"), snapshot_date_str)
    mart.write(loans, layer, "loan_daily", snapshots=[snapshot_date_str])
    return mart.read(layer, "loan_daily", [snapshot_date_str], LOAN_FILE)


def process_bronze_feature_tables(
    date_str: str, bronze_directory: str, spark: SparkSession, source_dir: str = SOURCE_DIR
) -> dict[str, DataFrame]:
    """Ingest financials and attributes whole and one snapshot of the clickstream."""
    mart, layer = _at(spark, bronze_directory)
    build = Build(spark, source_dir, mart)
    frames = {}
    for name, schema in zip(STATIC_SOURCES, (FINANCIAL_FILE, ATTRIBUTE_FILE)):
        mart.write_static(build.source(name), layer, name)
        frames[name] = mart.read(layer, name, schema=schema)
    mart.write(at_snapshot(build.source("clickstream"), date_str), layer, "clickstream", snapshots=[date_str])
    frames["clickstream"] = mart.read(layer, "clickstream", [date_str], CLICKSTREAM_FILE)
    return frames


def process_silver_table(
    snapshot_date_str: str, bronze_lms_directory: str, silver_loan_daily_directory: str, spark: SparkSession
) -> DataFrame:
    """Type one snapshot of the ledger and add months on book and days past due."""
    bronze, bronze_layer = _at(spark, bronze_lms_directory)
    mart, table = _at(spark, silver_loan_daily_directory)
    loans = silver.loan_daily(bronze.read(bronze_layer, "loan_daily", [snapshot_date_str], LOAN_FILE))
    mart.write(loans, "", table, snapshots=[snapshot_date_str])
    return mart.read("", table, [snapshot_date_str], loans.schema)


def process_customer_attributes(attributes_path: str, spark: SparkSession) -> DataFrame:
    """Attributes features from a CSV file, or from a bronze Parquet table."""
    if attributes_path.endswith(".csv"):
        text = spark.read.option("header", True).option("escape", '"').csv(attributes_path)  # all text: nothing inferred
        typed = {f.name: F.col(f.name).cast(f.dataType) for f in ATTRIBUTE_FILE if f.name in text.columns}
        return silver.attributes(text.withColumns(typed))
    mart, table = _at(spark, attributes_path)
    return silver.attributes(mart.read("", table, schema=ATTRIBUTE_FILE))


def process_customer_features(
    bronze_feature_directory: str, silver_feature_directory: str, spark: SparkSession, join_attributes: bool = True
) -> DataFrame:
    """Customer features from the bronze financials, with the attributes unless declined."""
    bronze, bronze_layer = _at(spark, bronze_feature_directory)
    mart, layer = _at(spark, silver_feature_directory)
    numbers = silver.financial_numbers(bronze.read(bronze_layer, "financials", schema=FINANCIAL_FILE))
    mart.write_static(numbers, layer, "financial_numbers")
    features = silver.customer_features(
        mart.read(layer, "financial_numbers"),
        bronze.read(bronze_layer, "attributes", schema=ATTRIBUTE_FILE) if join_attributes else None,
        parsed=True,
    )
    mart.write_static(features, layer, "financial_attributes")
    return mart.read(layer, "financial_attributes")


def process_silver_cs_features(
    snapshot_date_str: str, bronze_feature_directory: str, silver_feature_directory: str, spark: SparkSession
) -> DataFrame:
    """Type one snapshot of the clickstream."""
    bronze, bronze_layer = _at(spark, bronze_feature_directory)
    mart, layer = _at(spark, silver_feature_directory)
    clicks = bronze.read(bronze_layer, "clickstream", [snapshot_date_str], CLICKSTREAM_FILE)
    typed = silver.clickstream(clicks)
    mart.write(typed, layer, "clickstream", snapshots=[snapshot_date_str])
    return mart.read(layer, "clickstream", [snapshot_date_str], typed.schema)


def process_labels_gold_table(
    snapshot_date_str: str,
    silver_loan_daily_directory: str,
    gold_label_store_directory: str,
    spark: SparkSession,
    dpd: int,
    mob: int,
) -> DataFrame:
    """Default labels of one snapshot."""
    loans, loan_table = _at(spark, silver_loan_daily_directory)
    mart, table = _at(spark, gold_label_store_directory)
    silver_loans = loans.read("", loan_table, [snapshot_date_str], LOAN_DAILY_SCHEMA)
    mart.write(gold.label_store(silver_loans, dpd, mob), "", table, snapshots=[snapshot_date_str])
    return mart.read("", table, [snapshot_date_str], LABEL_SCHEMA)


def process_features_gold_table(
    date_str: str, snapshot_date: str, silver_feature_directory: str, gold_feature_store_directory: str,
    spark: SparkSession, as_of: bool = False, duplicates: bool = False,
) -> DataFrame:
    """Feature store rows of one snapshot; ``snapshot_date`` is the last date to include. ``as_of`` and ``duplicates`` as
    in ``gold.feature_store``."""
    features, layer = _at(spark, silver_feature_directory)
    mart, table = _at(spark, gold_feature_store_directory)
    clicks = features.read(layer, "clickstream", [date_str], CLICKSTREAM_SCHEMA)
    customers = features.read(layer, "financial_attributes")
    store = gold.feature_store(clicks, customers, snapshot_date, as_of, duplicates=duplicates)
    mart.write(store, "", table, snapshots=[date_str])
    return mart.read("", table, [date_str], store.schema)


def plot_distributions(df: DataFrame, columns: list[str] | None = None, bins: int = 30) -> dict[str, DataFrame]:
    """The tables behind distribution plots of the numeric columns: bins, densities and statistics."""
    return profile.distributions(df, columns, bins)


def generate_first_of_month_dates(start_date_str: str, end_date_str: str) -> list[str]:
    return [d.isoformat() for d in month_starts(start_date_str, end_date_str)]


def one_hot_encode_categorical(df: DataFrame, categorical_column: str) -> DataFrame:
    return encoding.one_hot(df, categorical_column)
