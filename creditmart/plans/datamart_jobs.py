"""Jobs that build the datamart. Each stage covers all asked-for months in one plan and one write,
and replaces exactly those months, so running it again gives the same tables."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame, SparkSession

from creditmart.plans import fitted, gold, silver
from creditmart.sources import schemas
from creditmart.sources.datamart import Datamart, at_snapshots, read_csv

# Names of the source files.
SOURCE_FILES = {
    "lms": "lms_loan_daily.csv",
    "financials": "features_financials.csv",
    "attributes": "features_attributes.csv",
    "clickstream": "feature_clickstream.csv",
}
FILE_SCHEMAS = {
    "lms": schemas.LOAN_FILE,
    "financials": schemas.FINANCIAL_FILE,
    "attributes": schemas.ATTRIBUTE_FILE,
    "clickstream": schemas.CLICKSTREAM_FILE,
}
SNAPSHOT_SOURCES = ("lms", "clickstream")
STATIC_SOURCES = ("financials", "attributes")


@dataclass(frozen=True)
class Build:
    """Where the sources are, where the datamart goes, and the parameters of its tables."""

    spark: SparkSession
    source_dir: str
    mart: Datamart
    dpd: int = 60
    mob: int = 6
    end: str | date | None = None
    join_attributes: bool = True
    vocab: silver.Vocabularies = silver.Vocabularies()
    salts: int = 0
    as_of: bool = False
    duplicates: bool = False
    fitted: str | date | None = None

    def source(self, name: str) -> DataFrame:
        """A source file, in the column order the file has."""
        path = f"{self.source_dir.rstrip('/')}/{SOURCE_FILES[name]}"
        header = self.spark.read.option("header", True).option("escape", '"').csv(path).columns
        known = FILE_SCHEMAS[name]
        types = {f.name: f for f in known}
        missing = [c for c in types if c not in header]
        if missing:
            raise ValueError(f"{path} lacks the columns {missing}")
        schema = type(known)([types[c] if c in types else f for c, f in ((h, _text(h)) for h in header)])
        return read_csv(self.spark, path, schema)

    def bronze(self, snapshots: Sequence[str | date], sources: Sequence[str] = tuple(SOURCE_FILES)) -> dict[str, int]:
        """Ingest the sources; those split by snapshot only for the given ones."""
        rows = {}
        for name in sources:
            if name in SNAPSHOT_SOURCES:
                rows[name] = self.mart.write(at_snapshots(self.source(name), snapshots), "bronze", name, snapshots=snapshots)
            else:
                rows[name] = self.mart.write_static(self.source(name), "bronze", name)
        return rows

    def bronze_frame(self, name: str, snapshots: Sequence[str | date] | None = None) -> DataFrame:
        """A bronze table with its known columns as the file schema says, and the source's other columns as text."""
        known = FILE_SCHEMAS[name]
        have = {f.name for f in known}
        others = [f for f in self.mart.read("bronze", name, merge_schema=name in SNAPSHOT_SOURCES).schema if f.name not in have]
        return self.mart.read("bronze", name, snapshots, type(known)([*known.fields, *others]))

    def silver_loans(self, snapshots: Sequence[str | date]) -> int:
        loans = silver.loan_daily(self.bronze_frame("lms", snapshots))
        return self.mart.write(loans, "silver", "loan_daily", gather=False, snapshots=snapshots)

    def silver_customers(self) -> int:
        """The parsed numbers are stored first: the caps' and vocabularies' passes then read a typed
        column each instead of parsing the text again.

        With ``fitted``, caps, medians and vocabularies are those stored under that date; if there are none, they are fitted
        now and stored. Otherwise they are fitted in every run and not kept."""
        self.mart.write_static(silver.financial_numbers(self.bronze_frame("financials")), "silver", "financial_numbers")
        attributes = self.bronze_frame("attributes") if self.join_attributes else None
        numbers = self.mart.read("silver", "financial_numbers")
        state = None if self.fitted is None else self._state(numbers, attributes)
        customers = silver.customer_features(numbers, attributes, self.vocab, parsed=True, fitted=state)
        return self.mart.write_static(customers, "silver", "financial_attributes")

    def _state(self, numbers: DataFrame, attributes: DataFrame | None) -> silver.Fitted:
        if str(self.fitted) not in fitted.versions(self.mart):
            fitted.save(self.mart, silver.fit_customers(numbers, attributes, self.vocab), self.fitted)
        return fitted.load(self.mart, self.fitted)

    def silver_clickstream(self, snapshots: Sequence[str | date]) -> int:
        clicks = silver.clickstream(self.bronze_frame("clickstream", snapshots))
        return self.mart.write(clicks, "silver", "clickstream", gather=False, snapshots=snapshots)

    def gold_labels(self, snapshots: Sequence[str | date]) -> int:
        loans = self.mart.read("silver", "loan_daily", snapshots, schemas.LOAN_DAILY_SCHEMA)
        return self.mart.write(gold.label_store(loans, self.dpd, self.mob), "gold", "label_store", snapshots=snapshots)

    def gold_features(self, snapshots: Sequence[str | date]) -> int:
        clicks = self.mart.read("silver", "clickstream", snapshots, schemas.CLICKSTREAM_SCHEMA)
        customers = self.mart.read("silver", "financial_attributes")
        features = gold.feature_store(clicks, customers, self.end, self.as_of, self.salts, self.duplicates)
        return self.mart.write(features, "gold", "feature_store", snapshots=snapshots)

    def backfill(self, snapshots: Sequence[str | date]) -> dict[str, int]:
        """Every stage for all snapshots; returns the rows written per table."""
        return {
            **{f"bronze.{name}": n for name, n in self.bronze(snapshots).items()},
            "silver.loan_daily": self.silver_loans(snapshots),
            "silver.financial_attributes": self.silver_customers(),
            "silver.clickstream": self.silver_clickstream(snapshots),
            "gold.label_store": self.gold_labels(snapshots),
            "gold.feature_store": self.gold_features(snapshots),
        }


def _text(name: str):
    return schemas.StructField(name, schemas.StringType())
