"""Gold tables: default labels and the feature store."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame

from creditmart.operators.joins import as_of_join, lookup_join, require_unique
from creditmart.operators.labels import default_labels
from creditmart.sources.datamart import up_to


def label_store(silver_loans: DataFrame, dpd: int = 60, mob: int = 6) -> DataFrame:
    return default_labels(silver_loans, dpd, mob)


def feature_store(
    silver_clickstream: DataFrame,
    customers: DataFrame,
    end: str | date | None = None,
    as_of: bool = False,
    salts: int = 0,
    duplicates: bool = False,
) -> DataFrame:
    """Clickstream rows up to ``end`` with their customer's features.

    By default the customer features' own date is ignored, so a row may see features dated later
    than itself; a customer with several feature rows is then an error, unless ``duplicates`` allows
    a row per pair. ``as_of`` joins the customer's newest features not dated after the row instead;
    a customer has one feature row a date then. ``salts`` spreads customers with very many rows over
    that many tasks.
    """
    clicks = silver_clickstream if end is None else up_to(silver_clickstream, end)
    if not (as_of or duplicates):
        require_unique(customers, ["Customer_ID"])
    if not as_of:
        return lookup_join(clicks, customers.drop("snapshot_date"), ["Customer_ID"], salts=salts)
    require_unique(customers, ["Customer_ID", "snapshot_date"])
    return as_of_join(clicks, customers, ["Customer_ID"], "snapshot_date", salts)
