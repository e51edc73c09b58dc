"""The fitted state of the customer features as a versioned table, so that later snapshots are treated alike.

A version is the date it was fitted for: one snapshot of the table ``fitted/customers``, a row for each number and category.
"""

from __future__ import annotations

from dataclasses import fields
from datetime import date

from pyspark.sql import functions as F

from creditmart.plans.silver import Fitted, Vocabularies
from creditmart.sources.datamart import PARTITION, Datamart

LAYER, TABLE = "fitted", "customers"
SCHEMA = "kind string, name string, place int, number double, whole bigint, category string"


def _number(kind: str, name: str, value: float | int | None) -> tuple:
    """Whole numbers are kept apart, for they may be beyond what a double holds exactly."""
    return kind, name, 0, None if value is None or isinstance(value, int) else value, value if isinstance(value, int) else None, None


def save(mart: Datamart, fitted: Fitted, version: str | date) -> None:
    rows = [_number("cut", "Monthly_Balance", fitted.balance_cut), _number("median", "Age", fitted.age_median)]
    rows += [_number("cap", name, cap) for name, cap in fitted.caps.items()]
    for f in fields(Vocabularies):
        values = getattr(fitted.vocab, f.name)
        rows += [("known", f.name, 0, None, None, None)] * (values is not None)
        rows += [("category", f.name, i, None, None, v) for i, v in enumerate(values or ())]
    frame = mart.spark.createDataFrame(rows, SCHEMA).withColumn(PARTITION, F.lit(str(version)).cast("date"))
    mart.write(frame, LAYER, TABLE, snapshots=[version])


def versions(mart: Datamart) -> list[str]:
    return sorted(k for k in mart.manifest(LAYER, TABLE).state().entries if k)


def load(mart: Datamart, version: str | date | None = None) -> Fitted:
    """The state of a version, or the newest one."""
    have = versions(mart)
    wanted = str(version) if version is not None else max(have, default=None)
    if wanted not in have:
        raise ValueError(f"no fitted state of {wanted}; there are {have}")
    rows = mart.read(LAYER, TABLE, [wanted]).orderBy("place").collect()
    value = {(r["kind"], r["name"]): r["number"] if r["whole"] is None else r["whole"] for r in rows}
    vocab = {r["name"]: [] for r in rows if r["kind"] == "known"}
    for r in rows:
        if r["kind"] == "category":
            vocab[r["name"]].append(r["category"])
    caps = {name: v for (kind, name), v in value.items() if kind == "cap"}
    return Fitted(value["cut", "Monthly_Balance"], caps, value["median", "Age"], Vocabularies(**vocab))
