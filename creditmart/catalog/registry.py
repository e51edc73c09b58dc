"""The table of named queries."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

Run = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    run: Run
    sql: str | None


QUERIES: dict[str, Query] = {}


def query(sql: str | None = None) -> Callable[[Run], Run]:
    """Register the function under its name, with the SQL that must give the same rows."""

    def register(run: Run) -> Run:
        if run.__name__ in QUERIES:
            raise ValueError(f"query {run.__name__} is registered twice")
        QUERIES[run.__name__] = Query(run, sql)
        return run

    return register
