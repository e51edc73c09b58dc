"""Reading source files, and reading and writing the partitioned datamart tables."""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.types import StructType

from creditmart.sources.manifest import Entry, Manifest

PARTITION = "snapshot_date"
#: The level of a table's folders that tells its writes apart, and the key of rows without a date.
WRITE, UNDATED = "_write", "__HIVE_DEFAULT_PARTITION__"
#: Layers whose Parquet files are made smaller by zstd. Not bronze: tasks read it by size of file and sort all rows they write
#: to silver, so that smaller files would mean more rows to sort in a task.
ZSTD_LAYERS = ("silver", "gold")


def read_csv(spark: SparkSession, path: str | Sequence[str], schema: StructType | None = None) -> DataFrame:
    """Files with a header. With a schema nothing is inferred, and columns are matched by position
    but checked against the header; without one Spark infers types in an extra pass."""
    reader = spark.read.option("header", True).option("escape", '"')
    if schema is None:
        return reader.option("inferSchema", True).csv(path)
    return reader.schema(schema).option("enforceSchema", False).csv(path)


@dataclass(frozen=True)
class Datamart:
    """Tables under ``root/<layer>/<table>``, split by snapshot date unless static.

    A write goes to a folder of its own and counts once it is published (see ``manifest``). A folder without a manifest, written
    by others, is read as it is.
    """

    spark: SparkSession
    root: str
    file_format: str = "parquet"

    def path(self, layer: str, table: str) -> str:
        return "/".join([self.root.rstrip("/"), *filter(None, (layer, table))])

    def manifest(self, layer: str, table: str) -> Manifest:
        return Manifest(self.spark, self.path(layer, table))

    def read(
        self,
        layer: str,
        table: str,
        snapshots: Sequence[str | date] | None = None,
        schema: StructType | None = None,
        merge_schema: bool = False,
    ) -> DataFrame:
        """All snapshots as one frame, or the named ones only (their directories are all that is
        read). ``merge_schema`` is for tables whose encoded columns differ between snapshots."""
        state, base = self.manifest(layer, table).state(), self.path(layer, table)
        reader = self._reader(schema).option("mergeSchema", merge_schema)
        if state.number == 0:
            df = reader.load(base)
            return df if snapshots is None else at_snapshots(df, snapshots)
        asked = None if snapshots is None else {str(s) for s in snapshots}
        folders = [f"{base}/{e.write}{_below(k)}" for k, e in state.entries.items() if asked is None or not k or k in asked]
        if not folders:
            return self.spark.createDataFrame([], schema or StructType.fromJson(json.loads(state.schema)))
        df = reader.option("basePath", base).load(folders).drop(WRITE)
        return df if snapshots is None or PARTITION not in df.columns else at_snapshots(df, snapshots)

    def _reader(self, schema: StructType | None):
        reader = self.spark.read.format(self.file_format)
        if self.file_format == "csv":
            reader = reader.option("header", True).option("escape", '"')
        return reader if schema is None else reader.schema(schema)

    def write(
        self, df: DataFrame, layer: str, table: str, gather: bool = True, snapshots: Sequence[str | date] | None = None
    ) -> int:
        """Replace the snapshots present in ``df``, leave the others, and return the rows written.

        Of the named ``snapshots``, those without rows in ``df`` are cleared too: a re-run leaves nothing
        behind of what an earlier run has written for them. All of that is published at once, after the write.

        Rows are gathered by snapshot before writing, so a snapshot gets few large files; a snapshot
        too large for one task is split again by the rebalancing. A frame that is only a projection
        of a table split by snapshot is gathered already: without ``gather`` it is written as it
        comes, with no shuffle. Rows are counted while writing, in all and for each named snapshot.
        """
        seen, day = Observation(), F.col(PARTITION).cast("date").cast("string")
        named = sorted({str(s) for s in snapshots or ()})
        counts = [F.count_if(day == s).alias(f"rows_{i}") for i, s in enumerate(named)]
        write = self._write_to(
            (df.hint("rebalance", PARTITION) if gather else df).observe(
                seen, F.count(F.lit(1)).alias("rows"), F.count_if(day.isNull()).alias("undated"), F.collect_set(day).alias("present"), *counts
            ),
            layer, table, [PARTITION],
        )
        found = seen.get
        rows = {s: found[f"rows_{i}"] for i, s in enumerate(named)} | ({UNDATED: found["undated"]} if found["undated"] else {})
        if set(found["present"]) - set(named):  # snapshots that were not named: counts from the written files
            written = self._reader(None).option("basePath", self.path(layer, table)).load(f"{self.path(layer, table)}/{write}")
            rows |= {r[0]: r[1] for r in written.where(F.col(PARTITION).isNotNull()).groupBy(day).count().collect()}
        self.publish(df, layer, table, {s: Entry(write, n) if n else None for s, n in rows.items()})
        return found["rows"]

    def _write_to(self, df: DataFrame, layer: str, table: str, split: Sequence[str]) -> str:
        """Write to a new folder of the table; its name."""
        write = f"{WRITE}=w{uuid.uuid4().hex}"
        writer = df.write.format(self.file_format).option("header", True).option("escape", '"').partitionBy(*split)
        if self.file_format == "parquet" and layer in ZSTD_LAYERS:
            writer = writer.option("compression", "zstd")
        writer.save(f"{self.path(layer, table)}/{write}")
        return write

    def publish(self, df: DataFrame, layer: str, table: str, changes: dict[str, Entry | None]) -> None:
        self.manifest(layer, table).publish(df.schema.json(), changes)

    def write_static(self, df: DataFrame, layer: str, table: str) -> int:
        """Replace a table that is not split by snapshot."""
        seen = Observation()
        write = self._write_to(df.observe(seen, F.count(F.lit(1)).alias("rows")), layer, table, [])
        self.publish(df, layer, table, {"": Entry(write, seen.get["rows"])})
        return seen.get["rows"]

    def audit(self, tables: dict[str, tuple[str, str]]) -> DataFrame:
        """(`stage`, `snapshot_date`, `n_rows`) of the tables (layer and name by stage), as counted when they were written."""
        rows = []
        for stage, (layer, table) in tables.items():
            for key, entry in self.manifest(layer, table).state().entries.items():
                rows.append((stage, date.fromisoformat(key) if key not in ("", UNDATED) else None, entry.rows))
        return self.spark.createDataFrame(rows, f"stage string, {PARTITION} date, n_rows bigint")


def _below(key: str) -> str:
    return f"/{PARTITION}={key}" if key else ""


def at_snapshots(df: DataFrame, snapshots: Sequence[str | date], column: str = PARTITION) -> DataFrame:
    """Rows of the named snapshots; literals, so that partitions and files are skipped."""
    return df.where(F.col(column).isin([F.lit(str(s)).cast("date") for s in snapshots]))


def at_snapshot(df: DataFrame, snapshot: str | date, column: str = PARTITION) -> DataFrame:
    """Rows of one snapshot; a table without the column is returned whole."""
    return at_snapshots(df, [snapshot], column) if column in df.columns else df


def up_to(df: DataFrame, end: str | date, column: str = PARTITION) -> DataFrame:
    return df.where(F.col(column) <= F.lit(str(end)).cast("date"))


def between(df: DataFrame, start: str | date, end: str | date, column: str = PARTITION) -> DataFrame:
    """Rows dated from ``start`` to ``end``, both included."""
    return df.where(F.col(column).between(F.lit(str(start)).cast("date"), F.lit(str(end)).cast("date")))


def month_calendar(df: DataFrame, column: str, name: str = PARTITION) -> DataFrame:
    """First days of all months from the first to the last date in the column."""
    ends = df.agg(F.min(column).alias("first"), F.max(column).alias("last"))
    months = F.sequence(F.trunc("first", "month"), F.col("last").cast("date"), F.expr("interval 1 month"))
    return ends.where(F.col("first").isNotNull()).select(F.explode(months).alias(name))


def snapshot_counts(tables: dict[str, DataFrame], column: str = PARTITION) -> DataFrame:
    """Rows per stage and snapshot, for auditing a run."""
    counts = None
    for stage, df in tables.items():
        at = F.col(column).cast("date") if column in df.columns else F.lit(None).cast("date")
        one = df.groupBy(F.lit(stage).alias("stage"), at.alias(column)).agg(F.count(F.lit(1)).alias("n_rows"))
        counts = one if counts is None else counts.unionByName(one)
    if counts is None:
        raise ValueError("no tables given")
    return counts
