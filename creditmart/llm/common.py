"""Small helpers that the operators share."""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from creditmart.session import shared_folder


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def remainder(doc_id: Column, k: int) -> Column:
    """crc32 of the id as text, modulo k; a null id counts as empty text."""
    return (F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % k).cast("int")


#: Spark's setting that drops a query's shuffle files as soon as it has ended.
DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def stored(df: DataFrame) -> DataFrame:
    """The frame written to a table in the cluster's shared folder and read again: later plans start from files."""
    return stored_at(df)[0]


def stored_at(df: DataFrame) -> tuple[DataFrame, str]:
    """The same, and the table's path. Its shuffle files go when it is written: nothing reads them any more."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{uuid.uuid4().hex}.parquet"
    before = spark.conf.get(DROP_SHUFFLES)
    spark.conf.set(DROP_SHUFFLES, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        spark.conf.set(DROP_SHUFFLES, before)
    delete_at_end(spark, path)
    return spark.read.schema(df.schema).parquet(path), path


def discard(spark: SparkSession, *paths: str) -> None:
    """Delete stored tables that nothing will read again."""
    for path in paths:
        folder = spark._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def delete_at_end(spark: SparkSession, path: str) -> None:
    """Have the folder removed when the session's JVM ends."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(folder)


def free_name(df: DataFrame, wanted: str) -> str:
    """`wanted`, or a variant that no column of the frame has (names are compared without case)."""
    taken = {c.lower() for c in df.columns}
    while wanted.lower() in taken:
        wanted += "_"
    return wanted


def pieces(values: list, weight, limit: int) -> Iterator[tuple[int, int]]:
    """Consecutive ranges of the list whose weights sum up to about the limit; a heavier item stands alone."""
    start, total = 0, 0
    for i, v in enumerate(values):
        w = weight(v)
        if i > start and total + w > limit:
            yield start, i
            start, total = i, 0
        total += w
    if start < len(values):
        yield start, len(values)


def with_arrays(batch: pa.RecordBatch, schema: pa.Schema, arrays: dict[str, pa.Array]) -> pa.RecordBatch:
    """The batch's columns in the order of the schema, with the given ones added or replaced."""
    have = {n: batch.column(i) for i, n in enumerate(batch.schema.names)}
    return pa.RecordBatch.from_arrays([arrays.get(f.name, have.get(f.name)) for f in schema], names=schema.names)


def segment_ids(lengths: Iterable[int]) -> np.ndarray:
    lengths = np.asarray(lengths, dtype=np.int64)
    return np.repeat(np.arange(len(lengths)), lengths)
