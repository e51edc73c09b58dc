"""Session settings the jobs run with. They change speed only; results are the same without them."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    # Sizes are only known at run time: join strategy, skew and small partitions are decided then.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # The wide cleaning projections generate methods beyond the 8000 bytes the JVM compiles to machine
    # code. Past this limit Spark generates small methods instead, which is several times faster.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def shared_folder(spark: SparkSession, otherwise: str | None = None) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    Only where none is named and Spark runs in one process, ``otherwise`` or a new local folder, removed when
    the session ends, takes its place: on a cluster, executors could not see it.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        if not (named or context.master == "local" or context.master.startswith("local[")):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        folder = named or otherwise
        if folder is None:
            folder = tempfile.mkdtemp(prefix="creditmart-")
            path = context._jvm.org.apache.hadoop.fs.Path(f"file://{folder}")
            path.getFileSystem(context._jsc.hadoopConfiguration()).deleteOnExit(path)
        context.setCheckpointDir(folder)
    return (named or context.getCheckpointDir()).rstrip("/")


def materialized(df: DataFrame) -> DataFrame:
    """The frame computed once and stored in the shared folder, for plans that read it repeatedly."""
    shared_folder(df.sparkSession)
    return df.checkpoint()


def builder(app: str) -> SparkSession.Builder:
    b = SparkSession.builder.appName(app)
    for name, value in SETTINGS.items():
        b = b.config(name, value)
    return b
