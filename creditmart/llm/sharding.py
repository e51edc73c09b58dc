"""Shuffled shards by a two-pass external shuffle.

First pass: a record's shard follows from its key and the number of shards by consistent hashing, and a seeded hash of the
whole record scatters the shard's records over buckets of about equal size that fit in memory. Second pass: each bucket is
shuffled by Fisher-Yates and written. A record's slot is its bucket's offset, from the counts of what was written, plus its
place in the bucket.

Adding a shard moves records only into the new one. A null key counts as a key of its own; null text has no bytes, and a text of
any length is one record. Records that are equal in all columns are numbered, and go to different buckets by their numbers, so
that no bucket grows with them. Nothing depends on the input's order and partitions: the same records get the same shards,
buckets and slots. Columns named like those added get out of no one's way: the added ones take a free name. An empty table
gives no records.
"""

from __future__ import annotations

import math
import uuid
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from creditmart.llm.common import delete_at_end, free_name, stored, with_arrays
from creditmart.session import shared_folder

#: Fixed bytes of a record besides its text, and buckets that a task shuffles.
RECORD, BUCKETS_OF_A_TASK = 16, 4
#: Starts of equal records in several tasks that are sent to all tasks, of 20 bytes each; more are joined by a shuffle.
SENT_UP_TO = 500_000


def size_of(text: Column) -> Column:
    return (F.coalesce(F.octet_length(text), F.lit(0)) + F.lit(RECORD)).cast("long")


def shard_of(key: Column, shards: int, seed: int = 11) -> Column:
    """The shard that wins the highest hash of (shard, key): one more shard can only win records for itself."""
    name = F.coalesce(key.cast("string"), F.lit(""))
    bids = [F.struct(F.xxhash64(F.lit(seed), F.lit(s), name, key.isNull()).alias("bid"), F.lit(s).alias("shard")) for s in range(shards)]
    return (F.greatest(*bids) if shards > 1 else bids[0])["shard"]


def names(docs: DataFrame) -> tuple[str, str, str]:
    """What the records' shard, bucket and place are called beside their own columns."""
    return free_name(docs, "shard"), free_name(docs, "bucket"), free_name(docs, "place")


def numbered(docs: DataFrame) -> DataFrame:
    """The records with `_hash`, of all columns, and `_nth`, a number from 0 among those that are equal in all of them.

    Tasks count on their own; where equal records are in several tasks, each task's numbers start after those of the ones before.
    """
    hashed = docs.withColumns({"_hash": F.xxhash64(*docs.columns), "_task": F.spark_partition_id()})
    counts = hashed.groupBy("_hash", "_task").agg(F.count("*").alias("n"))
    own = Window.partitionBy("_hash")
    before = own.orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.withColumn("start", F.coalesce(F.sum("n").over(before), F.lit(0))).filter("start > 0").select("_hash", "_task", "start")
    starts = stored(starts)
    sent = F.broadcast(starts) if starts.count() <= SENT_UP_TO else starts
    schema = T.StructType([*hashed.schema.fields, T.StructField("_nth", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()
        order = pa.schema([(f.name, pa.null()) for f in schema.fields])
        for batch in batches:
            nth = []
            for h in batch.column("_hash").to_pylist():
                nth.append(seen[h])
                seen[h] += 1
            yield with_arrays(batch, order, {"_nth": pa.array(nth, pa.int64())})

    found = hashed.mapInArrow(run, schema).join(sent, ["_hash", "_task"], "left")
    return found.withColumn("_nth", F.col("_nth") + F.coalesce("start", F.lit(0))).drop("_task", "start")


def write(docs: DataFrame, path: str, shards: int, key: str = "doc_id", text: str = "text", bucket_bytes: int = 8 << 20, seed: int = 11) -> DataFrame:
    """Write the records under `path`, in folders by shard and files by bucket; return them with shard, bucket and place (`names`)."""
    shard, bucket, place = names(docs)
    total = docs.agg(F.sum(size_of(F.col(text)))).first()[0] or 0
    buckets = max(1, math.ceil(total / shards / bucket_bytes))
    scatter = F.pmod(F.xxhash64(F.lit(seed), "_hash", "_nth"), F.lit(buckets)).cast("int")
    placed = numbered(docs).select(*docs.columns, "_hash", shard_of(F.col(key), shards, seed).alias(shard), scatter.alias(bucket))
    schema = T.StructType([*[f for f in placed.schema.fields if f.name != "_hash"], T.StructField(place, T.LongType())])

    def shuffle(group: pa.Table) -> pa.Table:
        where = [group.column(c)[0].as_py() for c in (shard, bucket)]
        # from a fixed order, which the input's has no part in
        order = pc.sort_indices(group, sort_keys=[("_hash", "ascending"), (key, "ascending"), (text, "ascending")]).to_numpy().copy()
        fisher_yates(order, np.random.default_rng([seed, *where]))
        return group.drop_columns(["_hash"]).take(pa.array(order)).append_column(place, pa.array(np.arange(len(order))))

    tasks = math.ceil(shards * buckets / BUCKETS_OF_A_TASK)
    shuffled = placed.repartition(tasks, shard, bucket).groupBy(shard, bucket).applyInArrow(shuffle, schema)
    shuffled.write.option("compression", "zstd").partitionBy(shard).parquet(path)
    return docs.sparkSession.read.schema(schema).parquet(path)


def fisher_yates(items: np.ndarray, rng: np.random.Generator) -> None:
    """Shuffle in place: from the last place down, swap with a place at or before it."""
    swaps = rng.integers(0, np.arange(1, len(items) + 1)) if len(items) else []
    for i in range(len(items) - 1, 0, -1):
        j = swaps[i]
        items[i], items[j] = items[j], items[i]


def slots(written: DataFrame, own: tuple[str, str, str] = ("shard", "bucket", "place"), slot: str = "slot") -> DataFrame:
    """The written records with `slot`, gapless from 0 in each shard: buckets one after another, each in its order."""
    shard, bucket, place = own
    counts = written.groupBy(shard, bucket).agg(F.count("*").alias("n"))
    before = Window.partitionBy(shard).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(shard, bucket, F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_offset"))
    return written.join(offsets, [shard, bucket]).withColumn(slot, F.col("_offset") + F.col(place)).drop("_offset", place)


def in_shared_folder(docs: DataFrame, shards: int, **options) -> DataFrame:
    """Records of `write` and `slots`, in a new folder of the cluster's shared one."""
    path = f"{shared_folder(docs.sparkSession)}/shards-{uuid.uuid4().hex}"
    written = write(docs, path, shards, **options)
    delete_at_end(docs.sparkSession, path)
    return slots(written, names(docs), free_name(docs, "slot"))
