"""Connected components of a graph given as edges, by hooking and shortening of stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from creditmart.llm.common import discard, stored_at

#: Copies of the few labels that many nodes share, so that no single task gets all their nodes.
SALTS = 16


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(`node`, `root`) for every node of an edge: the smallest node that it can reach. Nodes are numbers.

    Every round takes each node's smallest neighbouring label, hooks a label to the smallest one that any node under it has
    met, and then takes the label of that label. So whole stars are joined in a round, not only their rims, and long paths
    take few rounds. Sums of a round are counted before they are shuffled; labels that many nodes share are looked up salted.
    Each round is written to the shared folder, and the one before deleted. Labels only get smaller, so rounds end, and no
    number of them is set.
    """
    spark = edges.sparkSession
    both = edges.select(F.col(a).alias("u"), F.col(b).alias("v")).filter("u <> v")
    both, links = stored_at(both.union(both.select(F.col("v").alias("u"), F.col("u").alias("v"))).distinct())
    label = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("root")).select(F.col("u").alias("node"), "root")
    label, last = stored_at(label)
    while True:
        # the smallest label among a node and its neighbours
        near = both.join(label.select(F.col("node").alias("v"), "root"), "v").select(F.col("u").alias("node"), "root", F.lit(None).cast("long").alias("own"))
        own = label.select("node", "root", F.col("root").alias("own"))
        low, met = stored_at(near.union(own).groupBy("node").agg(F.min("root").alias("root"), F.max("own").alias("own")))
        # labels that have got a smaller label, as nodes themselves or through a node under them
        hooked = low.filter("root < own").select(F.col("own").alias("root"), F.col("root").alias("further"))
        newer = hooked.union(low.filter("root < node").select(F.col("node").alias("root"), F.col("root").alias("further")))
        newer = newer.groupBy("root").agg(F.min("further").alias("further"))
        used = low.select("root").distinct().join(newer, "root")
        spread = used.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        salted = low.withColumn("salt", F.pmod(F.xxhash64("node"), F.lit(SALTS)).cast("int"))
        jumped = salted.join(spread, ["root", "salt"], "left").select("node", F.coalesce("further", "root").alias("root"), "own")
        new, now = stored_at(jumped)
        label = new.select("node", "root")
        discard(spark, met, last)
        last = now
        if new.filter("root < own").isEmpty():
            discard(spark, links)
            return label
