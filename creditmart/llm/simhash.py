"""Near duplicates by SimHash, with links found by meet-in-the-middle ball hashing.

A fingerprint bit is set if it is set in over half the hashes of a text's features. Two fingerprints that differ in at most
two bits have a common neighbour at distance one or less from both. So each distinct fingerprint emits itself and all
variants with one flipped bit, and variants are shuffled. All fingerprints at one variant lie within two bits of each
other, so linking each of them to the smallest one there loses no link; a variant has at most bits + 1 fingerprints,
however many documents share them. Links are checked once more by their distance and joined to components.

Null text counts as empty: it has no features and fingerprint zero. Repeated rows are kept, each with its class. Texts of
any length are hashed whole, in blocks. Classes are named by the smallest non-null doc_id; rows with a null doc_id get the
class of their text too. An empty table gives no rows; columns other than the id and the text are not read by `fingerprints`,
and `keep_one` keeps all, whatever their names.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from creditmart.llm.common import free_name, stored
from creditmart.llm.components import components

SEED = 42
BLOCK = 8_192


def shingles(text: bytes, k: int) -> list[bytes]:
    """Runs of k words of a text in lower case; a shorter text is one run, a text without words has none."""
    words = text.lower().split()  # of bytes: lowers A-Z, splits at space, tab and line ends only
    if not words:
        return []
    if len(words) <= k:
        return [b" ".join(words)]
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words])
    starts = [0, *ends[:-k].tolist()]
    return [joined[a:b] for a, b in zip(starts, (ends[k - 1 :] - 1).tolist())]


def hashes(parts: list[bytes]) -> np.ndarray:
    one = xxhash.xxh64_intdigest
    return np.fromiter((one(p, SEED) for p in parts), dtype=np.uint64, count=len(parts))


def mixed(h: np.ndarray, n: int) -> np.ndarray:
    """n further 64-bit hashes of each hash, as columns."""
    z = h[:, None] + (np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))[None, :]
    z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return z ^ (z >> np.uint64(31))


def majority(h: np.ndarray) -> np.ndarray:
    """The bits set in over half the rows of a matrix of 64-bit words, as a row of words."""
    if not len(h):
        return np.zeros(h.shape[1], dtype=np.uint64)
    counts = np.zeros(h.shape[1] * 64, dtype=np.int64)
    for a in range(0, len(h), BLOCK):
        block = np.ascontiguousarray(h[a : a + BLOCK]).view(np.uint8)
        counts += np.unpackbits(block, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return np.packbits(counts * 2 > len(h), bitorder="little").view(np.uint64)


def fingerprint(text: bytes, k: int) -> int:
    return int(majority(hashes(shingles(text, k))[:, None])[0])


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", k: int = 3) -> DataFrame:
    """(`doc_id`, `fp`): the signed 64-bit fingerprint of each document's shingles of k words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fp = np.array([fingerprint(t or b"", k) for t in batch.column(1).to_pylist()], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fp.view(np.int64))], names=["doc_id", "fp"])

    schema = T.StructType([T.StructField("doc_id", docs.schema[doc_id].dataType), T.StructField("fp", T.LongType())])
    return docs.select(doc_id, F.col(text).cast("binary")).mapInArrow(run, schema)


def ball(key: Column, bits: int = 64) -> Column:
    """A fingerprint and all its variants with one of the lower bits flipped."""
    masks = [0, *(1 << i for i in range(bits))]
    signed = [m - (1 << 64) if m >= 1 << 63 else m for m in masks]
    return F.transform(F.array(*[F.lit(m).cast("long") for m in signed]), lambda m: key.bitwiseXOR(m))


def links(keys: DataFrame, key: str = "fp", distance: int = 2) -> DataFrame:
    """(`a`, `b`): links that connect all fingerprints of at most two differing bits. `keys` holds each one once."""
    variants = keys.select(F.col(key).alias("a"), F.explode(ball(F.col(key))).alias("variant"))
    near = variants.withColumn("b", F.min("a").over(Window.partitionBy("variant"))).filter("a <> b").select("a", "b").distinct()
    return near.filter(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= distance)


def classes(prints: DataFrame) -> DataFrame:
    """Documents (`doc_id`, `fp`) with `component_id`, the smallest doc_id reachable over links of fingerprints.

    Documents of one fingerprint are counted together first: components are those of distinct fingerprints.
    """
    own = stored(prints.groupBy("fp").agg(F.min("doc_id").alias("least")))
    roots = components(links(own.select("fp")))
    rooted = own.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    named = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    moved = rooted.join(named, "root").select("fp", "component_id")
    return prints.join(moved, "fp")


# Near duplicates by the similarity of five-word shingles, for the pipeline.

#: Short fingerprints of a text's distinct shingles, and the bits of each. A bit differs with a probability of half of what
#: two sets are apart, however the texts were edited: at a Jaccard similarity of 0.8 one in ten bits, so that two texts are at
#: most two bits of 32 apart in 0.367 of the tables, and in one of 12 tables in 99.6 of 100 cases; at 0.85 in 99.99.
TABLES, BITS = 12, 32
#: Words of the long fingerprint of distinct shingles, from which similarity is estimated.
LONG_WORDS = 16
#: Texts at one variant that those with this fingerprint are compared with in the first pass.
DIRECT = 256
#: Estimates this near to the asked-for similarity are checked on the shingles themselves: four standard errors.
UNSURE = 0.1
#: Most similar texts that a text is checked against in the first pass. The second pass settles what they leave apart.
NEAREST = 3
#: Tables whose variants are shuffled together.
TABLES_AT_ONCE = 4
#: Texts of one variant that a task holds in the second pass; more are dealt to blocks, and each two blocks to a task.
BLOCK_TEXTS = 2_048


def ring_bits(h: np.ndarray, tables: int, bits: int) -> np.ndarray:
    """A fingerprint of a set of hashes for each table, of one-bit minima.

    A table mixes the hashes anew and lays them on a ring with `bits` marks. Bit i is bit i of the first hash at or after mark
    i. Of two sets' first hash there, both have the same one with the probability of their Jaccard similarity.
    """
    if not len(h):
        return np.zeros(tables, dtype=np.uint64)
    rings = np.sort(np.ascontiguousarray(mixed(h, tables).T), axis=1)
    place = np.arange(bits, dtype=np.uint64)
    marks = place * np.uint64((1 << 64) // bits)
    first = np.stack([r[np.searchsorted(r, marks) % len(r)] for r in rings])
    return (((first >> place) & np.uint64(1)) << place).sum(axis=1, dtype=np.uint64)


def sketch(text: bytes, k: int, tables: int, bits: int) -> tuple[list[int], bytes]:
    """Short fingerprints of a text's distinct shingles, and a long one of them."""
    h = np.unique(hashes(shingles(text, k)))
    return ring_bits(h, tables, bits).astype(np.int64).tolist(), majority(mixed(h, LONG_WORDS)).tobytes()


def similarity(long: np.ndarray, others: np.ndarray) -> np.ndarray:
    """Estimated Jaccard similarity of sets from the differing bits of their long fingerprints."""
    share = np.bitwise_count(others ^ long[None, :]).sum(axis=1) / (LONG_WORDS * 64)
    cosine = np.cos(np.pi * share)
    return cosine / (2 - cosine)


def nearest(number: int, long: np.ndarray, ids: list[int], longs: np.ndarray, at_least: float) -> list[tuple[int, int, float]]:
    """The most similar of other texts that a text may be like: (text, other, estimate)."""
    alike = similarity(long, longs)
    best = np.argsort(-alike, kind="stable")[:NEAREST]
    return [(number, ids[j], float(alike[j])) for j in best.tolist() if alike[j] >= at_least - UNSURE]


def apart(ids: np.ndarray, keys: np.ndarray, roots: np.ndarray, longs: np.ndarray, second: np.ndarray, variant: int, at_least: float) -> list[tuple[np.ndarray, np.ndarray, bool]]:
    """All pairs of one variant's texts that may be alike and lie in different components so far: (texts, others, whether surely).

    Texts that are surely alike give one pair for each two components. `second` tells the texts of a second block, which are
    compared with those of the first one only; if there are none, all texts are compared.
    """
    roots, two = roots.copy(), bool(second.any())
    out, unsure = [], []
    for i in range(len(ids)) if not two else np.flatnonzero(~second).tolist():
        others = np.flatnonzero(second) if two else np.arange(i + 1, len(ids))
        others = others[roots[others] != roots[i]]
        differ = keys[others] ^ keys[i]
        others = others[np.where(differ == 0, variant == keys[i], variant < (variant ^ differ))]
        if not len(others):
            continue
        alike = similarity(longs[i], longs[others])
        sure = others[alike >= at_least + UNSURE]
        for root, at in zip(*np.unique(roots[sure], return_index=True)):
            out.append((ids[i : i + 1], ids[sure[at : at + 1]], True))
            roots[roots == root] = roots[i]
        near = others[(alike >= at_least - UNSURE) & (alike < at_least + UNSURE)]
        unsure.append((i, near))
    for i, near in unsure:
        near = near[roots[near] != roots[i]]
        if len(near):
            out.append((np.full(len(near), ids[i]), ids[near], False))
    return out


def similar_pairs(pairs: DataFrame, docs: DataFrame, text: str, k: int, at_least: float) -> DataFrame:
    """Those of the pairs (`a`, `b`) of texts, by hash, whose sets of k-word shingles have a Jaccard similarity of `at_least`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [np.unique(hashes(shingles(t or b"", k))).view(np.int64) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sets, pa.list_(pa.int64()))], names=["hash", "parts"])

    body = F.coalesce(F.col(text), F.lit(""))
    asked = pairs.select(F.col("a").alias("hash")).union(pairs.select("b")).distinct()
    texts = docs.select(F.xxhash64(body).alias("hash"), body.cast("binary").alias("body")).join(asked, "hash", "left_semi")
    sets = stored(texts.mapInArrow(run, "hash long, parts array<long>").groupBy("hash").agg(F.first("parts").alias("parts")))
    left, right = sets.select(F.col("hash").alias("a"), F.col("parts").alias("x")), sets.select(F.col("hash").alias("b"), F.col("parts").alias("y"))
    both = pairs.join(left, "a").join(right, "b").withColumn("common", F.size(F.array_intersect("x", "y")))
    return both.filter(F.col("common") >= at_least * (F.size("x") + F.size("y") - F.col("common"))).select("a", "b")


def similar_groups(docs: DataFrame, text: str = "text", k: int = 5, at_least: float = 0.8) -> DataFrame:
    """(`hash`, `root`) for every distinct text (by its 64-bit hash) that is like another one; root: the group's smallest.

    Texts are alike if the Jaccard similarity of their sets of k-word shingles is at least `at_least`. Candidates are texts
    with a short fingerprint at most two bits apart; SimHash over 1,024 bits estimates their similarity, and estimates
    near the threshold are settled on the shingles. A first pass links each text to the nearest of those that it meets at its
    own fingerprints; a second one settles all candidates that the links of the first leave in different components.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [sketch(t or b"", k, TABLES, BITS) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([r[0] for r in rows], pa.list_(pa.int64())), pa.array([r[1] for r in rows], pa.binary())], names=["hash", "short", "long"])

    body = F.coalesce(F.col(text), F.lit(""))
    sketches = docs.select(F.xxhash64(body).alias("hash"), body.cast("binary").alias("body")).mapInArrow(run, "hash long, short array<long>, long binary")
    sketches = stored(sketches.groupBy("hash").agg(F.first("short").alias("short"), F.first("long").alias("long"), F.count("*").alias("copies")))
    # A table's number goes above its fingerprint's bits.
    keys = F.transform("short", lambda s, i: s.bitwiseOR(F.shiftleft(i.cast("long"), BITS)))
    tables = []
    for t in range(0, TABLES, TABLES_AT_ONCE):  # each table's variants are its own, so tables can go one after the other
        some = sketches.select("hash", F.explode(F.slice(keys, t + 1, TABLES_AT_ONCE)).alias("key"))
        flipped = some.select("hash", F.posexplode(ball(F.col("key"), BITS)).alias("bit", "variant"))
        shared = flipped.withColumn("n", F.count("*").over(Window.partitionBy("variant"))).filter("n > 1")
        key = F.when(F.col("bit") == 0, F.col("variant")).otherwise(F.col("variant").bitwiseXOR(F.call_function("shiftleft", F.lit(1).cast("long"), F.col("bit") - 1)))
        tables.append(stored(shared.select("hash", key.alias("key"), "variant")))
    met = reduce(DataFrame.union, tables)
    rows = met.join(sketches.select("hash", "long", "copies"), "hash")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, ids, longs = None, [], np.empty((DIRECT, LONG_WORDS), dtype=np.uint64)
        for batch in batches:
            variants, hashes_, keys = (batch.column(n).to_pylist() for n in ("variant", "hash", "key"))
            words = np.frombuffer(b"".join(batch.column("long").to_pylist()), dtype=np.uint64).reshape(-1, LONG_WORDS)
            pairs = []
            for n, v in enumerate(variants):
                if v != at:
                    at, ids = v, []
                if ids and v == keys[n]:  # a text asks at its own fingerprints only, but is met at their variants too
                    pairs += nearest(hashes_[n], words[n], ids, longs[: len(ids)], at_least)
                if len(ids) < DIRECT:
                    longs[len(ids)] = words[n]
                    ids.append(hashes_[n])
            columns = list(zip(*pairs)) or [[]] * 3
            yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.float64()))], names=["a", "b", "alike"])

    ordered = rows.repartition("variant").sortWithinPartitions("variant", F.desc("copies"), "hash").select("variant", "hash", "key", "long")
    found = ordered.mapInArrow(compare, "a long, b long, alike double").groupBy("a", "b").agg(F.max("alike").alias("alike"))
    few = found.withColumn("place", F.row_number().over(Window.partitionBy("a").orderBy(F.desc("alike"), "b"))).filter(F.col("place") <= NEAREST)
    pairs = few.groupBy(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).agg((F.max("alike") >= at_least + UNSURE).alias("sure"))
    pairs = stored(pairs)
    checked = similar_pairs(pairs.filter(~F.col("sure")).select("a", "b"), docs, text, k, at_least)
    roots = stored(components(pairs.filter("sure").select("a", "b").union(checked)))

    def compare_rest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, at = [], None
        for batch in itertools.chain(batches, [None]):
            rows = [] if batch is None else list(zip(*(batch.column(n).to_pylist() for n in ("variant", "low", "high", "block", "hash", "key", "root", "long"))))
            for row in itertools.chain(rows, [None] if batch is None else []):
                if held and (row is None or row[:3] != at):
                    blocks, ids, keys, own, longs = zip(*(r[3:] for r in held))
                    second = np.array(blocks) != at[1]
                    if at[1] == at[2] or (second.any() and not second.all()):
                        numbers = [np.array(x, dtype=np.int64) for x in (ids, keys, own)]
                        words = np.frombuffer(b"".join(longs), dtype=np.uint64).reshape(-1, LONG_WORDS)
                        for a, b, sure in apart(*numbers, words, second, at[0], at_least):
                            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b), pa.array([sure] * len(a))], names=["a", "b", "sure"])
                    held = []
                if row is not None:
                    held.append(row)
                    at = row[:3]

    everyone = Window.partitionBy("variant")
    labelled = met.join(roots.withColumnRenamed("node", "hash"), "hash", "left").withColumn("root", F.coalesce("root", "hash"))
    still = labelled.withColumns({"least": F.min("root").over(everyone), "most": F.max("root").over(everyone), "n": F.count("*").over(everyone)}).filter("least <> most")
    still = still.withColumn("blocks", F.ceil(F.col("n") / BLOCK_TEXTS)).withColumn("block", F.pmod(F.xxhash64("hash"), F.col("blocks")))
    dealt = still.withColumn("with", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    dealt = dealt.select("variant", F.least("block", "with").alias("low"), F.greatest("block", "with").alias("high"), "block", "hash", "key", "root")
    cell = ["variant", "low", "high"]
    dealt = dealt.join(sketches.select("hash", "long"), "hash").repartition(*cell).sortWithinPartitions(*cell, "hash")
    left = dealt.mapInArrow(compare_rest, "a long, b long, sure boolean").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), "sure")
    left = stored(left.groupBy("a", "b").agg(F.max("sure").alias("sure")).join(pairs.select("a", "b"), ["a", "b"], "left_anti"))
    settled = similar_pairs(left.filter(~F.col("sure")).select("a", "b"), docs, text, k, at_least)
    stars = roots.filter("node <> root").select(F.col("node").alias("a"), F.col("root").alias("b"))
    return components(stars.union(left.filter("sure").select("a", "b")).union(settled)).withColumnRenamed("node", "hash")


def keep_one(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", k: int = 5, at_least: float = 0.8) -> DataFrame:
    """The documents without near duplicates: of each group of similar texts the row with the smallest doc_id stays.

    A null doc_id comes last, then the text's hash decides; of rows that are alike in both, one stays. Texts without
    words are one group.
    """
    key, group, place = free_name(docs, "text_hash"), free_name(docs, "text_group"), free_name(docs, "place")
    hashed = docs.withColumn(key, F.xxhash64(F.coalesce(F.col(text), F.lit(""))))
    roots = similar_groups(docs, text, k, at_least).select(F.col("hash").alias(key), F.col("root").alias(group))
    # the row to stay is found without the texts, first by each text's smallest id
    least = hashed.groupBy(key).agg(F.min(F.struct(F.col(doc_id).isNull().alias("none"), F.col(doc_id).alias("id"))).alias("first"))
    best = least.join(roots, key, "left").withColumn(group, F.coalesce(group, key))
    stay = best.groupBy(group).agg(F.min(F.struct("first", F.col(key).alias("key"))).alias("best"))
    stay = stay.select(F.col("best.key").alias(place), F.col("best.first.id").alias(group))
    rows = hashed.join(stay, (F.col(key) == F.col(place)) & F.col(doc_id).eqNullSafe(F.col(group)))
    once = Window.partitionBy(key, doc_id).orderBy(F.lit(0))
    return rows.withColumn(place, F.row_number().over(once)).filter(F.col(place) == 1).select(*docs.columns)
