"""Near duplicates by MinHash and an LSH forest, with links confirmed on the full sets.

A document's set is that of its distinct five-word shingles (by 64-bit hash); a shorter text is one shingle. From each set 128
minima are taken, eight for each of 16 trees. A tree is an order: sets are sorted by its minima (the first seven), so that sets
with a long common prefix stand next to each other. Sets that share the first three minima form a region.

1. Neighbours in an order, the sets of the longest common prefix, are candidates. Where sets are dense, neighbours share deep
   prefixes, where they are sparse, shallow ones: the depth adapts to the region. Candidates that the minima do not rule out
   are confirmed on the sets, and links give first components.
2. What is left are regions in which sets of different components stand. Every two such sets of a region are compared by
   their minima, in blocks of bounded size, each pair in the first tree only that it shares a region of. Sets with a possible
   partner are then confirmed: the shingles of a block of sets against those of another, by products of small matrices. Each
   two blocks give a spanning forest of their links, not all pairs. No group, region or number of partners has a limit.

Two sets of a similarity of 0.85 share a region in one of the trees in all but 2 of 10 million cases, and the estimate from
128 minima, with a standard error of 0.03, is 0.15 below their similarity in fewer than one of 100,000. So links get lost by
chance only that rarely, and none is kept that the full sets do not confirm.

Documents of one set are one node, however many they are. Null and blank texts have an empty set and are linked to nothing.
Texts of any length are hashed whole. Components are named by their smallest doc_id; a null doc_id names a component only if
it has no other, and rows without one in the empty set stand alone. Repeated rows are kept, each with its component. Columns
other than the id and the text are not read, so no name can clash. An empty table gives no rows.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from creditmart.llm.common import pieces, segment_ids, stored
from creditmart.llm.components import components
from creditmart.llm.simhash import hashes, shingles

#: Trees, minima of each, and those that name a region.
TREES, DEPTH, SHALLOW = 16, 8, 3
#: Estimates that are further than this below the asked-for similarity rule a pair out: almost five standard errors.
MARGIN = 0.15
#: Sets of a region that a task compares with those of another block, their shingles, and those of a matrix.
BLOCK_SETS, BLOCK_WEIGHT, BLOCK_SHINGLES = 1_024, 1 << 22, 1 << 14
#: Shingles whose minima are taken at once.
SLICE = 1_024
#: Asked-for sets that are sent to the texts, of 16 bytes each; more are joined to them by a shuffle, with the same result.
SENT_UP_TO = 2_000_000

_RANDOM = np.random.default_rng(11).integers(0, 1 << 63, (2, TREES * DEPTH), dtype=np.uint64)
_XOR, _ODD = _RANDOM[0] << np.uint64(1), _RANDOM[1] | np.uint64(1)


def minima(h: np.ndarray) -> np.ndarray:
    """The upper 16 bits of the least of each of 128 permutations of a set of hashes, eight after the other for each tree."""
    least = np.full(TREES * DEPTH, np.iinfo(np.uint64).max)
    for a in range(0, len(h), SLICE):
        part = (h[a : a + SLICE, None] ^ _XOR) * _ODD
        np.minimum(least, part.min(axis=0), out=least)
    # the least of many values has few bits left at the top, so it is mixed again before it is cut
    least = (least ^ (least >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return (least >> np.uint64(48)).astype(np.uint16)


def _packed(columns: np.ndarray) -> np.ndarray:
    """Up to four 16-bit numbers of each row as one 64-bit number, the first one on top."""
    out = np.zeros(columns.shape[:-1], dtype=np.uint64)
    for i in range(columns.shape[-1]):
        out = (out << np.uint64(16)) | columns[..., i].astype(np.uint64)
    return out


def signatures(docs: DataFrame, doc_id: str, text: str, k: int) -> DataFrame:
    """(`doc_id`, `body`, `node`, `size`, `sig`): the hashes of each text and its set, the set's size and minima; null for an empty set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nodes, sizes, sigs = [], [], []
            for t in batch.column(1).to_pylist():
                h = np.unique(hashes(shingles(t or b"", k)))
                nodes.append(xxhash.xxh64_intdigest(h.tobytes()) - (1 << 63) if len(h) else None)
                sizes.append(len(h))
                sigs.append(minima(h).tobytes() if len(h) else None)
            arrays = [batch.column(0), batch.column(2), pa.array(nodes, pa.int64()), pa.array(sizes, pa.int64()), pa.array(sigs, pa.binary())]
            yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "body", "node", "size", "sig"])

    schema = T.StructType([T.StructField("doc_id", docs.schema[doc_id].dataType), *[T.StructField(n, T.LongType()) for n in ("body", "node", "size")], T.StructField("sig", T.BinaryType())])
    return docs.select(doc_id, F.col(text).cast("binary"), F.xxhash64(text)).mapInArrow(run, schema)


def orders(nodes: DataFrame) -> DataFrame:
    """(`region`, `rest`, `node`) for every tree: the tree and the first minima as one number, and the next ones."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sig = np.frombuffer(b"".join(batch.column("sig").to_pylist()), dtype=np.uint16).reshape(-1, TREES, DEPTH)
            tree = np.arange(TREES, dtype=np.uint64) << np.uint64(48)
            region = _packed(sig[:, :, :SHALLOW]) | tree
            rest = _packed(sig[:, :, SHALLOW : SHALLOW + 4])
            node = np.repeat(batch.column("node").to_numpy(), TREES)
            yield pa.RecordBatch.from_arrays([pa.array(x.reshape(-1).view(np.int64)) for x in (region, rest, node)], names=["region", "rest", "node"])

    return nodes.select("node", "sig").mapInArrow(run, "region long, rest long, node long")


def neighbours(met: DataFrame) -> DataFrame:
    """(`a`, `b`): sets that stand next to each other in an order and share a region. The orders are cut by ranges."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        region, node = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
        for batch in batches:
            region = np.concatenate([region[-1:], batch.column(0).to_numpy()])
            node = np.concatenate([node[-1:], batch.column(1).to_numpy()])
            at = np.flatnonzero(region[1:] == region[:-1])
            low, high = np.minimum(node[at], node[at + 1]), np.maximum(node[at], node[at + 1])
            yield pa.RecordBatch.from_arrays([pa.array(low), pa.array(high)], names=["a", "b"])

    order = "region", "rest", "node"
    return met.repartitionByRange(*order).sortWithinPartitions(*order).select("region", "node").mapInArrow(run, "a long, b long").distinct()


def likely(pairs: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """Those of the pairs whose sizes and minima do not rule a link out."""
    cut = percent / 100 - MARGIN

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, y = (np.frombuffer(b"".join(batch.column(n).to_pylist()), dtype=np.uint16).reshape(-1, TREES * DEPTH) for n in ("x", "y"))
            keep = (x == y).mean(axis=1) >= cut
            yield pa.RecordBatch.from_arrays([batch.column(n).filter(pa.array(keep)) for n in ("a", "b")], names=["a", "b"])

    left = nodes.select(F.col("node").alias("a"), F.col("size").alias("m"), F.col("sig").alias("x"))
    right = nodes.select(F.col("node").alias("b"), F.col("size").alias("n"), F.col("sig").alias("y"))
    fits = F.least("m", "n") * 100 >= F.greatest("m", "n") * percent
    return pairs.join(left, "a").join(right, "b").filter(fits).select("a", "b", "x", "y").mapInArrow(run, "a long, b long")


def sets_of(asked: DataFrame, docs: DataFrame, text: str, k: int) -> DataFrame:
    """(`node`, `parts`): the sorted shingle hashes of the asked-for sets (`node`, `body`), taken from a text that has them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [np.unique(hashes(shingles(t, k))).tobytes() for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sets, pa.binary())], names=["node", "parts"])

    texts = docs.select(F.xxhash64(text).alias("body"), F.col(text).cast("binary").alias("text"))
    sent = F.broadcast(asked) if asked.count() <= SENT_UP_TO else asked
    found = texts.join(sent, "body").groupBy("node").agg(F.first("text").alias("text"))
    return found.mapInArrow(run, "node long, parts binary")


def linked(x: bytes, y: bytes, percent: int) -> bool:
    a, b = np.frombuffer(x, dtype=np.uint64), np.frombuffer(y, dtype=np.uint64)
    common = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * common >= percent * (len(a) + len(b) - common)


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Those of the pairs whose full sets are linked."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = [linked(x, y, percent) for x, y in zip(batch.column("x").to_pylist(), batch.column("y").to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column(n).filter(pa.array(keep, pa.bool_())) for n in ("a", "b")], names=["a", "b"])

    left, right = sets.select(F.col("node").alias("a"), F.col("parts").alias("x")), sets.select(F.col("node").alias("b"), F.col("parts").alias("y"))
    return pairs.join(left, "a").join(right, "b").select("a", "b", "x", "y").mapInArrow(run, "a long, b long")


def common_counts(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """How many elements each set on the left has in common with each one on the right, by products of 0/1 matrices."""
    rows_l, rows_r = segment_ids([len(s) for s in left]), segment_ids([len(s) for s in right])
    flat_l, flat_r = np.concatenate(left), np.concatenate(right)
    both = np.intersect1d(flat_l, flat_r)
    out = np.zeros((len(left), len(right)), dtype=np.float64)
    at_l, at_r = np.searchsorted(both, flat_l), np.searchsorted(both, flat_r)
    in_l, in_r = (both[np.minimum(at, len(both) - 1)] == flat if len(both) else np.zeros(len(flat), dtype=bool) for at, flat in ((at_l, flat_l), (at_r, flat_r)))
    at_l, rows_l, at_r, rows_r = at_l[in_l], rows_l[in_l], at_r[in_r], rows_r[in_r]
    for a in range(0, len(both), BLOCK_SHINGLES):
        width = min(BLOCK_SHINGLES, len(both) - a)
        x, y = np.zeros((len(left), width), dtype=np.float32), np.zeros((len(right), width), dtype=np.float32)
        own_l, own_r = (at_l >= a) & (at_l < a + width), (at_r >= a) & (at_r < a + width)
        x[rows_l[own_l], at_l[own_l] - a] = 1
        y[rows_r[own_r], at_r[own_r] - a] = 1
        out += x @ y.T
    return out


def spanning(ids: np.ndarray, roots: np.ndarray, links: Iterator[tuple[int, int]]) -> list[tuple[int, int]]:
    """Of links between places, those that join what the roots and earlier links leave apart."""
    parent = {r: r for r in roots.tolist()}

    def top(r: int) -> int:
        while parent[r] != r:
            parent[r] = parent[parent[r]]
            r = parent[r]
        return r

    out = []
    for i, j in links:
        a, b = top(int(roots[i])), top(int(roots[j]))
        if a != b:
            parent[a] = b
            out.append((int(ids[i]), int(ids[j])))
    return out


def _cells(batches: Iterator[pa.RecordBatch], names: tuple[str, ...]) -> Iterator[tuple]:
    """Rows sorted by (region, low, high), gathered by cell: the cell and a list for each of the other columns."""
    held: list[list] = [[] for _ in names]
    at = None
    for batch in batches:
        keys = list(zip(*(batch.column(n).to_pylist() for n in ("region", "low", "high"))))
        columns = [batch.column(n).to_pylist() for n in names]
        start = 0
        for key, group in itertools.groupby(keys):
            n = len(list(group))
            if key != at:
                if at is not None:
                    yield at, held
                held, at = [[] for _ in names], key
            for column, values in zip(held, columns):
                column += values[start : start + n]
            start += n
    if at is not None:
        yield at, held


def dealt(met: DataFrame, info: DataFrame) -> DataFrame:
    """(`region`, `low`, `high`, `node`, `root`, `second`): the sets of regions with more than one component, by cell.

    A cell is two blocks of a region, or one block with itself; `second` marks the sets of the second block. A component that
    fills blocks of its own is not dealt with itself, so a region that is nearly all one component has few cells.
    """
    labelled = met.join(info.select("node", "root", "size"), "node")
    own = labelled.groupBy("region", "root").agg(F.count("*").alias("n"), F.sum("size").alias("weight"))
    own = own.withColumn("blocks", F.ceil(F.greatest(F.col("n") / BLOCK_SETS, F.col("weight") / BLOCK_WEIGHT)))
    own = own.withColumn("big", F.when(F.col("blocks") > 1, F.col("root")))
    parts = own.groupBy("region", "big").agg(F.count("*").alias("roots"), F.sum("n").alias("n"), F.sum("weight").alias("weight"))
    parts = parts.withColumn("blocks", F.ceil(F.greatest(F.col("n") / BLOCK_SETS, F.col("weight") / BLOCK_WEIGHT)))
    everyone = Window.partitionBy("region")
    before = everyone.orderBy(F.col("big").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.withColumns({"start": F.coalesce(F.sum("blocks").over(before), F.lit(0)), "total": F.sum("blocks").over(everyone), "all": F.sum("roots").over(everyone)})
    parts = parts.filter(F.col("all") > 1).select("region", "big", "start", "blocks", "total")
    kinds = stored(own.select("region", "root", "big").join(parts.withColumnRenamed("big", "b").withColumnRenamed("region", "r"), (F.col("region") == F.col("r")) & F.col("big").eqNullSafe(F.col("b"))))
    rows = labelled.join(kinds.drop("r", "b"), ["region", "root"])
    rows = rows.withColumn("block", F.col("start") + F.pmod(F.xxhash64("node"), F.col("blocks")))
    others = F.filter(F.sequence(F.lit(0).cast("long"), F.col("total") - 1), lambda x: F.col("big").isNull() | (x < F.col("start")) | (x >= F.col("start") + F.col("blocks")))
    rows = rows.withColumn("with", F.explode(others))
    low, high = F.least("block", "with"), F.greatest("block", "with")
    return rows.select("region", low.alias("low"), high.alias("high"), "node", "root", ((low != high) & (F.col("block") == high)).alias("second"))


def unsettled(cells: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """Those of the sets in cells that have a possible partner of another component there."""
    cut = percent / 100 - MARGIN

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (region, low, high), (node, root, second, size, sig) in _cells(batches, ("node", "root", "second", "size", "sig")):
            node, root, size = (np.array(x, dtype=np.int64) for x in (node, root, size))
            second = np.array(second, dtype=bool)
            sig = np.frombuffer(b"".join(sig), dtype=np.uint16).reshape(-1, TREES * DEPTH)
            tops = _packed(sig.reshape(-1, TREES, DEPTH)[:, : region >> 48, :SHALLOW])
            ask = np.zeros(len(node), dtype=bool)
            for i in np.flatnonzero(~second).tolist():
                others = np.flatnonzero(second) if low != high else np.arange(i + 1, len(node))
                others = others[root[others] != root[i]]
                small, large = np.minimum(size[others], size[i]), np.maximum(size[others], size[i])
                others = others[small * 100 >= large * percent]
                others = others[~(tops[others] == tops[i]).any(axis=1)]  # they have met in an earlier tree
                others = others[(sig[others] == sig[i]).mean(axis=1) >= cut]
                if len(others):
                    ask[i] = True
                    ask[others] = True
            n = int(ask.sum())
            same = [pa.array(np.full(n, v, dtype=np.int64)) for v in (region, low, high)]
            yield pa.RecordBatch.from_arrays([*same, pa.array(node[ask]), pa.array(root[ask]), pa.array(second[ask])], names=["region", "low", "high", "node", "root", "second"])

    cell = ["region", "low", "high"]
    rows = cells.join(nodes, "node").repartition(*cell).sortWithinPartitions(*cell, "node")
    return rows.mapInArrow(run, "region long, low long, high long, node long, root long, second boolean")


def settled(asked: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(`a`, `b`): of each cell, a spanning forest of the links between its sets, confirmed on the sets."""

    def found(sets: list[np.ndarray], root: np.ndarray, first: list[int], others: list[int]) -> Iterator[tuple[int, int]]:
        size = np.array([len(s) for s in sets])
        for a, b in pieces(first, lambda i: len(sets[i]), 1 << 20):
            for c, d in pieces(others, lambda i: len(sets[i]), 1 << 20):
                rows, columns = np.array(first[a:b]), np.array(others[c:d])
                common = common_counts([sets[i] for i in rows], [sets[i] for i in columns])
                alike = 100 * common >= percent * (size[rows][:, None] + size[columns][None, :] - common)
                x, y = np.nonzero(alike & (root[rows][:, None] != root[columns][None, :]))
                yield from zip(rows[x].tolist(), columns[y].tolist())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (_, low, high), (node, root, second, parts) in _cells(batches, ("node", "root", "second", "parts")):
            sets = [np.frombuffer(p, dtype=np.uint64) for p in parts]
            first = [i for i, s in enumerate(second) if not s]
            others = first if low == high else [i for i, s in enumerate(second) if s]
            node, root = np.array(node, dtype=np.int64), np.array(root, dtype=np.int64)
            edges = spanning(node, root, found(sets, root, first, others))
            yield pa.RecordBatch.from_arrays([pa.array([e[k] for e in edges], pa.int64()) for k in (0, 1)], names=["a", "b"])

    cell = ["region", "low", "high"]
    rows = asked.join(sets, "node").repartition(*cell).sortWithinPartitions(*cell, "node")
    return rows.mapInArrow(run, "a long, b long")


def near_duplicates(docs: DataFrame, percent: int = 85, doc_id: str = "doc_id", text: str = "text", k: int = 5) -> DataFrame:
    """(`doc_id`, `n_shingles`, `component_id`, `kept`) of each document; `kept` holds for the document that names its component.

    Documents are linked if 100 times the size of their sets' intersection is at least `percent` times that of their union.
    """
    own = stored(signatures(docs, doc_id, text, k))
    known = own.filter(F.col("node").isNotNull())
    nodes = known.groupBy("node").agg(F.first("size").alias("size"), F.first("sig").alias("sig"), F.min("doc_id").alias("least"), F.min("body").alias("body"))
    nodes = stored(nodes)
    minimal = nodes.select("node", "size", "sig")
    rows = orders(nodes)
    shared = rows.groupBy("region").agg(F.count("*").alias("n")).filter("n > 1").select("region")
    met = stored(rows.join(shared, "region"))
    # neighbours in the orders
    pairs = stored(likely(neighbours(met), minimal, percent))
    asked = stored(pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct().join(nodes.select("node", "body"), "node"))
    sets = stored(sets_of(asked, docs, text, k))
    roots = stored(components(confirmed(pairs, sets, percent)))
    # what they leave apart
    info = stored(nodes.select("node", "size", "least").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node")))
    left = stored(unsettled(dealt(met, info), minimal, percent))
    more = stored(left.select("node").distinct().join(asked, "node", "left_anti").join(nodes.select("node", "body"), "node"))
    if not more.isEmpty():
        sets = sets.union(stored(sets_of(more, docs, text, k)))
    edges = stored(settled(left, sets, percent))
    if not edges.isEmpty():
        stars = roots.filter("node <> root").select(F.col("node").alias("a"), F.col("root").alias("b"))
        roots = components(stars.union(edges))
        info = stored(info.drop("root").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node")))
    names = info.groupBy("root").agg(F.min("least").alias("component_id"))
    named = info.select("node", "root").join(names, "root").select("node", "component_id")
    out = own.join(named, "node", "left")
    component = F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return out.select("doc_id", F.col("size").alias("n_shingles"), component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept"))
