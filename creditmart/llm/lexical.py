"""Ranked lexical search of many queries at once, with what they have in common evaluated once.

Items (the queries) and documents are sets of terms. A document's score for an item is a sum over the item's terms, so items
that share terms share part of their sums. These common subexpressions are mined first: again and again the pairs of terms
that most items have in common become one new term, a node whose value is the sum of the two, until no two nodes are left that
two items share. The nodes form a graph without cycles: an item is a short list of nodes, nodes are shared by items and by
other nodes. Documents are then taken in blocks: an accumulator for each term of a block's documents, one for each node (a
sum of two, whole levels of the graph at a time), and the items' scores are sums of their nodes' accumulators. The best of
each block are merged in the task, then over all tasks.

Terms are maximal runs of ASCII letters, digits and other characters beyond ASCII; A-Z are lower-cased. Weights come from all
documents: how many there are with a term, how many terms they have, and how many hold each term of an item. Items come in
blocks of bounded size, so that neither a plan nor its accumulators grow with the number of items.

Null and empty texts have no terms: such documents are in no result and not counted, such items have no results. Texts of any
length are read whole. Equal scores go to the smaller doc_id, a null one last; repeated documents count each and may take a
rank each. Repeated items of one id and text give one result; items of one id and different texts are ranked apart. Other
columns are not read, so no name can clash. An empty table gives no rows.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Items that are evaluated together, and documents of a block of accumulators.
ITEMS, DOCS = 1_000, 256
#: Groups that an item's best of all tasks are merged in before the last merge.
SALTS = 16
# Fixed values of the score.
SCALE, SHARE, WIDTH = 1_000, 90, 1_000_000_000

_TABLE = bytes(
    c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256)
)


def terms(text: bytes | None) -> list[bytes]:
    return text.translate(_TABLE).split() if text else []


class Plan:
    """How a block of items is evaluated: `words` by number, levels of pair sums, and each item's list of nodes.

    Nodes are numbered after the words: level by level, each the sum of two earlier ones.
    """

    def __init__(self, items: list[set[bytes]]) -> None:
        self.words = sorted(set().union(*items))
        number = {w: i for i, w in enumerate(self.words)}
        lists = [{number[w] for w in item} for item in items]
        self.pairs: list[np.ndarray] = []
        self.size = len(self.words)
        while len(level := _shared_pairs(lists)):
            for i, (a, b) in enumerate(level):
                for have in lists:
                    if a in have and b in have:
                        have -= {a, b}
                        have.add(self.size + i)
            self.pairs.append(np.array(level, dtype=np.int64))
            self.size += len(level)
        self.refs = np.array([n for have in lists for n in sorted(have)], dtype=np.int64)
        self.starts = np.cumsum([0, *map(len, lists)])

    def scores(self, values: np.ndarray) -> np.ndarray:
        """Scores of all items (rows) for a block of documents (columns) from the values of the words; exact integers."""
        acc = np.empty((self.size, values.shape[1]), dtype=np.int64)
        acc[: len(values)] = values
        at = len(values)
        for level in self.pairs:
            np.add(acc[level[:, 0]], acc[level[:, 1]], out=acc[at : at + len(level)])
            at += len(level)
        out = np.zeros((len(self.starts) - 1, values.shape[1]), dtype=np.int64)
        some = np.flatnonzero(np.diff(self.starts))
        if len(some):
            out[some] = np.add.reduceat(acc[self.refs], self.starts[:-1][some], axis=0)
        return out


def _shared_pairs(lists: list[set[int]]) -> list[tuple[int, int]]:
    """Pairs of nodes that two or more items hold both, those of the most items first; no node is in two of the pairs.

    Items' own nodes are counted; a pair's items are found from those of its rarer node.
    """
    holders: dict[int, list[int]] = {}
    for i, have in enumerate(lists):
        for n in have:
            holders.setdefault(n, []).append(i)
    shared = {n: h for n, h in holders.items() if len(h) > 1}
    best = []
    for n, held in shared.items():
        met = Counter(m for i in held for m in lists[i] if m in shared and (len(shared[m]), m) > (len(held), n))
        if met:
            most = max(met.values())
            if most > 1:
                best.append((-most, n, min(m for m, c in met.items() if c == most)))
    used: set[int] = set()
    out = []
    for _, a, b in sorted(best):
        if a not in used and b not in used:
            used |= {a, b}
            out.append((a, b))
    return out


def statistics(docs: DataFrame, words: list[bytes]) -> tuple[int, int, dict[bytes, int]]:
    """Documents with a term, terms of all documents, and the documents that hold each of the words. Tasks give one sum each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted, n, total = dict.fromkeys(words, 0), 0, 0
        for batch in batches:
            for text in batch.column(0).to_pylist():
                found = terms(text)
                n, total = n + bool(found), total + len(found)
                for t in set(found) & wanted.keys():
                    wanted[t] += 1
        held = [(t, c) for t, c in wanted.items() if c] + [(None, n), (b"", total)]
        yield pa.RecordBatch.from_arrays([pa.array([t for t, _ in held], pa.binary()), pa.array([c for _, c in held], pa.int64())], names=["term", "n"])

    sums = docs.mapInArrow(run, "term binary, n long").groupBy("term").agg(F.sum("n").alias("n")).collect()
    by = {None if r.term is None else bytes(r.term): r.n for r in sums}
    return by.pop(None, 0), by.pop(b"", 0), by


def weight(n: int, df: int) -> int:
    return math.floor(SCALE * math.log((2 * n + 2) / (2 * df + 1)))


class Best:
    """The k best documents of each item so far; candidates are gathered and merged when there are many."""

    def __init__(self, items: int, k: int) -> None:
        self.k, self.least = k, np.zeros(items, dtype=np.int64)
        self.held = [np.zeros(0, dtype=np.int64) for _ in range(4)]  # item, score, without an id, id
        self.new: list[tuple[np.ndarray, ...]] = []
        self.n = 0

    def add(self, scores: np.ndarray, ids: np.ndarray, without: np.ndarray) -> None:
        item, doc = np.nonzero((scores > 0) & (scores >= self.least[:, None]))
        self.new.append((item, scores[item, doc], without[doc], ids[doc]))
        self.n += len(item)
        if self.n > 4 * self.k * len(self.least):
            self.merge()

    def merge(self) -> None:
        item, score, without, ids = (np.concatenate(x) for x in zip(self.held, *self.new))
        order = np.lexsort((ids, without, -score, item))
        item = item[order]
        first = np.searchsorted(item, item)  # where the item's own candidates start
        keep = order[np.arange(len(item)) - first < self.k]
        self.held = [x[keep] for x in ((np.concatenate(x) for x in zip(self.held, *self.new)))] if len(keep) else self.held
        self.new, self.n = [], 0
        count = np.bincount(self.held[0], minlength=len(self.least))
        full = np.flatnonzero(count >= self.k)
        ends = np.searchsorted(self.held[0], full, side="right") - 1
        self.least[full] = self.held[1][ends]


def _block(docs: DataFrame, items: list[tuple[int | None, bytes]], k: int) -> DataFrame:
    """(`item`, `doc_id`, `score`): the best documents of each task for one block of items; `item` is its place in the block."""
    plan = Plan([set(terms(text)) for _, text in items])
    n, total, df = statistics(docs.select("text"), plan.words)
    weights = np.array([weight(n, df.get(w, 0)) for w in plan.words], dtype=np.int64)
    shared = docs.sparkSession.sparkContext.broadcast((plan, weights))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        plan, weights = shared.value
        number = {w: i for i, w in enumerate(plan.words)}
        best = Best(len(items), k)
        for batch in batches:
            ids = batch.column(0).fill_null(0).to_numpy(zero_copy_only=False)
            without = batch.column(0).is_null().to_numpy(zero_copy_only=False).astype(np.int64)
            texts = batch.column(1)
            for a in range(0, len(texts), DOCS):
                part = texts.slice(a, DOCS).to_pylist()
                at_word, at_doc, tf, sizes = [], [], [], np.zeros(len(part), dtype=np.int64)
                for d, text in enumerate(part):
                    found = Counter(terms(text))
                    sizes[d] = found.total()
                    here = found.keys() & number.keys()
                    at_word += [number[t] for t in here]
                    tf += [found[t] for t in here]
                    at_doc += [d] * len(here)
                values = np.zeros((len(plan.words), len(part)), dtype=np.int64)
                if tf:
                    at_word, at_doc, tf = (np.array(x, dtype=np.int64) for x in (at_word, at_doc, tf))
                    m = 100 - SHARE + (SHARE * sizes[at_doc] * n) // total
                    values[at_word, at_doc] = weights[at_word] * ((WIDTH * tf) // (1000 * tf + 8 * m))
                best.add(plan.scores(values), ids[a : a + DOCS], without[a : a + DOCS])
        best.merge()
        item, score, none, doc = best.held
        yield pa.RecordBatch.from_arrays([pa.array(item), pa.array(doc, mask=none.astype(bool)), pa.array(score)], names=["item", "doc_id", "score"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "item long, doc_id long, score long")


def search(docs: DataFrame, items: DataFrame, k: int, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """(`item_id`, `rank` from 1, `doc_id`, `score`): each item's k documents of the highest scores above 0."""
    texts = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("binary").alias("text"))
    asked = items.select(F.col(item_id).cast("long").alias("item_id"), F.col(item_text).cast("binary").alias("text")).distinct()
    blocks = max(1, math.ceil(asked.count() / ITEMS))
    dealt = asked.withColumn("block", F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)))
    out = None
    for b in range(blocks):
        own = [(r.item_id, bytes(r.text or b"")) for r in dealt.filter(F.col("block") == b).orderBy(F.col("item_id"), "text").collect()]
        found = _block(texts, own, k)
        names = docs.sparkSession.createDataFrame([(i, x[0]) for i, x in enumerate(own)], "item long, item_id long")
        found = found.join(F.broadcast(names), "item").withColumn("block", F.lit(b))
        out = found if out is None else out.union(found)
    order = F.desc("score"), F.col("doc_id").asc_nulls_last()
    some = Window.partitionBy("block", "item", F.pmod(F.xxhash64("doc_id"), F.lit(SALTS))).orderBy(*order)
    some = out.withColumn("place", F.row_number().over(some)).filter(F.col("place") <= k)
    whole = Window.partitionBy("block", "item").orderBy(*order)
    ranked = some.withColumn("rank", F.row_number().over(whole)).filter(F.col("rank") <= k)
    return ranked.select("item_id", "rank", "doc_id", "score")
