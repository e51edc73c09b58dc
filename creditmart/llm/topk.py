"""Exact top-k search by inner product, term at a time.

Vectors are sparse rows of integer weights. Candidates are packed into blocks of bounded size as postings: for each term, the
rows that hold it and their weights. A query goes through its terms and adds weight times posting weight into a dense array
of scores of the block; partition selection takes the block's best, and the best of all blocks are merged per query. Queries
are packed into blocks too, and each block of queries meets each block of candidates in one task, so memory is bounded
whatever the number of either.

Vectors that are null or hold null or non-finite components take no part. Vectors of different lengths meet in the terms
they share. Ties go to the smaller id. Every row but those with the query's own id is a candidate, and repeated candidates
count each; repeated queries of one id and vector give one result. A query of a null id gives no result; candidates with a
null id take no part. Without candidates or queries there are no rows. Columns other than the two are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from creditmart.llm.common import stored

#: Rows of a block of candidates, and of a block of queries.
ROWS, QUERIES = 20_000, 2_000
PACKED = "ids binary, starts binary, terms binary, weights binary"


def quantized(vector: Column, scale: float = 1024.0) -> Column:
    """floor(scale * x) of every component, as long; null if the vector takes no part."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.when(vector.isNotNull() & ~bad, F.transform(vector, lambda x: F.floor(F.lit(scale) * x.cast("double"))))


def _pack(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.RecordBatch]:
    """Rows (id, weights) as blocks of sparse rows: ids, starts of rows, terms and weights."""
    ids: list = []
    vectors: list = []

    def block() -> pa.RecordBatch:
        lengths = np.fromiter(map(len, vectors), dtype=np.int64, count=len(vectors))
        flat = np.concatenate([np.asarray(v, dtype=np.int64) for v in vectors]) if vectors else np.zeros(0, dtype=np.int64)
        terms = np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        row = np.repeat(np.arange(len(vectors)), lengths)
        used = flat != 0
        starts = np.concatenate(([0], np.cumsum(np.bincount(row[used], minlength=len(vectors)))))
        arrays = np.array(ids, dtype=np.int64), starts.astype(np.int64), terms[used].astype(np.int32), flat[used]
        return pa.RecordBatch.from_arrays([pa.array([a.tobytes()], pa.binary()) for a in arrays], names=["ids", "starts", "terms", "weights"])

    for batch in batches:
        for i, v in zip(batch.column(0).to_pylist(), batch.column(1).to_numpy(zero_copy_only=False)):
            ids.append(i)
            vectors.append(v)
            if len(ids) == rows:
                yield block()
                ids, vectors = [], []
    if ids:
        yield block()


def _unpacked(row: dict) -> tuple[np.ndarray, ...]:
    kinds = {"ids": np.int64, "starts": np.int64, "terms": np.int32, "weights": np.int64}
    return tuple(np.frombuffer(row[k], dtype=t) for k, t in kinds.items())


def best_of_block(queries: tuple[np.ndarray, ...], block: tuple[np.ndarray, ...], k: int) -> Iterator[tuple[int, int, int, int]]:
    """(query's place, query id, candidate id, score) for each query's best candidates of one block."""
    ids, starts, terms, weights = block
    row = np.repeat(np.arange(len(ids)), np.diff(starts))
    by_term = np.argsort(terms, kind="stable")
    bounds = np.searchsorted(terms[by_term], np.arange(terms.max() + 2 if len(terms) else 1))
    posting_rows, posting_weights = row[by_term], weights[by_term]
    q_ids, q_starts, q_terms, q_weights = queries
    for q in range(len(q_ids)):
        scores = np.zeros(len(ids), dtype=np.int64)
        for term, weight in zip(q_terms[q_starts[q] : q_starts[q + 1]], q_weights[q_starts[q] : q_starts[q + 1]]):
            if term + 1 < len(bounds):
                a, b = bounds[term], bounds[term + 1]
                if b - a == len(ids):  # every row has the term, in order
                    scores += weight * posting_weights[a:b]
                else:
                    scores[posting_rows[a:b]] += weight * posting_weights[a:b]
        others = np.flatnonzero(ids != q_ids[q])
        if len(others) > k:
            own = scores[others]
            least = np.partition(own, len(own) - k)[len(own) - k]
            others = others[own >= least]  # all ties at the last place, for their ids decide
        best = others[np.lexsort((ids[others], -scores[others]))[:k]]
        yield from ((q, int(q_ids[q]), int(ids[c]), int(scores[c])) for c in best)


def search(candidates: DataFrame, queries: DataFrame, k: int, vec_id: str = "vec_id", weights: str = "weights") -> DataFrame:
    """(`query_id`, `rank` from 1, `vec_id`, `score`) of each query's k best candidates. Both frames have an id and an
    array of integer weights by term.
    """
    rows = candidates.filter(F.col(vec_id).isNotNull() & F.col(weights).isNotNull()).select(F.col(vec_id).cast("long").alias("id"), F.col(weights).alias("w"))
    asked = queries.filter(F.col(vec_id).isNotNull() & F.col(weights).isNotNull()).select(F.col(vec_id).cast("long").alias("id"), F.col(weights).alias("w")).distinct()
    blocks = rows.mapInArrow(lambda b: _pack(b, ROWS), PACKED)
    asked = stored(asked)
    parts = max(1, math.ceil(asked.count() / QUERIES))
    packed = asked.repartition(parts).mapInArrow(lambda b: _pack(b, QUERIES), PACKED)
    numbered = stored(packed.select(F.monotonically_increasing_id().alias("n"), *[F.col(c).alias(f"q_{c}") for c in ("ids", "starts", "terms", "weights")]))
    numbers = [r.n for r in numbered.select("n").collect()]
    pairs = blocks.withColumn("n", F.explode(F.array(*[F.lit(n).cast("long") for n in numbers]) if numbers else F.array().cast("array<bigint>"))).join(numbered, "n")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                theirs = _unpacked({c: row[f"q_{c}"] for c in ("ids", "starts", "terms", "weights")})
                found = [(row["n"], q, i, c, s) for q, i, c, s in best_of_block(theirs, _unpacked(row), k)]
                columns = list(zip(*found)) or [[]] * 5
                yield pa.RecordBatch.from_arrays([pa.array(list(c), pa.int64()) for c in columns], names=["n", "q", "query_id", "vec_id", "score"])

    best = pairs.mapInArrow(run, "n long, q long, query_id long, vec_id long, score long")
    order = Window.partitionBy("n", "q").orderBy(F.desc("score"), "vec_id")
    ranked = best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
