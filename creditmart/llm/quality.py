"""Quality scores by Bradley-Terry ranking.

A document's strength is linear in features of its whole text. Weights are learnt from all pairs of a labelled document of
label 1 and one of label 0, by logistic loss on the difference of their strengths. The threshold is an exact quantile of the
strengths of the labelled documents: the share of them with label 0. Strengths become scores by a logistic curve on which the
threshold falls on a given score.

All labelled documents are learnt from, and no pair is made: what a document's pairs add to the loss and its gradient is a
smooth function of its strength, given how the other label's strengths are spread. A step counts strengths in narrow ranges in
one pass over the stored features, and sums the gradient in another; the driver sees counts by range and sums by weight.
A range counts at its mean strength, so with ranges of 0.02 the loss of a pair is off by some millionths.

Features are counts, shares and ratios that are defined for empty text too; null counts as empty text. Texts of any length are
read whole. Documents of one strength get one score, repeated rows each theirs; labels that contradict each other count as
both. Without pairs (no label 0 or no label 1, or an empty table) all scores are the threshold's. An input column named like an
output column is replaced.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from creditmart.llm.common import stored, with_arrays
from creditmart.operators.quantiles import Quantile, exact_quantiles

#: Kinds of bytes: 0 other letters (also all of non-ASCII text), 1 capitals, 2 digits, 3 white space, 4 stops, 5 quotes
#: and brackets, 6 all other signs.
KIND = np.zeros(256, dtype=np.uint8)
KIND[65:91] = 1
KIND[48:58] = 2
KIND[[9, 10, 11, 12, 13, 32]] = 3
KIND[list(b".,;:!?")] = 4
KIND[list(b"'\"()[]-")] = 5
KIND[list(b"#$%&*|<>=+@/\\^_`{}~")] = 6
KIND[:9] = 6
N_FEATURES = 21
STEPS = 10
#: Width of a range of strengths in which pairs are counted, and the number of ranges from which on they get wider.
RANGE, RANGES = 0.02, 8_192
#: Steps at most, the gain below which they end, and the steps that the next direction is made from.
ROUNDS, GAIN, REMEMBERED = 40, 1e-5, 10


def features(text: bytes) -> list[float]:
    """Shares and ratios of one text."""
    n = max(1, len(text))
    kinds = np.bincount(KIND[np.frombuffer(text, dtype=np.uint8)], minlength=7) / n
    words = text.split()
    w = max(1, len(words))
    lower = Counter(text.lower().split())
    top = sum(c for _, c in lower.most_common(1))
    pairs = len(set(zip(words, words[1:])))
    lines = [x for x in text.split(b"\n") if x]
    lengths = np.fromiter(map(len, words), dtype=np.float64, count=len(words)) if words else np.zeros(1)
    return [
        np.log1p(len(text)), np.log1p(len(words)), *kinds.tolist(),
        float(lengths.mean()), float(lengths.std()), float(lengths.max() > 40), float((lengths <= 3).mean()),
        len(lower) / w, len(lower) / w**0.8, top / w, pairs / max(1, w - 1),
        len(set(lines)) / max(1, len(lines)), np.log1p(len(lines)), text.count(b"!!") / w, text.count(b" | ") / w,
    ]


def matrix(texts: list[bytes | None]) -> np.ndarray:
    return np.array([features(t or b"") for t in texts]).reshape(-1, N_FEATURES)


@dataclass
class Ranking:
    """A monotone curve for each feature, as weights of steps at its quantiles, and the threshold."""

    steps: np.ndarray
    weights: np.ndarray
    cut: float
    spread: float
    at_cut: float

    def strength(self, x: np.ndarray) -> np.ndarray:
        return _raised(x, self.steps) @ self.weights

    def score(self, x: np.ndarray) -> np.ndarray:
        z = (self.strength(x) - self.cut) / self.spread + np.log(self.at_cut / (1 - self.at_cut))
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _raised(x: np.ndarray, steps: np.ndarray) -> np.ndarray:
    """Each feature as soft steps: how far the value lies above each of its quantiles, from 0 to 1."""
    low, high = steps[:, :-1], steps[:, 1:]
    wide = np.maximum(high - low, 1e-9)
    return np.clip((x[:, :, None] - low[None]) / wide[None], 0, 1).reshape(len(x), -1)


def _rows(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    return batch.column(0).flatten().to_numpy().reshape(-1, N_FEATURES), batch.column(1).to_numpy()


@dataclass
class Pairs:
    """The loss over all pairs of stored features of label 1 and label 0, and its gradient."""

    labelled: DataFrame
    steps: np.ndarray
    penalty: float

    def spread(self, weights: np.ndarray) -> dict[int, tuple[np.ndarray, np.ndarray]]:
        """By label, how many documents are in each range of strengths, and their mean there: one pass."""
        steps, width = self.steps, max(RANGE, 2 * np.abs(weights).sum() / RANGES)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                x, label = _rows(batch)
                s = _raised(x, steps) @ weights
                places, at = np.unique(np.stack([label.astype(np.int64), np.floor(s / width).astype(np.int64)]), axis=1, return_inverse=True)
                at = at.ravel()
                yield pa.RecordBatch.from_arrays([pa.array(places[0]), pa.array(places[1]), pa.array(np.bincount(at)), pa.array(np.bincount(at, s))], names=["label", "place", "n", "total"])

        counts = self.labelled.mapInArrow(run, "label long, place long, n long, total double").groupBy("label", "place")
        rows = counts.agg(F.sum("n").alias("n"), F.sum("total").alias("total")).collect()
        rows.sort(key=lambda r: (r.label, r.place))
        found = {}
        for label in (0, 1):
            n, total = (np.array([r[f] for r in rows if r.label == label], dtype=np.float64) for f in ("n", "total"))
            found[label] = n, total / n
        return found

    def loss(self, weights: np.ndarray, spread: dict) -> float:
        (bad, below), (good, above) = spread[0], spread[1]
        total = sum(float(n * (np.logaddexp(0, s - above) @ good)) for n, s in zip(bad, below))
        return total / (bad.sum() * good.sum()) + self.penalty / 2 * float(weights @ weights)

    def gradient(self, weights: np.ndarray, spread: dict) -> np.ndarray:
        """One pass. How much a document pulls is found on a grid of strengths, and between its points by a straight line."""
        steps, size = self.steps, len(weights)
        (bad, below), (good, above) = spread[0], spread[1]
        least, most = min(below[0], above[0]) - 2 * RANGE, max(below[-1], above[-1]) + 2 * RANGE
        grid = np.linspace(least, most, min(RANGES, int((most - least) / RANGE) + 2))
        up = np.array([_logistic(s - above) @ good for s in grid]) / (bad.sum() * good.sum())
        down = np.array([_logistic(below - s) @ bad for s in grid]) / (bad.sum() * good.sum())

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros(size)
            for batch in batches:
                x, label = _rows(batch)
                raised = _raised(x, steps)
                s = raised @ weights
                total += np.where(label == 0, np.interp(s, grid, up), -np.interp(s, grid, down)) @ raised
            yield pa.RecordBatch.from_arrays([pa.array([total], pa.list_(pa.float64()))], names=["sums"])

        sums = [r.sums for r in self.labelled.mapInArrow(run, "sums array<double>").collect()]
        return np.sum(sums, axis=0) + self.penalty * weights


def _logistic(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def least_loss(pairs: Pairs, size: int) -> np.ndarray:
    """Weights by quasi-Newton steps (limited memory BFGS) with halved steps until the loss falls."""
    weights, moves = np.zeros(size), []
    spread = pairs.spread(weights)
    loss, gradient = pairs.loss(weights, spread), pairs.gradient(weights, spread)
    for _ in range(ROUNDS):
        way, used = -gradient, []
        for move, turn in reversed(moves):
            part = (move @ way) / (move @ turn)
            used.append(part)
            way = way - part * turn
        way = way * ((moves[-1][0] @ moves[-1][1]) / (moves[-1][1] @ moves[-1][1]) if moves else 1 / max(1e-12, np.linalg.norm(gradient)))
        for (move, turn), part in zip(moves, reversed(used)):
            way = way + (part - (turn @ way) / (move @ turn)) * move
        length, slope = 1.0, float(gradient @ way)
        while True:
            tried = weights + length * way
            spread = pairs.spread(tried)
            found = pairs.loss(tried, spread)
            if found <= loss + 1e-4 * length * slope or length < 1e-3:
                break
            length /= 2
        if found >= loss:
            return weights
        new = pairs.gradient(tried, spread)
        if (tried - weights) @ (new - gradient) > 0:
            moves = [*moves, (tried - weights, new - gradient)][-REMEMBERED:]
        gain, weights, gradient, loss = loss - found, tried, new, found
        if gain < GAIN:
            break
    return weights


def knots(labelled: DataFrame, rare: int) -> np.ndarray:
    """Exact quantiles of each feature, of all rows and of the rarer label's, so that its range is covered too."""
    at = np.linspace(0, 1, STEPS + 1)
    columns = [F.col("x")[i].alias(f"all_{i}") for i in range(N_FEATURES)]
    columns += [F.when(F.col("label") == rare, F.col("x")[i]).alias(f"rare_{i}") for i in range(N_FEATURES)]
    wanted = [Quantile(f"{kind}_{i}", float(p), f"{kind}_{i}_{k}", "linear") for kind in ("all", "rare") for i in range(N_FEATURES) for k, p in enumerate(at)]
    found = exact_quantiles(labelled.select(*columns), wanted)
    return np.sort([[found[f"{kind}_{i}_{k}"] for kind in ("all", "rare") for k in range(STEPS + 1)] for i in range(N_FEATURES)], axis=1)


def mapped_features(id_type: T.DataType) -> tuple[Callable, T.StructType]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = matrix(batch.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(list(x), pa.list_(pa.float64()))], names=["id", "x"])

    return run, T.StructType([T.StructField("id", id_type), T.StructField("x", T.ArrayType(T.DoubleType()))])


def learn(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "quality", at_cut: float = 0.3, penalty: float = 1e-3) -> Ranking:
    """Fit on all labelled documents. Their features are joined to the labels, not their texts, and stored."""
    known = labels.filter(F.col(label).isin(0, 1) & F.col(doc_id).isNotNull()).select(F.col(doc_id).alias("id"), F.col(label).cast("int").alias("label"))
    texts = docs.filter(F.col(doc_id).isNotNull()).select(F.col(doc_id).alias("id"), F.col(text).cast("binary").alias("text"))
    labelled = stored(texts.mapInArrow(*mapped_features(texts.schema["id"].dataType)).join(known, "id").select("x", "label"))
    rows = {r.label: r.n for r in labelled.groupBy("label").agg(F.count("*").alias("n")).collect()}
    if len(rows) < 2:
        return Ranking(np.zeros((N_FEATURES, 2)), np.zeros(N_FEATURES), 0.0, 1.0, at_cut)
    steps = knots(labelled, 0 if rows[0] < rows[1] else 1)
    weights = least_loss(Pairs(labelled, steps, penalty), N_FEATURES * (steps.shape[1] - 1))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array(_raised(_rows(batch)[0], steps) @ weights)], names=["s"])

    strengths = labelled.mapInArrow(run, "s double")
    # The strength that as many rows reach at most as have label 0; half a row less keeps the rank's rounding out of it.
    at = exact_quantiles(strengths, [Quantile("s", (rows[0] - 0.5) / (rows[0] + rows[1]), "cut")])["cut"]
    above, spread = strengths.agg(F.min(F.when(F.col("s") > at, F.col("s"))), F.stddev_pop("s")).first()
    # The threshold lies between this strength and the next one.
    return Ranking(steps, weights, float(at if above is None else (at + above) / 2), max(1e-9, float(spread) / 2), at_cut)


def score(docs: DataFrame, model: Ranking, text: str = "text") -> DataFrame:
    """The documents with `score` (0 to 1) and `predicted` (1 from the threshold's score on)."""
    added = [T.StructField("score", T.DoubleType(), False), T.StructField("predicted", T.IntegerType(), False)]
    schema = T.StructType([f for f in docs.schema.fields if f.name.lower() not in ("score", "predicted")] + added)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [None if t is None else t.encode() for t in batch.column(text).to_pylist()]
            s = model.score(matrix(texts))
            order = pa.schema([(f.name, pa.null()) for f in schema.fields])
            yield with_arrays(batch, order, {"score": pa.array(s, pa.float64()), "predicted": pa.array((s >= model.at_cut).astype(np.int32))})

    return docs.mapInArrow(run, schema)
