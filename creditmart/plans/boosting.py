"""Regularised second-order boosting of trees on DataFrames, many models in one pass.

Features are cut at quantiles into bins once, and blocks of binned rows are kept by Spark with every model's margins. A level of
a tree is one aggregation: every row gives its gradient and hessian to (model, node, feature, bin). Tasks sum them up by numpy,
for several features at once where their bins together are few; the tasks' sums meet by model, and the best split of each node is
found from prefix sums over the bins. Only the chosen splits reach the driver. All models of a search, one for each point and
fold, grow side by side in the same passes over the rows.

Splits maximise ``s(left) + s(right) - s(node)`` with ``s = max(|G| - reg_alpha, 0)^2 / (H + reg_lambda)``; a split needs a gain
of ``gamma`` or more and ``min_child_weight`` hessian on both sides. Missing values (NULL or NaN) go to the side that gains
more, per split; a split may be on missing alone. Leaves weigh ``-sign(G) max(|G| - reg_alpha, 0) / (H + reg_lambda)``, times
the learning rate. Rows are drawn by a hash of their ids and the tree, columns once for a tree. Gradients are summed as whole
numbers, so a model is the same on any cluster.
"""

from __future__ import annotations

import math
import random
from collections.abc import Callable, Iterator, Mapping, Sequence
from dataclasses import asdict, dataclass, field, fields, replace

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from creditmart.operators.quantiles import Quantile, fit_quantiles
from creditmart.session import materialized, shared_folder

#: Gradients are multiplied by this and rounded: 10^11 rows add up within 64 bits.
SCALE = 1 << 24
#: Gains up to this are none.
NO_GAIN = 1e-6
#: Trees after which the margins are written to the shared folder, and models that grow in one pass.
STORE_EVERY, TOGETHER = 10, 32
#: Rows of a block, and sums that a task makes at once for each of its rows at most.
BLOCK, SUMS_A_ROW = 1 << 16, 0.25
MISSING = -1


@dataclass(frozen=True)
class Settings:
    n_estimators: int = 50
    max_depth: int = 3
    learning_rate: float = 0.1
    subsample: float = 1.0
    colsample_bytree: float = 1.0
    gamma: float = 0.0
    min_child_weight: float = 1.0
    reg_alpha: float = 0.0
    reg_lambda: float = 1.0


@dataclass(frozen=True)
class Node:
    """A node of a tree: a split if it has a feature, else a leaf. Children of node n are 2n+1 and 2n+2."""

    weight: float
    feature: str | None = None
    cut: float | None = None
    bin: int | None = None
    missing_right: bool | None = None
    gain: float | None = None


Tree = dict[int, Node]


@dataclass
class Boosted:
    """A fitted model. Scores are expressions over the feature columns."""

    base: float
    trees: list[Tree]
    settings: Settings
    features: list[str]
    scaling: dict[str, tuple[float, float]] = field(default_factory=dict)

    def value(self, feature: str) -> Column:
        """The feature as the trees see it: double, scaled if the model scales, NULL if missing."""
        return known(feature, self.scaling.get(feature))

    def margin(self) -> Column:
        """Base and leaves added up. The values of a row are read once; the trees are one literal that the rows walk through."""
        place = {f: i for i, f in enumerate(self.features)}

        def column(nodes: list[Node | None], of, otherwise) -> str:
            return _array([otherwise if n is None else of(n) for n in nodes])

        def tree(t: Tree) -> str:
            nodes = [t.get(n) for n in range(max(t) + 1)]
            parts = {
                "feature": column(nodes, lambda n: place.get(n.feature, MISSING), MISSING),
                "cut": column(nodes, lambda n: float("inf") if n.cut is None else float(n.cut), 0.0),
                "other": column(nodes, lambda n: int(bool(n.missing_right)), 0),
                "weight": column(nodes, lambda n: 0.0 if n.feature else n.weight, 0.0),
            }
            return f"named_struct({', '.join(f'{k!r}, {v}' for k, v in parts.items())})"

        if not self.trees:
            return F.lit(self.base)
        trees, steps = F.expr(f"array({', '.join(map(tree, self.trees))})"), F.sequence(F.lit(1), F.lit(self.settings.max_depth))

        def step(values: Column, t: Column, n: Column) -> Column:
            f = t["feature"][n]
            v = values[F.greatest(f, F.lit(0))]
            right = F.when(v.isNull(), t["other"][n]).otherwise((v >= t["cut"][n]).cast("int"))
            return F.when(f == MISSING, n).otherwise(2 * n + 1 + right)

        def total(values: Column) -> Column:
            def add(acc: Column, t: Column) -> Column:
                return acc + t["weight"][F.aggregate(steps, F.lit(0), lambda n, _: step(values, t, n))]

            return F.aggregate(trees, F.lit(self.base), add)

        return F.transform(F.array(F.array(*[self.value(f) for f in self.features])), total).getItem(0)

    def probability(self) -> Column:
        return 1 / (1 + F.exp(-self.margin()))

    def importance(self) -> dict[str, float]:
        """Mean gain of each feature's splits, as shares that sum up to 1."""
        gains: dict[str, list[float]] = {f: [] for f in self.features}
        for node in (n for t in self.trees for n in t.values() if n.feature is not None):
            gains[node.feature].append(node.gain)
        means = {f: sum(g) / len(g) if g else 0.0 for f, g in gains.items()}
        total = sum(means.values()) or 1.0
        return {f: m / total for f, m in means.items()}

    def save(self, spark: SparkSession, path: str) -> None:
        nodes = [(i, n, *(getattr(v, f.name) for f in fields(Node))) for i, t in enumerate(self.trees) for n, v in t.items()]
        spark.createDataFrame(nodes, NODE_SCHEMA).coalesce(1).write.mode("overwrite").parquet(f"{path}/trees")
        head = [(self.base, self.features, {k: list(v) for k, v in self.scaling.items()}, {k: float(v) for k, v in asdict(self.settings).items()})]
        spark.createDataFrame(head, HEAD_SCHEMA).coalesce(1).write.mode("overwrite").parquet(f"{path}/head")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> Boosted:
        head = spark.read.parquet(f"{path}/head").first()
        trees: dict[int, Tree] = {}
        for r in spark.read.parquet(f"{path}/trees").orderBy("tree", "node").collect():
            trees.setdefault(r["tree"], {})[r["node"]] = Node(**{f.name: r[f.name] for f in fields(Node)})
        kinds = {f.name: type(f.default) for f in fields(Settings)}
        settings = Settings(**{k: kinds[k](v) for k, v in head["settings"].items()})
        return cls(head["base"], list(trees.values()), settings, list(head["features"]), {k: tuple(v) for k, v in head["scaling"].items()})


NODE_SCHEMA = "tree int, node int, weight double, feature string, cut double, bin int, missing_right boolean, gain double"
HEAD_SCHEMA = "base double, features array<string>, scaling map<string,array<double>>, settings map<string,double>"


def known(feature: str, scale: tuple[float, float] | None = None) -> Column:
    c = F.col(f"`{feature}`").cast("double")
    c = F.when(~F.isnan(c), c)
    return c if scale is None else (c - F.lit(scale[0])) / F.lit(scale[1])


def fit_cuts(rows: DataFrame, features: Sequence[str], bins: int = 64, rel_err: float = 0.0) -> dict[str, list[float]]:
    """Values between the bins: each feature's quantiles, every value once. All features are fitted together."""
    quantiles = [Quantile(f, i / bins, f"{j}:{i}") for j, f in enumerate(features) for i in range(1, bins)]
    found = fit_quantiles(rows, quantiles, rel_err)
    cuts = {f: sorted({found[f"{j}:{i}"] for i in range(1, bins)} - {None}) for j, f in enumerate(features)}
    return {f: c or [0.0] for f, c in cuts.items()}


def _binner(features: Sequence[str], cuts: Mapping[str, list[float]]) -> Callable:
    """What cuts a batch's features into bins: the number of cuts up to the value, or MISSING."""
    edges = [np.array(cuts[f]) for f in features]
    kind = np.min_scalar_type(-max((len(e) for e in edges), default=1) - 1)

    def bins(batch: pa.RecordBatch) -> pa.Array:
        found = np.empty((batch.num_rows, len(edges)), kind)
        for i, (name, own) in enumerate(zip(names, edges)):
            v = batch.column(batch.schema.get_field_index(name)).to_numpy(zero_copy_only=False)
            found[:, i] = np.where(np.isnan(v), MISSING, np.searchsorted(own, v, "right"))
        return pa.FixedSizeListArray.from_arrays(pa.array(found.reshape(-1)), len(edges))

    names = [f"_f{i}" for i in range(len(edges))]
    return bins


def binned(rows: DataFrame, features: Sequence[str], cuts: Mapping[str, list[float]]) -> RDD:
    """Blocks of (`row`, `label`, `fold`, `bins`) as record batches, as many to each task."""
    cut, most = _binner(features, cuts), BLOCK

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def packed() -> pa.RecordBatch:
            sink = pa.BufferOutputStream()
            block = pa.Table.from_batches(waiting).combine_chunks().to_batches()[0]
            with pa.ipc.new_stream(sink, block.schema) as stream:
                stream.write_batch(block)
            return pa.RecordBatch.from_arrays([pa.array([sink.getvalue().to_pybytes()], pa.binary())], names=["block"])

        waiting, size = [], 0
        for batch in batches:
            if batch.num_rows:
                kept = [batch.column(batch.schema.get_field_index(c)) for c in ("row", "label", "fold")]
                waiting.append(pa.RecordBatch.from_arrays([*kept, cut(batch)], names=["row", "label", "fold", "bins"]))
                size += batch.num_rows
            if size >= most:
                yield packed()
                waiting, size = [], 0
        if waiting:
            yield packed()

    def opened(row) -> pa.RecordBatch:
        return pa.ipc.open_stream(row[0]).read_next_batch()

    named = rows.select("row", "label", "fold", *[known(f).alias(f"_f{i}") for i, f in enumerate(features)])
    dealt = named.repartition(max(1, rows.sparkSession.sparkContext.defaultParallelism))
    return dealt.mapInArrow(blocks, "block binary").rdd.map(opened)


def _array(values: Sequence) -> str:
    """SQL of an array of plain values."""

    def text(v) -> str:
        if isinstance(v, float):
            return f"{v!r}D" if math.isfinite(v) else f"double('{v}')"
        return str(v).lower()

    return f"array({', '.join(map(text, values))})"


def best_splits(settings: Sequence[Settings], features: int, bins: int) -> Callable:
    """What adds up tasks' sums by (`node`, `feature`, `bin`) that come with their model, and finds each node's best split.

    Gives (`m`, `node`, `g`, `h`, `best`); `best` has gain, feature, bin, side of missing values, and gradient and hessian to the
    left, or is None where no split is allowed. Of equal gains, the first feature and bin count, and missing goes right.
    """
    own = [(s.reg_alpha, s.reg_lambda, s.min_child_weight, s.gamma) for s in settings]
    scale, none = float(SCALE), NO_GAIN

    def best(sums: np.ndarray, l1: float, l2: float, least: float, gamma: float) -> tuple:
        def strength(g: np.ndarray, h: np.ndarray) -> np.ndarray:
            pulled, held = np.maximum(np.abs(g) - l1, 0.0), h + l2
            return np.divide(pulled * pulled, held, out=np.zeros_like(held), where=held != 0)

        g, h = sums.sum(axis=2) / scale  # of each feature: all of the node
        some = np.flatnonzero(sums.any(axis=(0, 2)))[0]
        low = np.cumsum(sums[:, :, 1:], axis=2)
        gl, hl = np.stack([low, low + sums[:, :, :1]], axis=3) / scale  # missing to the right, and to the left
        g, h = g[:, None, None], h[:, None, None]
        gain = strength(gl, hl) + strength(g - gl, h - hl) - strength(g, h)
        smaller = np.minimum(hl, h - hl)
        allowed = (smaller >= least) & (smaller > 0) & (gain > none) & (gain >= gamma) & sums[:, :, 1:].any(axis=0)[:, :, None]
        gain[~allowed] = -np.inf
        at = np.unravel_index(np.argmax(gain), gain.shape)
        found = (float(gain[at]), int(at[0]), int(at[1]), bool(at[2] == 0), float(gl[at]), float(hl[at])) if allowed[at] else None
        return float(g[some, 0, 0]), float(h[some, 0, 0]), found

    def run(sums: Iterator[tuple[int, pa.RecordBatch]]) -> Iterator[tuple]:
        total: dict[tuple[int, int], np.ndarray] = {}
        for m, batch in sums:
            node, feature, b, g, h = (batch.column(i).to_numpy() for i in range(1, 6))
            for n in np.unique(node):
                if (m, int(n)) not in total:
                    total[m, int(n)] = np.zeros((2, features, bins), np.int64)
                of = node == n
                for k, x in enumerate((g, h)):
                    total[m, int(n)][k, feature[of], b[of] + 1] += x[of]
        for (m, n), s in total.items():
            yield m, n, *best(s, *own[m])

    return run


@dataclass
class _Growth:
    """What grows in one pass: for each model the trees so far, and of the tree at hand its splits, open nodes and columns."""

    settings: list[Settings]
    features: list[str]
    cuts: Mapping[str, list[float]]
    trees: list[list[Tree]]

    def start(self, t: int, seed: int) -> None:
        n = len(self.features)
        self.tree: list[Tree] = [{} for _ in self.settings]
        self.open = [[0] if t < s.n_estimators else [] for s in self.settings]
        self.drawn = [sorted(random.Random(f"{seed}:{t}").sample(range(n), max(1, int(s.colsample_bytree * n)))) for s in self.settings]
        self.size = 2 ** (max(s.max_depth for s in self.settings) + 1) - 1

    def weight(self, m: int, g: float, h: float) -> float:
        s = self.settings[m]
        pulled = math.copysign(max(abs(g) - s.reg_alpha, 0.0), -g)
        return s.learning_rate * pulled / (h + s.reg_lambda) if h + s.reg_lambda > 0 else 0.0

    def take(self, found: list, level: int) -> None:
        """Use the best splits of a level; children of the last one are leaves."""
        nodes = {(m, n): rest for m, n, *rest in found}
        for m, s in enumerate(self.settings):
            ends: list[int] = []
            for n in self.open[m]:
                g, h, best = nodes.get((m, n), (None, None, None))
                if best is None:
                    self.tree[m].setdefault(n, Node(0.0 if g is None else self.weight(m, g, h)))
                    continue
                gain, f, b, missing_right, g_left, h_left = best
                name = self.features[f]
                cut = self.cuts[name][b] if b < len(self.cuts[name]) else float("inf")
                self.tree[m][n] = Node(self.weight(m, g, h), name, cut, b, missing_right, gain)
                self.tree[m][2 * n + 1] = Node(self.weight(m, g_left, h_left))
                self.tree[m][2 * n + 2] = Node(self.weight(m, g - g_left, h - h_left))
                ends += [2 * n + 1, 2 * n + 2]
            self.open[m] = ends if level + 1 < s.max_depth else []

    @property
    def width(self) -> int:
        """Bins of the feature that has most, with that of missing values."""
        return max(len(c) for c in self.cuts.values()) + 2

    def tables(self) -> list[tuple[list[tuple[int, int, int, bool]], np.ndarray]]:
        """The tree at hand of each model: its splits (node, place of the feature, bin, side of missing values) from the root on, and weights by node."""
        place = {f: i for i, f in enumerate(self.features)}
        found = []
        for t in self.tree:
            splits = [(n, place[v.feature], v.bin, bool(v.missing_right)) for n, v in sorted(t.items()) if v.feature is not None]
            weights = np.zeros(self.size)
            for n, v in t.items():
                weights[n] = v.weight if v.feature is None else 0.0
            found.append((splits, weights))
        return found

    def finish(self) -> list[tuple[list[tuple[int, int, int, bool]], np.ndarray]]:
        """The tree is done: its tables."""
        for m, t in enumerate(self.tree):
            if t:
                self.trees[m].append(t)
        return self.tables()


def _walker() -> Callable:
    """What tells the node that rows reach by a tree's splits. Bins are by feature, and the greatest of their type for missing."""

    def walk(splits: Sequence[tuple[int, int, int, bool]], bins: np.ndarray, size: int) -> np.ndarray:
        reached = np.zeros(bins.shape[1], np.min_scalar_type(size))
        kind, one = reached.dtype.type, bins.dtype.type(1)
        for n, feature, cut, missing_right in splits:
            # one more wraps around: missing becomes the least
            right = bins[feature] > cut if missing_right else bins[feature] + one > cut + 1
            reached += (reached == kind(n)) * (right + kind(n + 1))  # from n to 2n + 1, or to 2n + 2
        return reached

    return walk


def _reader(width: int, models: int, done: Sequence) -> Callable:
    """What reads a batch's bins by feature, the greatest of their type for missing, and its margins by model with the leaves of the
    finished trees added."""
    walk, lines = _walker(), 1 << 10

    def read(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
        def column(name: str, size: int) -> np.ndarray:
            values = batch.column(batch.schema.get_field_index(name)).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, size)
            turned = np.empty((size, batch.num_rows), values.dtype)
            for i in range(0, batch.num_rows, lines):
                turned[:, i : i + lines] = values[i : i + lines].T
            return turned

        bins, margins = column("bins", width), column("margins", models)
        bins = bins.view(bins.dtype.str.replace("i", "u"))
        for tree in done:
            for m, (splits, weights) in enumerate(tree):
                if weights.any():
                    margins[m] += weights.take(walk(splits, bins, len(weights)))
        return bins, margins

    return read


HISTOGRAM = "m int, node int, feature int, bin int, g bigint, h bigint"


def _histograms(growth: _Growth, level: int, done: Sequence, held_out: Sequence[int]) -> Callable:
    """A task's sums of gradients and hessians by (`m`, `node`, `feature`, `bin`), for the open nodes of all models: a batch a model.

    Features whose bins together are few against the rows are summed up at once, by the bins of all of them; the sums of each
    follow from these. Models that draw the same rows and columns share what they read.
    """
    read, walk, trees = _reader(len(growth.features), len(growth.settings), done), _walker(), growth.tables()
    width, scale, share_of_rows, size = growth.width, SCALE, SUMS_A_ROW, growth.size
    above = 2**level - 1  # nodes above the level
    sizes = [len(growth.cuts[f]) + 2 for f in growth.features]
    alike: dict[tuple, list[tuple[int, list[int]]]] = {}
    for m, (o, s) in enumerate(zip(growth.open, growth.settings)):
        if o:
            alike.setdefault((tuple(growth.drawn[m]), held_out[m], s.subsample), []).append((m, list(o)))

    def together(drawn: Sequence[int], most: float) -> list[list[int]]:
        """The drawn features in groups with up to so many bins together."""
        groups: list[tuple[int, list[int]]] = []
        for f in sorted(drawn, key=lambda f: -sizes[f]):
            at = next((i for i, (cells, _) in enumerate(groups) if cells * sizes[f] <= most), None)
            if at is None:
                groups.append((sizes[f], [f]))
            else:
                groups[at] = (groups[at][0] * sizes[f], [*groups[at][1], f])
        return [g for _, g in groups]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = {m: np.zeros((2, len(nodes), len(drawn), width), np.int64) for (drawn, _, _), own in alike.items() for m, nodes in own}
        for batch in batches:
            bins, margins = read(batch)
            label, fold, u = (batch.column(batch.schema.get_field_index(c)).to_numpy() for c in ("label", "fold", "u"))
            label, places = label.astype(np.float64), bins + bins.dtype.type(1)  # from 0 for missing
            grouped = {}
            for (drawn, out, share), own in alike.items():
                rows, most = np.flatnonzero((fold != out) & (u < share)), max(len(nodes) for _, nodes in own)
                if (drawn, most) not in grouped:
                    grouped[drawn, most] = cells = []
                    for group in together(drawn, share_of_rows * batch.num_rows / most):
                        cell = places[group[0]].astype(np.int64)
                        for f in group[1:]:
                            cell *= sizes[f]
                            cell += places[f]
                        cells.append((group, cell))
                y, cells = label.take(rows), [(group, cell.take(rows)) for group, cell in grouped[drawn, most]]
                for m, nodes in own:
                    p = margins[m].take(rows)
                    np.negative(p, out=p)
                    np.exp(p, out=p)
                    p += 1
                    np.divide(1, p, out=p)
                    x = p - y
                    g = np.abs(x)
                    p *= 1 - p
                    for z in (g, p):
                        z *= scale
                        z += 0.5
                        np.floor(z, out=z)
                    sums, slot, kept = [np.copysign(g, x, out=g), p], None, None
                    if level:
                        slots = np.full(size, -1)
                        slots[nodes] = np.arange(len(nodes))
                        slot = slots.take(walk([s for s in trees[m][0] if s[0] < above], bins, size).take(rows))
                        if (slot < 0).any():
                            kept = np.flatnonzero(slot >= 0)
                            slot, sums = slot.take(kept), [z.take(kept) for z in sums]
                    for group, cell in cells:
                        shape = [len(nodes), *[sizes[f] for f in group]]
                        at = cell if kept is None else cell.take(kept)
                        if len(nodes) > 1:
                            at = slot * math.prod(shape[1:]) + at
                        for k, z in enumerate(sums):
                            found = np.bincount(at, z, math.prod(shape)).reshape(shape)
                            for i, f in enumerate(group, 1):
                                of = found.sum(axis=tuple(a for a in range(1, len(shape)) if a != i))
                                total[m][k, :, drawn.index(f), : sizes[f]] += of.astype(np.int64)
        for (drawn, _, _), own in alike.items():
            for m, nodes in own:
                node, feature, b = np.nonzero(total[m].any(axis=0))
                g, h = total[m][:, node, feature, b]
                columns = [np.full(len(b), m), np.array(nodes)[node], np.array(drawn)[feature], b - 1]
                yield pa.RecordBatch.from_arrays([*[pa.array(x.astype(np.int32)) for x in columns], pa.array(g), pa.array(h)], names=["m", "node", "feature", "bin", "g", "h"])

    return run


def _draw(tree: int, seed: int) -> Callable:
    """What draws rows for a tree: a number from 0 to 1 from ``xxhash64(row, tree, seed)``."""
    # The primes of xxHash, and Spark's seed.
    p1, p2, p3, p4, p5 = 0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5
    start, mask = 42, (1 << 64) - 1

    def turned(x: np.ndarray, by: int) -> np.ndarray:
        return (x << np.uint64(by)) | (x >> np.uint64(64 - by))

    def mixed(x: np.ndarray) -> np.ndarray:
        x = (x ^ (x >> np.uint64(33))) * np.uint64(p2)
        x = (x ^ (x >> np.uint64(29))) * np.uint64(p3)
        return x ^ (x >> np.uint64(32))

    def long(value: np.ndarray, seeds: np.ndarray) -> np.ndarray:
        x = seeds + np.uint64(p5 + 8) ^ turned(value * np.uint64(p2), 31) * np.uint64(p1)
        return mixed(turned(x, 27) * np.uint64(p1) + np.uint64(p4))

    def whole(value: int, seeds: np.ndarray) -> np.ndarray:
        if not -(1 << 31) <= value < 1 << 31:
            return long(np.full(len(seeds), value & mask, np.uint64), seeds)
        x = seeds + np.uint64(p5 + 4) ^ np.uint64((value & 0xFFFFFFFF) * p1 & mask)
        return mixed(turned(x, 23) * np.uint64(p2) + np.uint64(p3))

    def u(row: np.ndarray) -> np.ndarray:
        seeds = long(row.view(np.uint64), np.full(len(row), start, np.uint64))
        return (whole(seed, whole(tree, seeds)) & np.uint64((1 << 20) - 1)) / float(1 << 20)

    return u


def _advanced(growth: _Growth, done: Sequence, tree: int, seed: int, base: Sequence[float] | None = None) -> Callable:
    """Blocks with the leaves of the finished trees added to their margins, which start at ``base``, and rows drawn for the next tree."""
    models = len(growth.settings)
    read, draw = _reader(len(growth.features), models, done), _draw(tree, seed)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, label, fold, bins = (batch.column(batch.schema.get_field_index(c)) for c in ("row", "label", "fold", "bins"))
            margins = np.tile(base, batch.num_rows) if base is not None else read(batch)[1].T.reshape(-1)
            columns = {"row": row, "label": label, "fold": fold, "bins": bins, "u": pa.array(draw(row.to_numpy())), "margins": pa.FixedSizeListArray.from_arrays(pa.array(margins), models)}
            yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))

    return run


def _grow(blocks: RDD, growth: _Growth, base: Sequence[float], held_out: Sequence[int], seed: int) -> RDD:
    """Grow all trees of the models; the rows with the margins of every model, those of held-out rows too."""
    tasks = min(len(growth.settings), blocks.getNumPartitions())
    state, trees = blocks.mapPartitions(_advanced(growth, [], 0, seed, base)).persist(StorageLevel.MEMORY_AND_DISK), max(s.n_estimators for s in growth.settings)
    before = None
    for t in range(trees):
        growth.start(t, seed)
        level = 0
        while any(growth.open):
            cells = state.mapPartitions(_histograms(growth, level, [], held_out)).map(lambda b: (b.column(0)[0].as_py(), b) if b.num_rows else (0, b))
            split = best_splits(growth.settings, len(growth.features), growth.width)
            growth.take(cells.partitionBy(tasks, lambda m: m).mapPartitions(split).collect(), level)
            level += 1
        if before is not None:
            before.unpersist()
        before, state = state, state.mapPartitions(_advanced(growth, [growth.finish()], t + 1, seed)).persist(StorageLevel.MEMORY_AND_DISK)
        if (t + 1) % STORE_EVERY == 0 or t + 1 == trees:
            state.checkpoint()
    state.foreachPartition(lambda _: None)
    if before is not None:
        before.unpersist()
    return state.unpersist() if trees else state


def _valued(rows: DataFrame, features: Sequence[str], label: str, scaling: Mapping[str, tuple[float, float]] | None, *more: Column) -> DataFrame:
    """The rows that have a label, with their features as the trees see them."""
    return rows.where(F.col(label).isNotNull()).select(*more, *[known(f, (scaling or {}).get(f)).alias(f) for f in features])


def learnt_cuts(rows: DataFrame, features: Sequence[str], label: str, scaling: Mapping[str, tuple[float, float]] | None = None, bins: int = 64) -> dict[str, list[float]]:
    """The cuts that models of these rows have; several fits of the same rows can share them."""
    return fit_cuts(_valued(rows, features, label, scaling), features, bins)


def fit_many(
    rows: DataFrame, features: Sequence[str], label: str, ids: Sequence[str], settings: Sequence[Settings],
    held_out: Sequence[int] | None = None, fold: str | None = None, scaling: Mapping[str, tuple[float, float]] | None = None,
    bins: int = 64, seed: int = 88, cuts: Mapping[str, list[float]] | None = None,
) -> tuple[list[Boosted], DataFrame]:
    """A model for each of the settings, and (`m`, `fold`, `label`, `margin`) of every row and model.

    Model i does not learn from rows whose ``fold`` is ``held_out[i]``. Rows without a label are left out. ``ids`` identify a
    row: with the seed they decide which trees draw it. ``cuts`` are those of the rows unless given.
    """
    features, held_out = list(features), list(held_out or [-1] * len(settings))
    scaling = dict(scaling or {})
    cuts = learnt_cuts(rows, features, label, scaling, bins) if cuts is None else cuts
    named = [F.xxhash64(*ids).alias("row"), F.col(label).cast("int").alias("label"), (F.col(fold) if fold else F.lit(0)).cast("int").alias("fold")]
    scaled = _valued(rows, features, label, scaling, *named)
    shared_folder(rows.sparkSession)
    blocks = binned(scaled, features, cuts).persist(StorageLevel.MEMORY_AND_DISK)
    blocks.checkpoint()
    counts = _counts(blocks)
    models, scores = [], None
    for a in range(0, len(settings), TOGETHER):
        some, out = list(settings[a : a + TOGETHER]), held_out[a : a + TOGETHER]
        base = [_log_odds([c for f, c in counts.items() if f != h]) for h in out]
        growth = _Growth(some, features, cuts, [[] for _ in some])
        grown = _grow(blocks, growth, base, out, seed)
        models += [Boosted(b, t, s, features, scaling) for b, t, s in zip(base, growth.trees, some)]
        one = _margins(rows.sparkSession, grown, a)
        scores = one if scores is None else scores.unionByName(one)
    blocks.unpersist()
    return models, scores


def _counts(blocks: RDD) -> dict[int, tuple[int, int]]:
    """Rows of each fold, and their labels added up."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, tuple[int, int]]]:
        for batch in batches:
            label, fold = (batch.column(batch.schema.get_field_index(c)).to_numpy() for c in ("label", "fold"))
            for f in np.unique(fold):
                yield int(f), (int((fold == f).sum()), int(label[fold == f].sum(dtype=np.int64)))

    found: dict[int, tuple[int, int]] = {}
    for f, (n, pos) in blocks.mapPartitions(count).collect():
        rows, labels = found.get(f, (0, 0))
        found[f] = rows + n, labels + pos
    return found


def _margins(spark: SparkSession, state: RDD, first: int) -> DataFrame:
    """(`m`, `fold`, `label`, `margin`) of the rows in blocks, models counted from ``first``."""

    def packed(batch: pa.RecordBatch) -> tuple[bytes]:
        sink = pa.BufferOutputStream()
        block = batch.select(["fold", "label", "margins"])
        with pa.ipc.new_stream(sink, block.schema) as stream:
            stream.write_batch(block)
        return (sink.getvalue().to_pybytes(),)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for packed_blocks in batches:
            for block in packed_blocks.column(0):
                batch = pa.ipc.open_stream(block.as_buffer()).read_next_batch()
                margins = batch.column(2).flatten().to_numpy().reshape(batch.num_rows, -1)
                for m in range(margins.shape[1]):
                    columns = [pa.array(np.full(batch.num_rows, first + m, np.int32)), batch.column(0), batch.column(1), pa.array(margins[:, m])]
                    yield pa.RecordBatch.from_arrays(columns, names=["m", "fold", "label", "margin"])

    blocks = spark.createDataFrame(state.map(packed), "block binary", verifySchema=False)
    return blocks.mapInArrow(run, "m int, fold int, label int, margin double")


def _log_odds(counts: list[tuple[int, int]]) -> float:
    """Log-odds of label 1; half a row of each label is added where one is lacking."""
    n, pos = sum(c[0] for c in counts), sum(c[1] for c in counts)
    if pos in (0, n):
        n, pos = n + 1, pos + 0.5
    return math.log(pos / (n - pos))


def fit(rows: DataFrame, features: Sequence[str], label: str, ids: Sequence[str], settings: Settings, **more) -> Boosted:
    return fit_many(rows, features, label, ids, [settings], **more)[0][0]


def search(rows: DataFrame, features: Sequence[str], label: str, ids: Sequence[str], points: Sequence[Settings], folds: int, hard_label: bool = False, **more) -> list[float]:
    """Mean held-out score of each point over the folds: the AUC of the probabilities, or of the 0/1 predictions."""
    settings = [p for p in points for _ in range(folds)]
    held_out = [f for _ in points for f in range(folds)]
    _, scores = fit_many(rows, features, label, ids, settings, held_out, **more)
    own = materialized(scores.where(F.expr(f"fold = {_array(held_out)}[m]")))
    found = hard_label_by_model(own) if hard_label else auc_by_model(own)
    by = {r["m"]: r["score"] for r in found.collect()}
    scored = [[by[i * folds + f] for f in range(folds) if by.get(i * folds + f) is not None] for i in range(len(points))]
    return [sum(s) / len(s) if s else 0.5 for s in scored]


def auc_by_model(scores: DataFrame) -> DataFrame:
    """(`m`, `score`): exact AUC of the margins. Windows are cut at ranges of the probability, so none has all rows of a model."""
    p = 1 / (1 + F.exp(-F.col("margin")))
    groups = scores.groupBy("m", F.floor(p * 4096).alias("part"), "margin").agg(F.sum("label").alias("pos"), F.sum(1 - F.col("label")).alias("neg"))
    groups = materialized(groups)
    before = Window.partitionBy("m").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = groups.groupBy("m", "part").agg(F.sum("neg").alias("n")).withColumn("start", F.coalesce(F.sum("n").over(before), F.lit(0))).drop("n")
    inside = Window.partitionBy("m", "part").orderBy("margin").rowsBetween(Window.unboundedPreceding, -1)
    ranked = groups.withColumn("below", F.coalesce(F.sum("neg").over(inside), F.lit(0))).join(starts, ["m", "part"])
    wide = "decimal(38,0)"
    wins = F.col("pos").cast("decimal(19,0)") * (2 * (F.col("below") + F.col("start")) + F.col("neg")).cast("decimal(19,0)")
    sums = ranked.groupBy("m").agg(F.sum("pos").alias("p"), F.sum("neg").alias("n"), F.sum(wins.cast(wide)).alias("w"))
    pairs = F.col("p").cast("double") * F.col("n").cast("double")
    return sums.select("m", F.when(pairs > 0, F.col("w").cast("double") / 2 / pairs).alias("score"))


def hard_label_by_model(scores: DataFrame) -> DataFrame:
    """(`m`, `score`): AUC of the 0/1 predictions, the mean recall of the two labels."""
    right = [F.avg(F.when(F.col("label") == v, (((F.col("margin") > 0).cast("int")) == v).cast("double"))) for v in (0, 1)]
    return scores.groupBy("m").agg(((right[0] + right[1]) / 2).alias("score"))


def changed(settings: Settings, **values) -> Settings:
    """The settings with other values; whole numbers stay whole."""
    kinds = {f.name: type(f.default) for f in fields(Settings)}
    return replace(settings, **{k: kinds[k](v) for k, v in values.items()})
