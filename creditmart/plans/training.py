"""Training, search, evaluation, storage and batch use of the credit model."""

from __future__ import annotations

import random
from collections.abc import Sequence
from dataclasses import dataclass, field
from math import prod

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession, functions as F

from creditmart.functions.dates import ModelWindows
from creditmart.operators import metrics
from creditmart.operators.modelset import (
    assign_folds, fit_scaler, model_dataset, oot_split, split_summary, train_test_split,
)
from creditmart.operators.schema import columns_except, columns_with_prefix
from creditmart.plans import boosting
from creditmart.plans.boosting import Boosted, Settings
from creditmart.session import materialized

# The search space.
SEARCH_SPACE = {
    "n_estimators": [25, 50],
    "max_depth": [2, 3],
    "learning_rate": [0.01, 0.1],
    "subsample": [0.6, 0.8],
    "colsample_bytree": [0.6, 0.8],
    "gamma": [0, 0.1],
    "min_child_weight": [1, 3, 5],
    "reg_alpha": [0, 0.1, 1],
    "reg_lambda": [1, 1.5, 2],
}
# Columns of the model data that are not features.
NOT_FEATURES = ("Customer_ID", "snapshot_date", "label", "loan_id", "label_def", "split", "fold")


@dataclass
class TrainConfig:
    """Everything a training run depends on besides its data."""

    train_date: str
    train_months: int = 12
    oot_months: int = 2
    train_share: float = 0.8
    split_seed: int = 88
    search_seed: int = 42
    n_iter: int = 10
    folds: int = 3
    bins: int = 64
    join: str = "left"
    hard_label: bool = False
    space: dict[str, list] = field(default_factory=lambda: dict(SEARCH_SPACE))
    ids: tuple[str, ...] = ("loan_id",)
    label: str = "label"
    feature_prefix: str | None = "fe_"

    @property
    def windows(self) -> ModelWindows:
        return ModelWindows(self.train_date, self.train_months, self.oot_months)

    @property
    def version(self) -> str:
        return "credit_model_" + self.train_date.replace("-", "_")

    def features(self, df: DataFrame) -> list[str]:
        if self.feature_prefix is not None:
            return columns_with_prefix(df, self.feature_prefix)
        return columns_except(df, NOT_FEATURES)


@dataclass
class Trained:
    """A fitted model with what is reported about it."""

    version: str
    model: Boosted
    features: list[str]
    best_params: dict
    cv_score: float
    stats: dict[str, tuple[int, float]]
    auc: dict[str, float]
    config: TrainConfig


def prepare(labels: DataFrame, features: DataFrame, config: TrainConfig) -> DataFrame:
    """Model data with ``split`` = train, test or oot; rows outside the windows are left out.

    A left join keeps the labels as they are, so they are split before it, without the features.
    """
    if config.join == "left":
        own = materialized(labels.where(config.windows.covers(F.col("snapshot_date"))))  # read by each pass of the split
        return model_dataset(_split(own, config), features, config.windows, "left")
    return _split(model_dataset(labels, features, config.windows, config.join), config)


def _split(df: DataFrame, config: TrainConfig) -> DataFrame:
    """The train/test window split at random; the out-of-time rows keep their name."""
    data = oot_split(df, config.windows)
    candidates = data.where("split = 'train_test'").drop("split")
    split = train_test_split(candidates, config.label, config.ids, config.train_share, config.split_seed)
    return split.unionByName(data.where("split = 'oot'"))


def sample_grid(space: dict[str, list], n_iter: int, seed: int) -> list[dict]:
    """Different random points of the grid: n_iter of them, or all when there are fewer."""
    total = prod(len(v) for v in space.values())
    points = []
    for index in random.Random(seed).sample(range(total), min(n_iter, total)):
        point = {}
        for name, values in space.items():
            index, at = divmod(index, len(values))
            point[name] = values[at]
        points.append(point)
    return points


def learnt(train: DataFrame, features: Sequence[str], config: TrainConfig) -> dict:
    """What models of the training rows share. Scaling (mean 0, population deviation 1) and cuts are fitted on them."""
    scaling = fit_scaler(train, features)
    return {"scaling": scaling, "cuts": boosting.learnt_cuts(train, features, config.label, scaling, config.bins)}


def random_search(train: DataFrame, features: Sequence[str], config: TrainConfig, shared: dict | None = None) -> list[tuple[dict, float]]:
    """Sampled points of the grid with their mean score over stratified folds, best first. All points and folds grow together."""
    grid = sample_grid(config.space, config.n_iter, config.search_seed)
    folded = materialized(assign_folds(train, config.label, config.ids, config.folds, config.search_seed))
    scores = boosting.search(
        folded, features, config.label, config.ids, [boosting.changed(Settings(), **p) for p in grid], config.folds,
        config.hard_label, fold="fold", seed=config.split_seed, **(shared or learnt(train, features, config)),
    )
    return sorted(zip(grid, scores), key=lambda found: -found[1])


def search_results(found: Sequence[tuple[dict, float]]) -> DataFrame:
    """One row per tried point: its parameters and mean score, best first."""
    rows = [({k: str(v) for k, v in point.items()}, float(score)) for point, score in found]
    return SparkSession.active().createDataFrame(rows, "params map<string,string>, score double").orderBy(F.desc("score"))


def fit(train: DataFrame, features: Sequence[str], config: TrainConfig, settings: Settings, shared: dict | None = None) -> Boosted:
    """One model of the training rows. Their scaling is part of the model."""
    shared = shared or learnt(train, features, config)
    return boosting.fit(train, features, config.label, config.ids, settings, seed=config.split_seed, **shared)


def score(model: Boosted, df: DataFrame, name: str = "score") -> DataFrame:
    """The input rows with the probability of class 1."""
    return df.withColumn(name, model.probability())


def feature_importance(model: Boosted, features: Sequence[str]) -> DataFrame:
    """Importance per feature (mean gain of its splits, as a share), largest first."""
    found = model.importance()
    frame = SparkSession.active().createDataFrame([(f, found[f]) for f in features], "feature string, importance double")
    return frame.orderBy(F.desc("importance"), "feature")


def train(data: DataFrame, config: TrainConfig) -> Trained:
    """Search on the training rows, refit, and evaluate on train, test and out-of-time rows."""
    features = config.features(data)
    training = data.where("split = 'train'")
    shared = learnt(training, features, config)
    found = random_search(training, features, config, shared)
    params, cv_score = found[0]
    model = fit(training, features, config, boosting.changed(Settings(), **params), shared)
    stats = {r["split"]: (r["n_rows"], r["bad_rate"]) for r in split_summary(data, config.label).collect()}
    return Trained(config.version, model, features, params, cv_score, stats, evaluate(model, data, config), config)


def evaluate(model: Boosted, data: DataFrame, config: TrainConfig) -> dict[str, float]:
    """Exact AUC per split; the rows are scored once."""
    scored = score(model, data).select("split", config.label, "score").persist(StorageLevel.DISK_ONLY)
    try:
        return {
            name: metrics.roc_auc(scored.where(F.col("split") == name), "score", config.label).first()["auc"]
            for name in ("train", "test", "oot")
        }
    finally:
        scored.unpersist()


def metadata(trained: Trained) -> DataFrame:
    """One row about the model: version, windows, rows, bad rates, AUC and Gini per split, parameters."""
    # The fields' names.
    w = trained.config.windows
    columns = {
        "model_version": F.lit(trained.version),
        "model_train_date": F.lit(trained.config.train_date).cast("date"),
        "train_test_start_date": w.train_start,
        "train_test_end_date": w.train_end,
        "oot_start_date": w.oot_start,
        "oot_end_date": w.oot_end,
    }
    for name in ("train", "test", "oot"):
        n, rate = trained.stats.get(name, (0, None))
        auc = trained.auc.get(name)
        columns[f"n_{name}"] = F.lit(n).cast("bigint")
        columns[f"bad_rate_{name}"] = F.lit(rate).cast("double")
        columns[f"auc_{name}"] = F.lit(auc).cast("double")
        columns[f"gini_{name}"] = F.round(2 * F.lit(auc).cast("double") - 1, 3)
    columns["cv_score"] = F.lit(trained.cv_score).cast("double")
    columns["hp_params"] = F.create_map(
        *[F.lit(str(x)) for pair in trained.best_params.items() for x in pair]
    )
    columns["features"] = F.array(*[F.lit(f) for f in trained.features])
    return SparkSession.active().range(1).select(*[c.alias(name) for name, c in columns.items()])


def save(trained: Trained, bank: str) -> str:
    """Store the model and its metadata under the model bank; returns the model's path."""
    path = f"{bank.rstrip('/')}/{trained.version}"
    trained.model.save(SparkSession.active(), f"{path}/model")
    metadata(trained).write.mode("overwrite").parquet(f"{path}/metadata")
    return path


def load(spark: SparkSession, bank: str, version: str) -> tuple[Boosted, DataFrame]:
    path = f"{bank.rstrip('/')}/{version}"
    return Boosted.load(spark, f"{path}/model"), spark.read.parquet(f"{path}/metadata")
