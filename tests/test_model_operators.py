"""Ranks, splits, folds, scaling and metrics against brute force."""

import hashlib
import random
from datetime import date

import numpy as np
import pytest
from pyspark.sql import functions as F

from creditmart.functions.dates import ModelWindows
from creditmart.operators import metrics, modelset, ranking


def test_running_totals(spark):
    rng = random.Random(5)
    values = {round(rng.gauss(0, 1), 3): rng.randrange(10) for _ in range(500)}
    df = spark.createDataFrame(list(values.items()), "k double, n bigint")
    for ranges in (1, 7, 64):
        rows = ranking.running_totals(df, "k", ["n"], ranges).orderBy("k").collect()
        total, keys = 0, sorted(values)
        assert [r["k"] for r in rows] == keys
        for r, following in zip(rows, [*keys[1:], None]):
            assert r["n_before"] == total
            assert r["n_next"] == (None if following is None else values[following])
            total += r["n"]


def brute_ranks(ids, labels, seed):
    order = {}
    for label in set(labels):
        members = [i for i, y in zip(ids, labels) if y == label]
        members.sort(key=lambda i: (hashlib.md5(f"{seed}:{i}".encode()).hexdigest(), i))
        order |= {i: r for r, i in enumerate(members, 1)}
    return order


@pytest.fixture(scope="module")
def labelled(spark):
    ids = list(range(997))
    labels = [0 if i % 10 else 1 for i in ids]
    return ids, labels, spark.createDataFrame(list(zip(ids, labels)), "id bigint, label int").repartition(5)


def test_stratified_split_is_exact(labelled):
    ids, labels, df = labelled
    ranks = brute_ranks(ids, labels, 88)
    limits = {y: round(0.8 * labels.count(y)) for y in (0, 1)}
    got = {r["id"]: r["split"] for r in modelset.train_test_split(df, "label", ["id"]).collect()}
    assert got == {i: "train" if ranks[i] <= limits[y] else "test" for i, y in zip(ids, labels)}


def test_split_edges(spark, labelled):
    _, _, df = labelled
    assert modelset.train_test_split(df, "label", ["id"], 1.0).where("split = 'test'").count() == 0
    assert modelset.train_test_split(df, "label", ["id"], 0.0).where("split = 'train'").count() == 0
    unlabelled = spark.createDataFrame([(1, None), (2, 1)], "id bigint, label int")
    assert {r["id"]: r["split"] for r in modelset.train_test_split(unlabelled, "label", ["id"]).collect()} == {
        1: None, 2: "train",
    }
    many = spark.range(500).withColumn("label", F.col("id") % 25)
    split = modelset.train_test_split(many, "label", ["id"], 0.8).where("split = 'train'").groupBy("label").count().collect()
    assert len(split) == 25 and {r["count"] for r in split} == {16}


def test_folds_are_even(labelled):
    ids, labels, df = labelled
    ranks = brute_ranks(ids, labels, 42)
    rows = modelset.assign_folds(df, "label", ["id"], 3).collect()
    assert {r["id"]: r["fold"] for r in rows} == {i: (ranks[i] - 1) % 3 for i in ids}


def test_scaler(spark):
    df = spark.createDataFrame([(1.0, 5.0), (2.0, 5.0), (float("nan"), 5.0), (None, None), (6.0, 5.0)], "a double, b double")
    params = modelset.fit_scaler(df, ["a", "b"])
    known = np.array([1.0, 2.0, 6.0])
    assert params["a"] == pytest.approx((known.mean(), known.std()))
    assert params["b"] == (5.0, 1.0)
    scaled = [r["a"] for r in modelset.apply_scaler(df, params).collect()]
    assert scaled[2] is None and scaled[3] is None
    assert np.mean([v for v in scaled if v is not None]) == pytest.approx(0)


@pytest.fixture(scope="module")
def scores(spark):
    rng = random.Random(6)
    rows = [(round(rng.random(), 2), int(rng.random() < 0.3)) for _ in range(400)]
    rows += [(0.5, 0)] * 300 + [(0.5, 1)] * 20  # one score holds nearly half of all rows
    return rows, spark.createDataFrame(rows, "score double, label int").repartition(4)


def brute_auc(rows):
    pos = np.array([s for s, y in rows if y == 1])
    neg = np.array([s for s, y in rows if y == 0])
    wins = (pos[:, None] > neg[None, :]).sum() + (pos[:, None] == neg[None, :]).sum() / 2
    return wins / (len(pos) * len(neg))


def test_auc_and_gini(scores):
    rows, df = scores
    auc = brute_auc(rows)
    assert metrics.roc_auc(df).first()["auc"] == pytest.approx(auc, abs=1e-12)
    assert metrics.gini(df).first()[0] == round(2 * auc - 1, 3)


def test_auc_equals_the_evaluator(spark, scores):
    from pyspark.ml.evaluation import BinaryClassificationEvaluator

    _, df = scores
    evaluator = BinaryClassificationEvaluator(rawPredictionCol="score", numBins=0)
    assert evaluator.evaluate(df) == pytest.approx(metrics.roc_auc(df).first()["auc"], abs=1e-9)


def test_roc_curve(scores):
    rows, df = scores
    for drop in (False, True):
        points = metrics.roc_curve(df, drop_intermediate=drop).orderBy(F.desc("threshold")).collect()
        assert (points[0]["fpr"], points[0]["tpr"], points[0]["threshold"]) == (0, 0, float("inf"))
        assert (points[-1]["fpr"], points[-1]["tpr"]) == (1, 1)
        area = np.trapezoid([p["tpr"] for p in points], [p["fpr"] for p in points])
        assert area == pytest.approx(brute_auc(rows), abs=1e-12)
        if not drop:
            assert len(points) == 1 + len({s for s, _ in rows})


def test_roc_curve_drops_points_on_a_line(spark):
    df = spark.createDataFrame([(0.9, 1), (0.8, 1), (0.7, 1), (0.6, 0), (0.5, 0)], "score double, label int")
    thresholds = [r["threshold"] for r in metrics.roc_curve(df).orderBy(F.desc("threshold")).collect()]
    assert thresholds == [float("inf"), 0.9, 0.7, 0.5]


def test_class_metrics(spark, scores):
    rows, df = scores
    tp = sum(s > 0.5 and y == 1 for s, y in rows)
    fp = sum(s > 0.5 and y == 0 for s, y in rows)
    fn = sum(s <= 0.5 and y == 1 for s, y in rows)
    tn = sum(s <= 0.5 and y == 0 for s, y in rows)
    row = metrics.class_metrics(df).first()
    assert row["accuracy"] == pytest.approx((tp + tn) / len(rows))
    assert row["precision"] == pytest.approx(tp / (tp + fp))
    assert row["recall"] == pytest.approx(tp / (tp + fn))
    assert row["f1"] == pytest.approx(2 * tp / (2 * tp + fp + fn))
    hard = [(float(s > 0.5), y) for s, y in rows]
    assert metrics.balanced_accuracy(df).first()[0] == pytest.approx(brute_auc(hard))
    none = spark.createDataFrame([(0.1, 0)], "score double, label int")
    assert tuple(metrics.class_metrics(none).first()) == (1.0, 0.0, 0.0, 0.0, 0)


def test_rows_without_a_score_are_left_out_everywhere(spark):
    known = [(0.9, 1), (0.2, 0), (0.7, 0), (0.6, 1)]
    df = spark.createDataFrame([*known, (None, 1), (float("nan"), 0), (None, 0)], "score double, label int")
    only = spark.createDataFrame(known, "score double, label int")
    auc = metrics.roc_auc(df).first()
    assert (auc["n_pos"], auc["n_neg"], auc["n_unscored"], auc["auc"]) == (2, 2, 3, metrics.roc_auc(only).first()["auc"])
    assert sorted(map(tuple, metrics.roc_curve(df).collect())) == sorted(map(tuple, metrics.roc_curve(only).collect()))
    assert tuple(metrics.class_metrics(df).first())[:4] == tuple(metrics.class_metrics(only).first())[:4]
    assert metrics.class_metrics(df).first()["n_unscored"] == 3
    assert metrics.balanced_accuracy(df).first() == metrics.balanced_accuracy(only).first()


def test_model_data_needs_one_feature_row_per_key(spark):
    labels = spark.createDataFrame([("a", date(1998, 1, 1), 1)], "Customer_ID string, snapshot_date date, label int")
    twice = spark.createDataFrame([("a", date(1998, 1, 1), 1.0)] * 2, "Customer_ID string, snapshot_date date, fe_1 double")
    windows = ModelWindows("1999-01-01")
    with pytest.raises(ValueError, match="occurs 2 times"):
        modelset.model_dataset(labels, twice, windows)
    assert modelset.model_dataset(labels, twice, windows, duplicates=True).count() == 2
