"""The training job on learnable data: search, storage, scoring and the command line."""

import math
import random
from datetime import date

import numpy as np
import pyarrow as pa
import pytest

from creditmart import jobs
from creditmart.operators import metrics
from creditmart.plans import boosting, training
from creditmart.plans.datamart_jobs import Build
from creditmart.sources.datamart import Datamart

SPACE = {"n_estimators": [3, 5], "max_depth": [2], "learning_rate": [0.3], "subsample": [0.8], "min_child_weight": [1, 2]}


@pytest.fixture(scope="module")
def mart(spark, tmp_path_factory):
    """Gold labels and silver features in which fe_1 decides the label, some features missing."""
    rng = random.Random(7)
    labels, clicks = [], []
    for i in range(1400):
        day = date(2023, 1 + i % 12, 1) if i % 14 < 12 else date(2024, 1 + i % 2, 1)
        x = rng.random()
        y = int(x + rng.gauss(0, 0.1) > 0.6)
        labels.append((f"l{i}", f"c{i}", y, "30dpd_6mob", day))
        if i % 20:
            clicks.append((f"c{i}", day, float(x), float(rng.random()) if i % 3 else None))
    mart = Datamart(spark, str(tmp_path_factory.mktemp("mart")))
    schema = "loan_id string, Customer_ID string, label int, label_def string, snapshot_date date"
    mart.write(spark.createDataFrame(labels, schema), "gold", "label_store")
    frame = spark.createDataFrame(clicks, "Customer_ID string, snapshot_date date, fe_1 float, fe_2 float")
    mart.write(frame, "silver", "clickstream")
    return mart


def config(**changes):
    base = dict(train_date="2024-03-01", n_iter=2, folds=2, space=SPACE)
    return training.TrainConfig(**{**base, **changes})


@pytest.fixture(scope="module")
def trained(spark, mart, tmp_path_factory):
    bank = str(tmp_path_factory.mktemp("bank"))
    build = Build(spark, "", mart)
    return jobs.train_model(build, config(), bank), bank


def test_model_learns_and_reports(trained):
    model, _ = trained
    assert model.version == "credit_model_2024_03_01"
    assert min(model.auc.values()) > 0.8
    assert sum(n for n, _ in model.stats.values()) == 1400
    train, test = model.stats["train"][0], model.stats["test"][0]
    assert abs(train - 0.8 * (train + test)) <= 2
    assert model.best_params.keys() == SPACE.keys()


def test_stored_model_scores_alike(spark, mart, trained):
    model, bank = trained
    stored, meta = training.load(spark, bank, model.version)
    data = mart.read("gold", f"model_data_{model.version}").where("split = 'oot'")
    scored = training.score(stored, data)
    assert scored.columns == [*data.columns, "score"]
    assert metrics.roc_auc(scored).first()["auc"] == model.auc["oot"]
    row = meta.first()
    assert row["auc_oot"] == model.auc["oot"]
    assert row["gini_oot"] == round(2 * model.auc["oot"] - 1, 3)
    assert str(row["oot_start_date"]) == "2024-01-01" and str(row["train_test_start_date"]) == "2023-01-01"


def test_importance(trained):
    model, _ = trained
    rows = training.feature_importance(model.model, model.features).collect()
    assert rows[0]["feature"] == "fe_1"
    assert sum(r["importance"] for r in rows) == pytest.approx(1)


def test_sample_grid():
    grid = training.sample_grid(training.SEARCH_SPACE, 40, 42)
    assert len({tuple(p.items()) for p in grid}) == 40
    assert grid == training.sample_grid(training.SEARCH_SPACE, 40, 42)
    assert all(v in training.SEARCH_SPACE[k] for p in grid for k, v in p.items())
    assert len(training.sample_grid({"a": [1, 2]}, 10, 1)) == 2


def test_inner_join_drops_unmatched_labels(mart):
    labels, clicks = mart.read("gold", "label_store"), mart.read("silver", "clickstream")
    left = training.prepare(labels, clicks, config())
    inner = training.prepare(labels, clicks, config(join="inner"))
    assert left.count() == 1400 and inner.count() == 1330
    assert left.where("split is null").count() == 0


def test_training_on_the_feature_store(spark, mart, tmp_path):
    store = mart.read("silver", "clickstream").selectExpr(
        "Customer_ID", "snapshot_date", "fe_1", "cast(fe_1 * 10 as int) as `Num-of-Loan`"
    )
    other = Datamart(spark, str(tmp_path / "mart"))
    other.write(store, "gold", "feature_store")
    other.write(mart.read("gold", "label_store"), "gold", "label_store")
    changed = config(feature_prefix=None, join="inner", n_iter=1)
    model = jobs.train_model(Build(spark, "", other), changed, str(tmp_path / "bank"))
    assert sorted(model.features) == ["Num-of-Loan", "fe_1"]
    assert sum(n for n, _ in model.stats.values()) == 1330
    assert model.auc["oot"] > 0.8


def test_scores_by_model(spark):
    rng = random.Random(2)
    rows = [(i % 3, rng.randint(0, 1), round(rng.gauss(0, 3), i % 3)) for i in range(900)]
    df = spark.createDataFrame(rows, "m int, label int, margin double")
    auc = {r["m"]: r["score"] for r in boosting.auc_by_model(df).collect()}
    hard = {r["m"]: r["score"] for r in boosting.hard_label_by_model(df).collect()}
    for m in range(3):
        own = df.where(df.m == m)
        assert auc[m] == pytest.approx(metrics.roc_auc(own, "margin").first()["auc"], abs=1e-12)
        flagged = own.selectExpr("label", "double(margin > 0) AS prediction")
        assert hard[m] == pytest.approx(metrics.balanced_accuracy(flagged, "prediction").first()[0], abs=1e-12)


def test_command_line_checks_its_arguments():
    for argv in (["--stage", "train"], ["--stage", "backfill", "--start", "2024-01-01"], ["--stage", "bronze"]):
        with pytest.raises(SystemExit):
            jobs.main(argv)


def test_random_search_results(spark, mart, trained):
    model, _ = trained
    data = mart.read("gold", f"model_data_{model.version}").where("split = 'train'")
    found = training.random_search(data, model.features, config(hard_label=True))
    rows = training.search_results(found).collect()
    assert len(rows) == 2 and rows[0]["score"] >= rows[1]["score"]
    assert 0.5 < rows[0]["score"] <= 1


# Boosting against a plain version of it


def plain_tree(rows, weights, settings, cuts):
    """Splits and leaves of one tree from (values, gradient, hessian), rounded as the sums are."""

    def strength(g, h):
        return max(abs(g) - settings.reg_alpha, 0) ** 2 / (h + settings.reg_lambda)

    def grow(node, own, level):
        g, h = sum(r[1] for r in own) / boosting.SCALE, sum(r[2] for r in own) / boosting.SCALE
        best = None
        if level < settings.max_depth:
            for f, edges in enumerate(cuts):
                for b in range(len(edges) + 1):
                    edge = edges[b] if b < len(edges) else float("inf")
                    for right in (True, False):
                        left = [r for r in own if (not right if r[0][f] is None else r[0][f] < edge)]
                        gl, hl = sum(r[1] for r in left) / boosting.SCALE, sum(r[2] for r in left) / boosting.SCALE
                        if min(hl, h - hl) < settings.min_child_weight or min(hl, h - hl) <= 0:
                            continue
                        gain = strength(gl, hl) + strength(g - gl, h - hl) - strength(g, h)
                        if gain > boosting.NO_GAIN and gain >= settings.gamma and (best is None or gain > best[0] + 1e-9):
                            best = (gain, f, edge, right, left)
        if best is None:
            pulled = max(abs(g) - settings.reg_alpha, 0)
            weights[node] = -settings.learning_rate * (pulled if g > 0 else -pulled) / (h + settings.reg_lambda)
            return {}
        gain, f, edge, right, left = best
        rest = [r for r in own if not any(r is x for x in left)]
        return {node: (f, gain), **grow(2 * node + 1, left, level + 1), **grow(2 * node + 2, rest, level + 1)}

    return grow(0, rows, 0)


@pytest.mark.parametrize("changes", [{}, {"reg_alpha": 2.0, "reg_lambda": 3.0}, {"gamma": 4.0, "min_child_weight": 9.0}, {"reg_lambda": 0.0, "min_child_weight": 0.0}])
def test_trees_equal_a_plain_version(spark, changes):
    rng = random.Random(5)
    settings = boosting.Settings(n_estimators=2, max_depth=2, learning_rate=0.4, **changes)
    rows = []
    for i in range(240):
        x, y = rng.randint(0, 5), rng.random()
        label = int(rng.random() < (0.9 if x > 3 else 0.2 if y > 0.4 else 0.5))
        rows.append((i, label, float(x) if i % 9 else None, y if i % 4 or label else float("nan"), 1.0, None))
    df = spark.createDataFrame(rows, "id int, label int, a double, b double, same double, none double").repartition(5)
    names = ["a", "b", "same", "none"]
    model = boosting.fit(df, names, "label", ["id"], settings, bins=6)
    fitted = boosting.fit_cuts(df.select(*[boosting.known(n).alias(n) for n in names]), names, 6)
    cuts = [fitted[n] for n in names]
    values = [tuple(None if v is None or v != v else v for v in r[2:]) for r in rows]
    margins = [model.base] * len(rows)
    for tree in model.trees:
        p = [1 / (1 + math.exp(-m)) for m in margins]
        given = [[v, round((q - r[1]) * boosting.SCALE), round(q * (1 - q) * boosting.SCALE)] for v, q, r in zip(values, p, rows)]
        weights = {}
        splits = plain_tree(given, weights, settings, cuts)
        assert {n: names[f] for n, (f, _) in splits.items()} == {n: v.feature for n, v in tree.items() if v.feature}
        assert all(tree[n].gain == pytest.approx(g) for n, (_, g) in splits.items())
        assert {n: v.weight for n, v in tree.items() if not v.feature} == pytest.approx(weights)
        for i, v in enumerate(values):
            n = 0
            while tree[n].feature:
                x = v[names.index(tree[n].feature)]
                n = 2 * n + 1 + int(tree[n].missing_right if x is None else x >= tree[n].cut)
            margins[i] += tree[n].weight
    got = {r["id"]: r["m"] for r in df.select("id", model.margin().alias("m")).collect()}
    assert [got[i] for i in range(len(rows))] == pytest.approx(margins)


def test_models_together_are_those_alone(spark):
    """Folds, numbers of trees and depths do not disturb each other, and partitions do not matter."""
    rng = random.Random(6)
    rows = [(i, rng.randint(0, 1), rng.random(), rng.random(), i % 2) for i in range(300)]
    df = spark.createDataFrame(rows, "id int, label int, a double, b double, fold int")
    points = [boosting.Settings(n_estimators=3, max_depth=2, subsample=0.7, colsample_bytree=0.5), boosting.Settings(n_estimators=6, max_depth=1, reg_alpha=0.5)]
    models, scores = boosting.fit_many(df, ["a", "b"], "label", ["id"], points, [1, -1], fold="fold", bins=8)
    alone = [boosting.fit_many(df.repartition(7), ["a", "b"], "label", ["id"], [p], [h], fold="fold", bins=8)[0][0] for p, h in zip(points, [1, -1])]
    assert [m.trees for m in models] == [m.trees for m in alone] and [m.base for m in models] == [m.base for m in alone]
    assert len(models[0].trees) == 3 and len(models[1].trees) == 6
    got = {(r["m"], round(r["margin"], 9)) for r in scores.collect()}
    assert got == {(i, round(r[0], 9)) for i, m in enumerate(models) for r in df.select(m.margin()).collect()}


def test_stored_boosting_is_the_same(spark, tmp_path):
    df = spark.createDataFrame([(i, i % 2, float(i % 7), None if i % 3 else 1.0) for i in range(80)], "id int, label int, `a b` double, c double")
    settings = boosting.Settings(n_estimators=2, max_depth=2, min_child_weight=0.5)
    model = boosting.fit(df, ["a b", "c"], "label", ["id"], settings, scaling={"a b": (3.0, 2.0)}, bins=4)
    model.save(spark, str(tmp_path / "m"))
    assert boosting.Boosted.load(spark, str(tmp_path / "m")) == model
    assert sum(model.importance().values()) == pytest.approx(1)


def test_one_label_and_no_rows(spark):
    df = spark.createDataFrame([(i, 1, float(i)) for i in range(9)], "id int, label int, a double")
    assert 0.5 < df.select(boosting.fit(df, ["a"], "label", ["id"], boosting.Settings(n_estimators=2)).probability()).first()[0] < 1
    assert boosting.fit(df.limit(0), ["a"], "label", ["id"], boosting.Settings(n_estimators=2)).base == 0.0


def test_tasks_sum_up_before_the_shuffle(spark):
    """A task gives a row for each cell that has rows, however many rows, features and models there are; sums are those of plain Python."""
    n = 3_000
    df = spark.range(0, n, 1, 2).selectExpr("int(id % 2) AS label", "int(id % 3) AS fold", "id / 3000D AS u", "array(int(id % 4), int(id % 5) - 1) AS bins", "array(0D, id / 1000D) AS margins")
    settings = [boosting.Settings(max_depth=2), boosting.Settings(max_depth=2, subsample=0.5)]
    growth = boosting._Growth(settings, ["a", "b"], {"a": [1.0, 2.0, 3.0], "b": [1.0, 2.0, 3.0]}, [[], []])
    growth.start(0, 1)
    cells = df.mapInArrow(boosting._histograms(growth, 0, [], [-1, 2]), boosting.HISTOGRAM)
    assert cells.count() == (2 + 1) * (4 + 5)  # the second model draws rows of the first task only
    got = {(r[0], r[1], r[2], r[3]): (r[4], r[5]) for r in cells.groupBy("m", "node", "feature", "bin").sum("g", "h").collect()}
    want = {}
    for i in range(n):
        for m, margin in enumerate((0.0, i / 1000)):
            if m and (i % 3 == 2 or i / 3000 >= 0.5):
                continue
            p = 1 / (1 + math.exp(-margin))
            for f, b in enumerate((i % 4, i % 5 - 1)):
                g, h = want.get((m, 0, f, b), (0, 0))
                want[m, 0, f, b] = (g + round((p - i % 2) * boosting.SCALE), h + round(p * (1 - p) * boosting.SCALE))
    assert got.keys() == want.keys()
    assert all(abs(a - b) <= n for k in want for a, b in zip(got[k], want[k]))


def test_rows_are_drawn_by_sparks_hash(spark):
    """Numpy draws the rows that Spark's hash of row, tree and seed does."""
    df = spark.range(-500, 500).selectExpr("xxhash64(id) AS row")
    for tree, seed in ((0, 88), (49, -3), (7, 1 << 40)):
        want = df.selectExpr("row", f"pmod(xxhash64(row, {tree}, {seed}), {1 << 20}) / {float(1 << 20)}D AS u").collect()
        rows = np.array([r["row"] for r in want], np.int64)
        assert boosting._draw(tree, seed)(rows).tolist() == [r["u"] for r in want]


def test_blocks_are_dealt_evenly(spark):
    """Every task has its share of the rows, though one partition has all of them; bins are counts of the cuts up to a value."""
    values = [None, float("nan"), -1.0, 0.0, 0.5, 2.0, float("inf")]
    rows = [(i, i % 2, 0, values[i % 7], float(i)) for i in range(1400)]
    df = spark.createDataFrame(rows, "row bigint, label int, fold int, a double, `b c` double").coalesce(1)
    blocks = boosting.binned(df, ["a", "b c"], {"a": [0.0, 2.0], "b c": [float(x) for x in range(0, 1400, 10)]})
    sizes = blocks.mapPartitions(lambda own: [sum(b.num_rows for b in own)]).collect()
    assert sum(sizes) == 1400 and max(sizes) - min(sizes) <= len(sizes)
    bins = dict(pair for b in blocks.collect() for pair in zip(b.column(0).to_pylist(), b.column(3).to_pylist()))
    assert [bins[i][0] for i in range(7)] == [-1, -1, 0, 1, 1, 2, 2]
    assert all(bins[i][1] == i // 10 + 1 for i in range(1400))


def test_features_together_are_those_alone(spark, monkeypatch):
    """Sums of several features at once are those of each, with open and closed nodes, and with more bins than a byte counts."""
    rng = random.Random(3)
    batch = {"label": [rng.randint(0, 1) for _ in range(500)], "fold": [i % 3 for i in range(500)], "u": [rng.random() for _ in range(500)]}
    batch["bins"] = [[rng.randint(-1, 2), rng.randint(-1, 3), rng.randint(-1, 200)] for _ in range(500)]
    batch["margins"] = [[rng.gauss(0, 1), rng.gauss(0, 1)] for _ in range(500)]
    types = [pa.int32(), pa.int32(), pa.float64(), pa.list_(pa.int16()), pa.list_(pa.float64())]
    block = pa.RecordBatch.from_arrays([pa.array(batch[c], t) for c, t in zip(("label", "fold", "u", "bins", "margins"), types)], names=["label", "fold", "u", "bins", "margins"])
    settings = [boosting.Settings(max_depth=2, subsample=0.9), boosting.Settings(max_depth=2)]
    growth = boosting._Growth(settings, ["a", "b", "c"], {"a": [0.0, 1.0], "b": [0.0, 1.0, 2.0], "c": [float(x) for x in range(200)]}, [[], []])
    growth.start(0, 1)
    growth.tree = [{0: boosting.Node(0.0, "c", 100.0, 100, False, 1.0)}, {0: boosting.Node(0.0, "a", 1.0, 1, True, 1.0)}]
    growth.open = [[1, 2], [2]]
    found = []
    for share in (0.0, 1e6):
        monkeypatch.setattr(boosting, "SUMS_A_ROW", share)
        found.append(sorted(tuple(r.values()) for b in boosting._histograms(growth, 1, [], [-1, 0])(iter([block])) for r in b.to_pylist()))
    assert found[0] == found[1]
    want = set()
    for u, fold, (a, b, c) in zip(batch["u"], batch["fold"], batch["bins"]):
        if u < 0.9:
            want |= {(0, 2 if c > 100 else 1, f, x) for f, x in enumerate((a, b, c))}
        if fold != 0 and (a == -1 or a > 1):
            want |= {(1, 2, f, x) for f, x in enumerate((a, b, c))}
    assert {r[:4] for r in found[0]} == want


def test_a_level_is_one_job(spark):
    """More trees take a job for each of their levels: sums, splits and margins need no other."""
    df = spark.createDataFrame([(i, i * 7 % 5 % 2, float(i % 13), float(i % 8)) for i in range(200)], "id int, label int, a double, b double")

    def jobs_of(trees: int) -> int:
        spark.sparkContext.setJobGroup(f"trees {trees}", "")
        model = boosting.fit(df, ["a", "b"], "label", ["id"], boosting.Settings(n_estimators=trees, max_depth=1))
        assert len(model.trees) == trees
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup(f"trees {trees}"))

    try:
        assert jobs_of(8) - jobs_of(3) <= 5
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_search_and_fit_share_what_they_learn(mart, trained, monkeypatch):
    """The cuts of the training rows are fitted once, and a model by them is the one that fits its own."""
    model, _ = trained
    data = mart.read("gold", f"model_data_{model.version}")
    calls, fit_cuts = [], boosting.fit_cuts
    monkeypatch.setattr(boosting, "fit_cuts", lambda *a: calls.append(1) or fit_cuts(*a))
    again = training.train(data, config())
    assert len(calls) == 1 and again.model == model.model
    settings = boosting.changed(boosting.Settings(), **again.best_params)
    assert training.fit(data.where("split = 'train'"), model.features, config(), settings) == model.model
