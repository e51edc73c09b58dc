"""Model data, metrics, training and scoring."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from creditmart.catalog import tables as T
from creditmart.catalog.profile_queries import _rounded
from creditmart.catalog.registry import query
from creditmart.functions.dates import ModelWindows
from creditmart.operators import metrics, modelset
from creditmart.plans import boosting, gold, silver, training
from creditmart.session import materialized
from creditmart.sources.schemas import CLICKSTREAM_FEATURES

TRAIN_DATE = "1999-01-01"
WINDOWS = ModelWindows(TRAIN_DATE)
FEATURES = tuple(CLICKSTREAM_FEATURES)
IDS = ("loan_id",)


def _labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.label_store(silver.loan_daily(T.ledger(spark, sf_dir)), dpd=30, mob=6)


def _dataset(spark: SparkSession, sf_dir: str) -> DataFrame:
    features = T.clickstream(spark, sf_dir).select("Customer_ID", "snapshot_date", *FEATURES)
    return modelset.model_dataset(_labels(spark, sf_dir), features, WINDOWS)


LABELS_SQL = """, label_store AS (SELECT loan_id, Customer_ID,
    CAST(CASE WHEN dpd >= 30 THEN 1 ELSE 0 END AS INTEGER) AS label, '30dpd_6mob' AS label_def, snapshot_date
    FROM loan_daily WHERE mob = 6)"""
DATASET_SQL = (
    T.with_views("loan_daily", "clickstream")
    + LABELS_SQL
    + f""", data AS (SELECT l.*, {', '.join(f'c.{f}' for f in FEATURES)} FROM label_store l
    LEFT JOIN clickstream c USING (Customer_ID, snapshot_date)
    WHERE snapshot_date BETWEEN DATE '1997-11-01' AND DATE '1998-12-31'),
    split AS (SELECT *, CASE WHEN snapshot_date BETWEEN DATE '1998-11-01' AND DATE '1998-12-31' THEN 'oot'
    WHEN snapshot_date BETWEEN DATE '1997-11-01' AND DATE '1998-10-31' THEN 'train_test' END AS split FROM data) """
)


@query(DATASET_SQL + "SELECT * FROM data")
def model_dataset(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _dataset(spark, sf_dir)


@query(DATASET_SQL + "SELECT loan_id, snapshot_date, label, split FROM split")
def oot_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return modelset.oot_split(_dataset(spark, sf_dir), WINDOWS).select("loan_id", "snapshot_date", "label", "split")


@query(
    T.with_views("loan_daily")
    + LABELS_SQL
    + """SELECT loan_id, label, CASE WHEN row_number() OVER (PARTITION BY label ORDER BY md5(concat('88:', loan_id)),
    loan_id) <= round(0.8 * count(*) OVER (PARTITION BY label)) THEN 'train' ELSE 'test' END AS split
    FROM label_store"""
)
def stratified_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _labels(spark, sf_dir).select("loan_id", "label")
    return modelset.train_test_split(rows, "label", IDS)


@query(
    T.with_views("loan_daily")
    + LABELS_SQL
    + """SELECT loan_id, label, CAST((row_number() OVER (PARTITION BY label
    ORDER BY md5(concat('42:', loan_id)), loan_id) - 1) % 3 AS INTEGER) AS fold FROM label_store"""
)
def cv_folds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return modelset.assign_folds(_labels(spark, sf_dir).select("loan_id", "label"), "label", IDS)


@query(
    DATASET_SQL
    + "SELECT split, count(*) AS n_rows, round(avg(label), 2) AS bad_rate FROM split GROUP BY split"
)
def split_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return modelset.split_summary(modelset.oot_split(_dataset(spark, sf_dir), WINDOWS))


@query(
    DATASET_SQL
    + "SELECT loan_id, split, "
    + ", ".join(
        f"round((CAST({f} AS DOUBLE) - avg(CAST({f} AS DOUBLE)) FILTER (split = 'train_test') OVER ())"
        f" / stddev_pop(CAST({f} AS DOUBLE)) FILTER (split = 'train_test') OVER (), 6) AS {f}"
        for f in FEATURES
    )
    + " FROM split"
)
def standard_scale(spark: SparkSession, sf_dir: str) -> DataFrame:
    data = modelset.oot_split(_dataset(spark, sf_dir), WINDOWS).select("loan_id", "split", *FEATURES)
    fitted = modelset.fit_scaler(data.where("split = 'train_test'"), FEATURES)
    return _rounded(modelset.apply_scaler(data, fitted))


# Metrics, on the score of every ledger row

KNOWN_SQL = T.with_views("scored") + ", known AS (SELECT * FROM scored WHERE score IS NOT NULL AND NOT isnan(score))"
UNSCORED_SQL = "(SELECT count(*) FROM scored WHERE score IS NULL OR isnan(score)) AS n_unscored"
AUC_SQL = (
    KNOWN_SQL
    + """, g AS (SELECT score, sum(label) AS pos, sum(1 - label) AS neg FROM known GROUP BY score),
    c AS (SELECT *, coalesce(sum(neg) OVER (ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
    AS below FROM g), a AS (SELECT CAST(sum(pos) AS BIGINT) AS n_pos, CAST(sum(neg) AS BIGINT) AS n_neg,
    sum(pos * (2 * below + neg)) / 2.0 / (CAST(sum(pos) AS DOUBLE) * CAST(sum(neg) AS DOUBLE)) AS auc FROM c) """
)


@query(AUC_SQL + f"SELECT n_pos, n_neg, {UNSCORED_SQL}, round(CAST(auc AS DOUBLE), 9) AS auc FROM a")
def roc_auc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(metrics.roc_auc(T.scored(spark, sf_dir)), 9)


@query(AUC_SQL + "SELECT round(CAST(2 * auc - 1 AS DOUBLE), 3) AS gini FROM a")
def gini(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.gini(T.scored(spark, sf_dir))


@query(
    KNOWN_SQL
    + """, g AS (SELECT score, sum(label) AS pos, sum(1 - label) AS neg FROM known GROUP BY score),
    c AS (SELECT score, pos, neg, sum(neg) OVER w AS fp, sum(pos) OVER w AS tp, row_number() OVER w AS k,
    lead(pos) OVER w AS next_pos, lead(neg) OVER w AS next_neg FROM g WINDOW w AS (ORDER BY score DESC)),
    t AS (SELECT sum(pos) AS p, sum(neg) AS n FROM g)
    SELECT CAST(fp AS DOUBLE) / CAST(n AS DOUBLE) AS fpr, CAST(tp AS DOUBLE) / CAST(p AS DOUBLE) AS tpr,
    score AS threshold FROM c, t
    WHERE k = 1 OR next_pos IS NULL OR pos <> next_pos OR neg <> next_neg
    UNION ALL SELECT 0.0::DOUBLE, 0.0::DOUBLE, 'infinity'::DOUBLE"""
)
def roc_curve(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.roc_curve(T.scored(spark, sf_dir))


CONFUSION_SQL = (
    KNOWN_SQL
    + """, m AS (SELECT count(*) FILTER (label = 1 AND score > 0.5) AS tp, count(*) FILTER (label = 0 AND score > 0.5)
    AS fp, count(*) FILTER (label = 1 AND score <= 0.5) AS fn, count(*) FILTER (label = 0 AND score <= 0.5) AS tn
    FROM known) """
)


@query(
    CONFUSION_SQL
    + f"""SELECT (tp + tn) / CAST(tp + fp + fn + tn AS DOUBLE) AS accuracy, tp / CAST(tp + fp AS DOUBLE) AS precision,
    tp / CAST(tp + fn AS DOUBLE) AS recall, 2 * tp / CAST(2 * tp + fp + fn AS DOUBLE) AS f1, {UNSCORED_SQL} FROM m"""
)
def class_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.class_metrics(T.scored(spark, sf_dir))


@query(
    CONFUSION_SQL
    + """SELECT (tp / CAST(tp + fn AS DOUBLE) + tn / CAST(tn + fp AS DOUBLE)) / 2 AS balanced_accuracy FROM m"""
)
def balanced_accuracy(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.balanced_accuracy(T.scored(spark, sf_dir))


# Training: tree ensembles have no SQL form. SQL checks the rows, ids, labels, windows and rates; what only the ensemble
# determines is checked on its real results (an AUC above chance on the rows it learnt from, scores that are probabilities,
# importances that sum up to 1, tried points that differ and lie in the space).

CONFIG = training.TrainConfig(TRAIN_DATE)
PARTS_SQL = (
    DATASET_SQL
    + """, ranked AS (SELECT *, row_number() OVER (PARTITION BY label ORDER BY md5(concat('88:', loan_id)), loan_id)
    <= round(0.8 * count(*) OVER (PARTITION BY label)) AS trains FROM split WHERE split = 'train_test'),
    parts AS (SELECT loan_id, snapshot_date, label, CASE WHEN trains THEN 'train' ELSE 'test' END AS part FROM ranked
    UNION ALL SELECT loan_id, snapshot_date, label, split FROM split WHERE split = 'oot') """
)


def _prepared(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Model data, written once as a table so that the many passes of training read it back."""
    path = f"{T.scratch_root(spark)}/model_data"
    training.prepare(_labels(spark, sf_dir), T.clickstream(spark, sf_dir), CONFIG).write.parquet(path)
    return spark.read.parquet(path)


def _fitted(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, list[str], boosting.Boosted]:
    """Model data, features, and a model of as many trees as the search tries at most."""
    data = _prepared(spark, sf_dir)
    features = CONFIG.features(data)
    train = data.where("split = 'train'")
    settings = boosting.Settings(n_estimators=50, max_depth=3, learning_rate=0.1, subsample=0.8)
    return data, features, training.fit(train, features, CONFIG, settings)


@query(
    PARTS_SQL
    + """SELECT part AS split, count(*) FILTER (label = 1) AS n_pos, count(*) FILTER (label = 0) AS n_neg,
    CAST(0 AS BIGINT) AS n_unscored, true AS auc_plausible FROM parts GROUP BY part"""
)
def gbt_train(spark: SparkSession, sf_dir: str) -> DataFrame:
    data, _, model = _fitted(spark, sf_dir)
    scored = training.score(model, data).select("split", "label", "score")
    parts = None
    for name, least in (("train", 0.5), ("test", 0.0), ("oot", 0.0)):
        one = metrics.roc_auc(scored.where(F.col("split") == name)).withColumn("split", F.lit(name))
        plausible = (F.col("auc") > least) & (F.col("auc") <= 1)
        one = one.select("split", "n_pos", "n_neg", "n_unscored", plausible.alias("auc_plausible"))
        parts = one if parts is None else parts.unionByName(one)
    return parts


@query(PARTS_SQL + "SELECT loan_id, snapshot_date, label, true AS is_probability FROM parts WHERE part = 'oot'")
def batch_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    data, _, model = _fitted(spark, sf_dir)
    scored = training.score(model, data.where("split = 'oot'"))
    return scored.select("loan_id", "snapshot_date", "label", F.col("score").between(0, 1).alias("is_probability"))


@query(
    PARTS_SQL
    + f"""SELECT unnest({list(FEATURES)}) AS feature, 1.0::DOUBLE AS total, true AS is_share, count(*) AS n_train
    FROM parts WHERE part = 'train'"""
)
def feature_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    data, features, model = _fitted(spark, sf_dir)
    found = training.feature_importance(model, features)
    total = found.agg(F.round(F.sum("importance"), 9)).scalar()
    share = F.col("importance").between(0, 1)
    n_train = data.where("split = 'train'").agg(F.count(F.lit(1))).scalar()
    return found.select("feature", total.alias("total"), share.alias("is_share"), n_train.alias("n_train"))


@query(
    PARTS_SQL
    + """SELECT CAST(10 AS BIGINT) AS n_points, CAST(10 AS BIGINT) AS n_in_space, CAST(10 AS BIGINT) AS n_scored,
    count(*) AS n_train FROM parts WHERE part = 'train'"""
)
def random_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    data = _prepared(spark, sf_dir)
    train = data.where("split = 'train'")
    found = training.search_results(training.random_search(train, CONFIG.features(data), CONFIG))
    inside = F.lit(True)
    for name, values in CONFIG.space.items():
        inside = inside & F.col("params")[name].isin([str(v) for v in values])
    n_train = train.agg(F.count(F.lit(1))).scalar()
    return found.agg(
        F.countDistinct(*[F.col("params")[name] for name in CONFIG.space]).alias("n_points"),
        F.count(F.when(inside, 1)).alias("n_in_space"),
        F.count(F.when(F.col("score").between(0, 1), 1)).alias("n_scored"),
    ).withColumn("n_train", n_train)


@query(
    PARTS_SQL
    + """SELECT 'credit_model_1999_01_01' AS model_version, DATE '1999-01-01' AS model_train_date,
    DATE '1997-11-01' AS train_test_start_date, DATE '1998-10-31' AS train_test_end_date,
    DATE '1998-11-01' AS oot_start_date, DATE '1998-12-31' AS oot_end_date, """
    + ", ".join(
        f"count(*) FILTER (part = '{p}') AS n_{p}, round(avg(label) FILTER (part = '{p}'), 2) AS bad_rate_{p}"
        for p in ("train", "test", "oot")
    )
    + f", '{','.join(FEATURES)}' AS features, CAST({len(training.SEARCH_SPACE)} AS INTEGER) AS n_params,"
    + " true AS scores_plausible FROM parts"
)
def model_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = training.metadata(training.train(_prepared(spark, sf_dir), CONFIG))
    plausible = (F.col("auc_train") > 0.5) & F.col("auc_train").between(0, 1)
    for part in ("train", "test", "oot"):
        auc = F.col(f"auc_{part}")
        plausible = plausible & auc.between(0, 1) & (F.col(f"gini_{part}") == F.round(2 * auc - 1, 3))
    plausible = plausible & F.col("cv_score").between(0, 1)
    shown = [c for c in found.columns if not c.startswith(("auc_", "gini_", "cv_", "hp_"))]
    return found.select(
        *[F.array_join(c, ",").alias(c) if c == "features" else c for c in shown],
        F.size("hp_params").alias("n_params"), plausible.alias("scores_plausible"),
    )


# The first tree of the boosting, level by level: bins, gradients, both sides for missing values and regularised gains in SQL.
LEVELS = boosting.Settings(n_estimators=1, max_depth=2, gamma=0.1, min_child_weight=3, reg_alpha=0.1, reg_lambda=1.5)
LEVEL_BINS = 16


def _strength(g: str, h: str) -> str:
    return f"power(greatest(abs({g}) - {LEVELS.reg_alpha}, 0), 2) / ({h} + {LEVELS.reg_lambda})"


def _level_sql(rows: str, name: str) -> str:
    """Best split (`node`, `f`, `bin`, `missing_right`, `gain`) of each node of `rows`, as further views."""
    gain = f"{_strength('gl', 'hl')} + {_strength('g - gl', 'h - hl')} - {_strength('g', 'h')}"
    return f"""{name}_sums AS (SELECT node, f, bin, sum(gq) / 16777216.0 AS gb, sum(hq) / 16777216.0 AS hb FROM {rows} GROUP BY ALL),
    {name}_upto AS (SELECT *, sum(gb) OVER c AS g, sum(hb) OVER c AS h, coalesce(sum(gb) FILTER (bin < 0) OVER c, 0) AS gm,
    coalesce(sum(hb) FILTER (bin < 0) OVER c, 0) AS hm, coalesce(sum(gb) FILTER (bin >= 0) OVER u, 0) AS gr,
    coalesce(sum(hb) FILTER (bin >= 0) OVER u, 0) AS hr FROM {name}_sums
    WINDOW c AS (PARTITION BY node, f), u AS (PARTITION BY node, f ORDER BY bin ROWS UNBOUNDED PRECEDING)),
    {name}_sides AS (SELECT node, f, bin, g, h, missing_right, CASE WHEN missing_right THEN gr ELSE gr + gm END AS gl,
    CASE WHEN missing_right THEN hr ELSE hr + hm END AS hl FROM {name}_upto, (VALUES (true), (false)) AS s(missing_right) WHERE bin >= 0),
    {name} AS (SELECT node, f, bin, missing_right, gain FROM (SELECT *, {gain} AS gain FROM {name}_sides)
    WHERE least(hl, h - hl) >= {LEVELS.min_child_weight} AND gain >= {LEVELS.gamma}
    QUALIFY row_number() OVER (PARTITION BY node ORDER BY round(gain, 9) DESC, f, bin, missing_right DESC) = 1)"""


LEVELS_SQL = (
    DATASET_SQL
    + f""", known AS (SELECT loan_id, label, [{', '.join(f'CAST({f} AS DOUBLE)' for f in FEATURES)}] AS vs FROM data WHERE label IS NOT NULL),
    cells AS (SELECT loan_id, label, generate_subscripts(vs, 1) - 1 AS f, unnest(vs) AS v FROM known),
    cuts AS (SELECT f, unnest(list_distinct(quantile_disc(v, {[i / LEVEL_BINS for i in range(1, LEVEL_BINS)]}))) AS cut FROM cells GROUP BY f),
    b AS (SELECT ln(sum(label) / sum(1 - label)) AS base FROM known),
    binned AS (SELECT loan_id, label, c.f, CASE WHEN v IS NULL THEN -1 ELSE count(cut) FILTER (cut <= v) END AS bin
    FROM cells c LEFT JOIN cuts USING (f) GROUP BY loan_id, label, c.f, v),
    given AS (SELECT loan_id, 0 AS node, f, bin, CAST(round((1 / (1 + exp(-base)) - label) * 16777216) AS BIGINT) AS gq,
    CAST(round(1 / (1 + exp(-base)) * (1 - 1 / (1 + exp(-base))) * 16777216) AS BIGINT) AS hq FROM binned, b),
    {_level_sql('given', 'root')},
    gone AS (SELECT loan_id, CASE WHEN g.bin < 0 THEN CAST(missing_right AS INT) WHEN g.bin > r.bin THEN 1 ELSE 0 END + 1 AS node
    FROM given g JOIN root r USING (f)),
    second AS (SELECT loan_id, o.node, f, bin, gq, hq FROM given JOIN gone o USING (loan_id)),
    {_level_sql('second', 'leaves')}, """
)


@query(
    LEVELS_SQL
    + f"""named AS (SELECT *, row_number() OVER (PARTITION BY f ORDER BY cut) - 1 AS bin FROM cuts)
    SELECT CAST(node AS INTEGER) AS node, {list(FEATURES)}[f + 1] AS feature, CAST(s.bin AS INTEGER) AS bin, coalesce(cut, 'infinity'::DOUBLE) AS cut,
    missing_right, round(gain, 6) AS gain FROM (SELECT * FROM root UNION ALL SELECT * FROM leaves) s LEFT JOIN named USING (f, bin)"""
)
def boosted_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The splits of a regularised tree of two levels on the model data: feature, bin, cut, the side of missing values, gain."""
    data = materialized(_dataset(spark, sf_dir))
    model = boosting.fit(data, FEATURES, "label", IDS, LEVELS, bins=LEVEL_BINS)
    splits = [(n, v.feature, v.bin, v.cut, v.missing_right, v.gain) for n, v in model.trees[0].items() if v.feature is not None]
    found = spark.createDataFrame(splits, "node int, feature string, bin int, cut double, missing_right boolean, gain double")
    return found.withColumn("gain", F.round("gain", 6))


@query(
    LEVELS_SQL
    + f"""lower AS (SELECT s.loan_id, s.node, CASE WHEN l.f IS NULL THEN s.node ELSE 2 * s.node + 1
    + CASE WHEN s.bin < 0 THEN CAST(missing_right AS INT) WHEN s.bin > l.bin THEN 1 ELSE 0 END END AS leaf
    FROM second s LEFT JOIN leaves l ON s.node = l.node WHERE s.f = coalesce(l.f, 0)),
    weights AS (SELECT leaf, sum(gq) / 16777216.0 AS g, sum(hq) / 16777216.0 AS h FROM lower JOIN (SELECT loan_id, gq, hq FROM given WHERE f = 0) USING (loan_id)
    GROUP BY leaf),
    scored AS (SELECT leaf, -sign(g) * greatest(abs(g) - {LEVELS.reg_alpha}, 0) / (h + {LEVELS.reg_lambda}) * {LEVELS.learning_rate} AS w FROM weights)
    SELECT loan_id, round(1 / (1 + exp(-(base + w))), 6) AS score FROM lower JOIN scored USING (leaf), b"""
)
def boosted_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every loan's probability by that tree, stored and read back: leaves' weights and the way down to them in SQL."""
    data = materialized(_dataset(spark, sf_dir))
    path = f"{T.scratch_root(spark)}/model"
    boosting.fit(data, FEATURES, "label", IDS, LEVELS, bins=LEVEL_BINS).save(spark, path)
    scored = training.score(boosting.Boosted.load(spark, path), data.where("label IS NOT NULL"))
    return scored.select("loan_id", F.round("score", 6).alias("score"))
