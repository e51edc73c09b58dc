"""Classification metrics as aggregations, exact on any number of rows.

One rule for all: a row whose score is NULL or NaN is not scored. No metric counts it; ``roc_auc`` and ``class_metrics``
report how many such rows there are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from creditmart.operators.ranking import running_totals
from creditmart.session import materialized


def _known(score: str) -> Column:
    """The score as double, NaN as NULL."""
    return F.nanvl(F.col(score).cast("double"), F.lit(None).cast("double"))


def _score_groups(df: DataFrame, score: str, label: str) -> DataFrame:
    """Positives and negatives per distinct score, and under NULL those of rows without one. Stored: what follows reads them
    several times, and the rows, which a model may have to score first, only once."""
    return materialized(
        df.groupBy(_known(score).alias("score")).agg(
            F.count(F.lit(1)).alias("n"),
            F.count(F.when(F.col(label) == 1, 1)).alias("pos"),
            F.count(F.when(F.col(label) == 0, 1)).alias("neg"),
        )
    )


def roc_auc(df: DataFrame, score: str = "score", label: str = "label") -> DataFrame:
    """One row: n_pos, n_neg, n_unscored and auc, the chance that a positive outscores a negative (ties half)."""
    wide = "decimal(38,0)"
    groups = _score_groups(df, score, label)
    unscored = groups.where("score is null").agg(F.coalesce(F.sum("n"), F.lit(0))).scalar()
    ranked = running_totals(groups, "score", ["neg"])
    twice_wins = F.col("pos").cast("decimal(19,0)") * (2 * F.col("neg_before") + F.col("neg")).cast("decimal(19,0)")
    totals = ranked.agg(
        F.sum("pos").alias("n_pos"), F.sum("neg").alias("n_neg"), F.sum(twice_wins.cast(wide)).alias("w")
    )
    pairs = F.col("n_pos").cast("double") * F.col("n_neg").cast("double")
    return totals.select("n_pos", "n_neg", unscored.alias("n_unscored"), F.try_divide(F.col("w").cast("double") / 2, pairs).alias("auc"))


def gini(df: DataFrame, score: str = "score", label: str = "label", scale: int = 3) -> DataFrame:
    return roc_auc(df, score, label).select(F.round(2 * F.col("auc") - 1, scale).alias("gini"))


def roc_curve(df: DataFrame, score: str = "score", label: str = "label", drop_intermediate: bool = True) -> DataFrame:
    """Points (fpr, tpr, threshold) from (0, 0, inf) to (1, 1), unordered.

    With ``drop_intermediate`` points between two equal steps, which lie on a straight line, are
    left out.
    """
    groups = _score_groups(df, score, label).where("score is not null").withColumn("down", -F.col("score"))
    steps = running_totals(groups, "down", ["pos", "neg"])
    totals = groups.agg(F.struct(F.sum("pos").alias("pos"), F.sum("neg").alias("neg")).alias("t")).scalar()
    if drop_intermediate:
        is_first = F.col("pos_before") + F.col("neg_before") == 0
        same_step = (F.col("pos") == F.col("pos_next")) & (F.col("neg") == F.col("neg_next"))
        steps = steps.where(is_first | ~F.coalesce(same_step, F.lit(False)))
    points = steps.select(
        (F.col("neg_before") + F.col("neg")).alias("fp"), (F.col("pos_before") + F.col("pos")).alias("tp"), "score"
    )
    origin = df.sparkSession.range(1).select(
        F.lit(0).cast("bigint").alias("fp"), F.lit(0).cast("bigint").alias("tp"), F.lit(float("inf")).alias("score")
    )
    return origin.unionByName(points).select(
        F.try_divide(F.col("fp").cast("double"), totals["neg"].cast("double")).alias("fpr"),
        F.try_divide(F.col("tp").cast("double"), totals["pos"].cast("double")).alias("tpr"),
        F.col("score").alias("threshold"),
    )


def _confusion(label: Column, predicted: Column) -> list[Column]:
    def rows(y: int, p: int, name: str) -> Column:
        return F.count(F.when((label == y) & (predicted == p), 1)).alias(name)

    return [rows(1, 1, "tp"), rows(0, 1, "fp"), rows(1, 0, "fn"), rows(0, 0, "tn")]


def _ratio(a: Column, b: Column) -> Column:
    """a / b, 0 when b is 0."""
    return F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))


def class_metrics(df: DataFrame, score: str = "score", label: str = "label", threshold: float = 0.5) -> DataFrame:
    """One row: accuracy, precision, recall and f1 of the classes predicted above the threshold, and n_unscored."""
    predicted = (_known(score) > threshold).cast("int")
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    unscored = F.count(F.when(_known(score).isNull(), 1)).alias("n_unscored")
    return df.agg(*_confusion(F.col(label), predicted), unscored).select(
        _ratio(tp + tn, tp + fp + fn + tn).alias("accuracy"),
        _ratio(tp, tp + fp).alias("precision"),
        _ratio(tp, tp + fn).alias("recall"),
        _ratio(2 * tp, 2 * tp + fp + fn).alias("f1"),
        "n_unscored",
    )


def balanced_accuracy(
    df: DataFrame, score: str = "score", label: str = "label", threshold: float = 0.5
) -> DataFrame:
    """One row: the mean recall of both classes, which is the AUC of the hard 0/1 predictions."""
    predicted = (_known(score) > threshold).cast("int")
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    return df.agg(*_confusion(F.col(label), predicted)).select(
        ((_ratio(tp, tp + fn) + _ratio(tn, tn + fp)) / 2).alias("balanced_accuracy")
    )
