"""Model data: assembly, splits, folds and scaling."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from creditmart.functions.dates import ModelWindows
from creditmart.operators.joins import lookup_join, require_unique
from creditmart.operators.ranking import hash_cutoffs, hash_rank, row_hash

ENTITY = ("Customer_ID", "snapshot_date")


def model_dataset(
    labels: DataFrame,
    features: DataFrame,
    windows: ModelWindows,
    how: str = "left",
    keys: Sequence[str] = ENTITY,
    snapshot: str = "snapshot_date",
    duplicates: bool = False,
) -> DataFrame:
    """Labels joined to features inside the model windows. Both sides are cut to the windows before
    the join; 'left' keeps labels without features. Several features of one key are an error, unless
    ``duplicates`` allows a row per pair."""
    known = features.where(windows.covers(F.col(snapshot)))
    if not duplicates:
        require_unique(known, keys)
    return lookup_join(labels.where(windows.covers(F.col(snapshot))), known, keys, how)


def oot_split(df: DataFrame, windows: ModelWindows, snapshot: str = "snapshot_date") -> DataFrame:
    """Add ``split``: 'train_test', 'oot', or NULL outside both windows."""
    return df.withColumn("split", windows.split_name(F.col(snapshot)))


def train_test_split(
    df: DataFrame, label: str, ids: Sequence[str], train_share: float = 0.8, seed: int = 88
) -> DataFrame:
    """Add ``split`` = 'train' or 'test': in each label class exactly round(share * rows) random rows
    train. ``ids`` must identify a row; rows without a label get no split. The split is a comparison with one cut-off per class, so the
    data itself is not shuffled."""
    cutoffs = hash_cutoffs(df, label, ids, seed, train_share)
    position = F.struct(row_hash(ids, seed).alias("h"), *[F.col(c) for c in ids])
    trains = F.lit(False)
    for value, (digest, *id_values) in cutoffs.items():
        cut = F.struct(
            F.lit(digest).alias("h"),
            *[F.lit(v).cast(df.schema[c].dataType).alias(c) for c, v in zip(ids, id_values)],
        )
        trains = trains | ((F.col(label) == F.lit(value)) & (position <= cut))
    return df.withColumn("split", F.when(trains, "train").when(F.col(label).isNotNull(), "test"))


def assign_folds(df: DataFrame, label: str, ids: Sequence[str], folds: int = 3, seed: int = 42) -> DataFrame:
    """Add ``fold`` in [0, folds): each label class is dealt out evenly in random order."""
    ranked = hash_rank(df, label, ids, seed, "_rank")
    return ranked.withColumn("fold", F.pmod(F.col("_rank") - 1, F.lit(folds)).cast("int")).drop("_rank")


def _known(name: str) -> Column:
    """The column as double, NaN as NULL."""
    c = F.col(name).cast("double")
    return F.when(~F.isnan(c), c)


def fit_scaler(train: DataFrame, columns: Sequence[str]) -> dict[str, tuple[float, float]]:
    """Mean and population standard deviation per column; a constant column gets scale 1."""
    row = train.agg(
        *[F.avg(_known(c)).alias(f"m{i}") for i, c in enumerate(columns)],
        *[F.when(F.min(_known(c)) < F.max(_known(c)), F.stddev_pop(_known(c))).alias(f"s{i}") for i, c in enumerate(columns)],
    ).first()
    return {c: (row[f"m{i}"] or 0.0, row[f"s{i}"] or 1.0) for i, c in enumerate(columns)}


def apply_scaler(df: DataFrame, params: Mapping[str, tuple[float, float]]) -> DataFrame:
    return df.withColumns({c: (_known(c) - F.lit(m)) / F.lit(s) for c, (m, s) in params.items()})


def split_summary(df: DataFrame, label: str = "label", split: str = "split") -> DataFrame:
    """Rows and mean label (2 decimals) per split."""
    return df.groupBy(split).agg(F.count(F.lit(1)).alias("n_rows"), F.round(F.avg(label), 2).alias("bad_rate"))
