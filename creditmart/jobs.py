"""Command line: ``spark-submit`` this file, or ``python -m creditmart.jobs``.

    --stage bronze --snapshotdate 2024-01-01            one snapshot of the loan ledger
    --stage backfill --start 2023-01-01 --end 2025-01-01  every layer for those months
    --stage train --snapshotdate 2024-09-01             train, evaluate and store the model
        --features feature_store --join inner           on the gold feature store instead of the clickstream
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame

from creditmart.functions.dates import month_starts
from creditmart.plans import training
from creditmart.plans.datamart_jobs import Build
from creditmart.session import builder, shared_folder
from creditmart.sources.datamart import Datamart


def train_model(build: Build, config: training.TrainConfig, bank: str) -> training.Trained:
    """Write the model data as a table, train on that, store the model, and check that the stored
    one scores alike."""
    labels = build.mart.read("gold", "label_store")
    features = model_features(build, config)
    mart = build.mart
    mart.write_static(training.prepare(labels, features, config), "gold", f"model_data_{config.version}")
    data = mart.read("gold", f"model_data_{config.version}")
    trained = training.train(data, config)
    training.save(trained, bank)
    stored, _ = training.load(build.spark, bank, trained.version)
    again = training.evaluate(stored, data, config)
    if again["oot"] != trained.auc["oot"]:
        raise RuntimeError(f"stored model scores {again['oot']}, trained one {trained.auc['oot']}")
    return trained


def model_features(build: Build, config: training.TrainConfig) -> DataFrame:
    """Features per customer and snapshot: the clickstream's, or the whole feature store's when no
    prefix limits them."""
    if config.feature_prefix is None:
        return build.mart.read("gold", "feature_store", merge_schema=True)
    return build.mart.read("silver", "clickstream")


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description="credit-risk datamart and model jobs")
    parser.add_argument("--stage", choices=["bronze", "backfill", "train"], default="bronze")
    parser.add_argument("--snapshotdate", help="YYYY-MM-DD")
    parser.add_argument("--start", help="first month, YYYY-MM-DD")
    parser.add_argument("--end", help="last month, YYYY-MM-DD")
    parser.add_argument("--source", default="data")
    parser.add_argument("--datamart", default="datamart")
    parser.add_argument("--model-bank", default="model_bank")
    parser.add_argument("--dpd", type=int, default=60)
    parser.add_argument("--mob", type=int, default=6)
    parser.add_argument("--n-iter", type=int, default=100)
    parser.add_argument("--features", choices=["clickstream", "feature_store"], default="clickstream")
    parser.add_argument("--join", choices=["left", "inner"], default="left")
    parser.add_argument("--as-of", action="store_true", help="feature store: features not dated after the row")
    parser.add_argument("--duplicates", action="store_true", help="feature store: allow several feature rows per customer")
    parser.add_argument("--fitted", help="YYYY-MM-DD: customer caps, medians and vocabularies stored under that date; fitted and stored if there are none")
    parser.add_argument("--score", choices=["auc", "hard_label_auc"], default="auc", help="train: what the search maximises")
    args = parser.parse_args(argv)
    if args.stage == "backfill" and not (args.start and args.end):
        parser.error("--stage backfill needs --start and --end")
    if args.stage != "backfill" and not args.snapshotdate:
        parser.error(f"--stage {args.stage} needs --snapshotdate")

    spark = builder(f"creditmart-{args.stage}").getOrCreate()
    build = Build(
        spark, args.source, Datamart(spark, args.datamart), args.dpd, args.mob, args.end,
        as_of=args.as_of, duplicates=args.duplicates, fitted=args.fitted,
    )
    if args.stage == "bronze":
        print(build.bronze([args.snapshotdate], ["lms"]))
    elif args.stage == "backfill":
        for table, rows in build.backfill(month_starts(args.start, args.end)).items():
            print(f"{table}: {rows} rows")
    else:
        # Boosting cuts its lineage there every few trees.
        shared_folder(spark, f"{args.datamart.rstrip('/')}/_checkpoints")
        prefix = "fe_" if args.features == "clickstream" else None
        config = training.TrainConfig(
            args.snapshotdate, n_iter=args.n_iter, join=args.join, feature_prefix=prefix, hard_label=args.score == "hard_label_auc"
        )
        trained = train_model(build, config, args.model_bank)
        print(trained.version, trained.best_params, trained.auc)


if __name__ == "__main__":
    main()
