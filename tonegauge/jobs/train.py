"""Features to a classifier, optionally tuned and calibrated."""

import argparse
from datetime import datetime, timezone

from pyspark import StorageLevel
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from tonegauge.jobs import session
from tonegauge.operators import calibration, features, models
from tonegauge.operators.sentiment_model import SentimentModel
from tonegauge.sources import storage


def run(spark: SparkSession, output: str, tune: bool = False, now: datetime | None = None, **settings) -> None:
    rows = storage.load_features(spark, f"{output}/features")
    # every iteration of a fit reads the features again
    train = rows.filter(F.col("split") == "train").select("label", "classWeight", "features")
    train = train.persist(StorageLevel.MEMORY_AND_DISK)
    if tune:
        search, table = models.tune_lr(train)
        table.coalesce(1).write.mode("overwrite").parquet(f"{output}/tuning")
        classifier = search.bestModel
    else:
        classifier = models.train_lr(train, **settings)
    fitted = features.FeatureModel.load(spark, f"{output}/model/features")
    val = classifier.transform(rows.filter(F.col("split") == "val"))
    best = calibration.calibrate(val).first()
    model = SentimentModel(fitted, classifier, [best.t0, best.t1, best.t2])
    model.save(spark, f"{output}/model", with_features=False)
    models.training_history(spark, classifier).coalesce(1).write.mode("overwrite").parquet(f"{output}/history")
    meta = models.training_metadata(
        classifier, fitted.settings.num_features, now or datetime.now(timezone.utc)
    )
    storage.save_json(spark, meta, f"{output}/training_meta")
    train.unpersist()


def main(argv=None) -> None:
    args = argparse.ArgumentParser(description=__doc__)
    args.add_argument("--output", required=True, help="folder written by the preprocess job")
    args.add_argument("--tune", action="store_true")
    found = args.parse_args(argv)
    run(session("train sentiment model"), found.output, found.tune)


if __name__ == "__main__":
    main()
