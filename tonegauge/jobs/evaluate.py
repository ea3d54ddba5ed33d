"""Classifier and test features to the insight document and its history."""

import argparse
from datetime import datetime, timezone

from pyspark.errors import AnalysisException
from pyspark.ml.classification import LogisticRegressionModel
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from tonegauge.jobs import session
from tonegauge.operators import metrics, models
from tonegauge.sources import storage


def run(spark: SparkSession, output: str, history: str | None = None, now: datetime | None = None) -> None:
    now = now or datetime.now(timezone.utc)
    test = storage.load_features(spark, f"{output}/features").filter(F.col("split") == "test")
    pred = models.score(LogisticRegressionModel.load(f"{output}/model/classifier"), test)
    try:
        meta = storage.load_json(spark, f"{output}/training_meta")
    except AnalysisException:
        meta = {"model_name": models.MODEL_NAME, "model_version": models.MODEL_VERSION}
    meta["dataset"] = "test features (10% split)"
    meta["notes"] = "Final evaluation on the test split ({rows} rows)"
    path = f"{output}/model_insights"
    metrics.insight(pred, meta, now).coalesce(1).write.mode("overwrite").json(path)
    if history:
        storage.append_history(storage.ingest_insight(spark, path, now), history)


def main(argv=None) -> None:
    args = argparse.ArgumentParser(description=__doc__)
    args.add_argument("--output", required=True)
    args.add_argument("--history", help="table of insight documents to append to")
    found = args.parse_args(argv)
    run(session("evaluate sentiment model"), found.output, found.history)


if __name__ == "__main__":
    main()
