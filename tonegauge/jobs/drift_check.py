"""Predictions to a new row of the drift history."""

import argparse
from datetime import datetime, timezone

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from tonegauge.jobs import session
from tonegauge.operators import drift
from tonegauge.sources import storage
from tonegauge.streaming import scoring


def run(spark: SparkSession, predictions: str, history: str, now: datetime | None = None) -> str:
    now = now or datetime.now(timezone.utc)
    status = drift.drift(scoring.read_predictions(spark, predictions))
    storage.append_history(status.withColumn("evaluated_at", F.lit(now.isoformat())), history)
    return drift.weekly_report(drift.latest_drift(spark.read.parquet(history))).first()["report"]


def main(argv=None) -> None:
    args = argparse.ArgumentParser(description=__doc__)
    args.add_argument("--predictions", required=True)
    args.add_argument("--history", required=True)
    found = args.parse_args(argv)
    print(run(session("check drift"), found.predictions, found.history))


if __name__ == "__main__":
    main()
