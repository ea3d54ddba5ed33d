"""Predictions to the monthly table and the product scores."""

import argparse
from datetime import datetime, timezone

from pyspark.sql import SparkSession

from tonegauge.jobs import session
from tonegauge.operators import dashboard
from tonegauge.sources import storage
from tonegauge.streaming import scoring


def run(spark: SparkSession, predictions: str, results: str, now: datetime | None = None) -> str:
    now = now or datetime.now(timezone.utc)
    pred = scoring.read_predictions(spark, predictions)
    storage.replace_table(dashboard.monthly_sentiment(pred), f"{results}/monthly", now)
    storage.replace_table(dashboard.product_scoring(pred), f"{results}/products", now)
    monthly = storage.read_table(spark, f"{results}/monthly")
    products = storage.read_table(spark, f"{results}/products")
    return dashboard.aggregation_report(monthly, products).first()["report"]


def main(argv=None) -> None:
    args = argparse.ArgumentParser(description=__doc__)
    args.add_argument("--predictions", required=True)
    args.add_argument("--results", required=True)
    found = args.parse_args(argv)
    print(run(session("aggregate predictions"), found.predictions, found.results))


if __name__ == "__main__":
    main()
