"""Review files to a topic or message folder, at a rate of rows a second."""

import argparse
import time

from pyspark.sql import SparkSession

from tonegauge import schemas
from tonegauge.jobs import session
from tonegauge.sources import csv_records, reviews
from tonegauge.streaming import replay


def run(
    spark: SparkSession, source: str, target: str, checkpoint: str, rate: float = 10.0, limit: int = 0, brokers: str | None = None,
    now: int | None = None, interval: float = 1.0, seconds: float | None = None,
) -> bool:
    """Whether all rows are sent. An empty Id becomes ``TEST_`` and the row's place, an empty Time becomes ``now``."""
    fmt, options = ("kafka", {"kafka.bootstrap.servers": brokers}) if brokers else ("text", {})
    rows = csv_records.read(spark, source, schemas.MESSAGE, position=True)
    messages = reviews.to_messages(rows, int(time.time()) if now is None else now, "position", keep=["number"])
    done = replay.start_paced(messages, checkpoint, rate, replay.to_topic(target, fmt, options), limit, interval)
    try:
        return done.wait(seconds)
    finally:
        done.stop()


def main(argv=None) -> None:
    args = argparse.ArgumentParser(description=__doc__)
    args.add_argument("--source", required=True, help="CSV files of reviews")
    args.add_argument("--target", required=True, help="topic, or folder for JSON lines")
    args.add_argument("--checkpoint", required=True)
    args.add_argument("--rate", type=float, default=10.0, help="rows a second")
    args.add_argument("--limit", type=int, default=0, help="rows to send, 0 for all")
    args.add_argument("--brokers", help="send to a topic of these brokers (needs the connector jar)")
    f = args.parse_args(argv)
    run(session("publish reviews"), f.source, f.target, f.checkpoint, f.rate, f.limit, f.brokers)


if __name__ == "__main__":
    main()
