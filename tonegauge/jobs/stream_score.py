"""Topic or message folder to the prediction table, until stopped."""

import argparse

from tonegauge.jobs import session
from tonegauge.operators.sentiment_model import SentimentModel
from tonegauge.sources import reviews
from tonegauge.streaming import scoring


def run(spark, model: str, source: str, predictions: str, checkpoint: str, brokers: str | None = None,
        calibrated: bool = False, trigger: dict | None = None):
    fmt, options = ("kafka", {"kafka.bootstrap.servers": brokers}) if brokers else ("text", {})
    messages = reviews.message_stream(spark, source, fmt, options)
    return scoring.start_scoring(
        messages, SentimentModel.load(spark, model), predictions, checkpoint, calibrated, trigger
    )


def main(argv=None) -> None:
    args = argparse.ArgumentParser(description=__doc__)
    args.add_argument("--model", required=True)
    args.add_argument("--source", required=True, help="topic, or folder of JSON lines")
    args.add_argument("--predictions", required=True)
    args.add_argument("--checkpoint", required=True)
    args.add_argument("--brokers", help="read a topic of these brokers (needs the connector jar)")
    args.add_argument("--calibrated", action="store_true")
    f = args.parse_args(argv)
    run(session("score review stream"), f.model, f.source, f.predictions, f.checkpoint, f.brokers,
        f.calibrated).awaitTermination()


if __name__ == "__main__":
    main()
