"""Live tables kept by streams over the predictions."""

from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tonegauge import schemas
from tonegauge.operators import dashboard
from tonegauge.sources import reviews, storage

RECENT_COLUMNS = ["Id", "ProductId", "ProfileName", "Score", "PredictedSentiment", "Summary", "ProcessingTime"]


def _start(stream: DataFrame, handle, mode: str, checkpoint: str, trigger: dict | None) -> StreamingQuery:
    return (
        stream.writeStream.foreachBatch(handle).outputMode(mode)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": "2 seconds"}))
        .start()
    )


def start_monthly(
    predictions: DataFrame, path: str, checkpoint: str, trigger: dict | None = None
) -> StreamingQuery:
    """Keeps the monthly table current, by default every two seconds.

    The state holds one row per month and class, so it stays small without a watermark and late rows count.
    The overall statistics and the trend follow from this table.
    """
    def replace(batch: DataFrame, batch_id: int) -> None:
        # a shuffle of its few rows: coalesced, all partitions of the state would be updated by one task, one after the other
        storage.replace_table(batch.repartition(1), path, datetime.now(timezone.utc))

    return _start(dashboard.monthly_sentiment(predictions), replace, "complete", checkpoint, trigger)


def start_recent(
    predictions: DataFrame, path: str, checkpoint: str, n: int = 50, trigger: dict | None = None
) -> StreamingQuery:
    """Keeps the ``n`` newest predictions: the top of each batch is merged with the table so far."""
    def merge(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        named = batch.filter(F.col("PredictedSentiment").isNotNull())
        rows = named.select(*RECENT_COLUMNS, F.lit(batch_id).cast("bigint").alias("batch_id"))
        rows = rows.orderBy(*dashboard.newest_first()).limit(n)
        known = storage.read_table(spark, path)
        if known is not None:
            # rows of a replayed batch are taken out first
            rows = rows.unionByName(known.filter(F.col("batch_id") != batch_id).select(*rows.columns))
        newest = rows.orderBy(F.desc("batch_id"), *dashboard.newest_first()).limit(n)
        storage.replace_table(newest.coalesce(1), path, datetime.now(timezone.utc))

    return _start(predictions, merge, "append", checkpoint, trigger)


def live_stats(spark: SparkSession, path: str) -> DataFrame:
    """Overall statistics from the live monthly table; zeros before its first version."""
    return dashboard.overall_from_monthly(_monthly(spark, path))


def live_trend(spark: SparkSession, path: str) -> DataFrame:
    return dashboard.trend_from_monthly(_monthly(spark, path))


def _monthly(spark: SparkSession, path: str) -> DataFrame:
    found = storage.read_table(spark, path)
    return spark.createDataFrame([], schemas.MONTHLY) if found is None else found


def replay(spark: SparkSession, path: str, files_per_batch: int = 1) -> DataFrame:
    """Review files as a stream of JSON messages, a few files per batch."""
    files = (
        spark.readStream.schema(schemas.MESSAGE).option("header", True).option("multiLine", True)
        .option("escape", '"').option("maxFilesPerTrigger", files_per_batch).csv(path)
    )
    return reviews.as_json(files)
