"""Insight documents as a stream of files.

A document is a folder with one JSON file, as the evaluation job writes it, and its name is that of the folder. Each file gives one
row, broken ones with their error, and is taken in once: batches go through the commit log. The newest whole document is
chosen by the time it states, so files that come late or out of order do not hide a newer one.
"""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tonegauge.functions import clock
from tonegauge.sources import storage
from tonegauge.streaming import commits

# a stated time ends in a zone, or it is UTC
_ZONED = r"(Z|[+-]\d{2}:?\d{2})$"


def _name(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -2)


def documents(spark: SparkSession, folder: str, per_trigger: int | None = None) -> DataFrame:
    """value, path and time of arrival of every document under a folder, as a stream."""
    reader = spark.readStream.schema("value string").option("wholetext", True).option("recursiveFileLookup", True)
    if per_trigger:
        reader = reader.option("maxFilesPerTrigger", per_trigger)
    return reader.format("text").load(folder).select(
        "value", F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_modification_time").alias("arrived")
    )


def rows(texts: DataFrame) -> DataFrame:
    """Insight rows with the name of their document. A broken document has the time of its arrival, the same in a replay."""
    arrived = F.concat(F.replace(clock.event_time(F.unix_seconds("arrived")), F.lit(" "), F.lit("T")), F.lit("Z"))
    parsed = storage.parsed_insights(texts, F.col("path"), arrived)
    return parsed.withColumn("document", _name(F.element_at("source", "path")))


def take_in(texts: DataFrame, target: str, checkpoint: str, run: str = "insights", **trigger):
    """Starts the query that adds each document's row to the table at ``target``."""

    def batch(df: DataFrame, batch_id: int) -> None:
        commits.write(rows(df), target, run, batch_id)

    trigger = trigger or {"availableNow": True}
    return texts.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(**trigger).start()


def history(spark: SparkSession, target: str) -> DataFrame:
    """The rows of all documents taken in; none before the first."""
    empty = rows(spark.createDataFrame([], "value string, path string, arrived timestamp"))
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in empty.schema.fields)
    return commits.read(spark, target, fields).select(*empty.columns)


def with_missing(found: DataFrame, expected: DataFrame, now: str) -> DataFrame:
    """Adds a ``missing`` row for each expected ``document`` that has not come, stated as of ``now``."""
    gone = expected.select("document").distinct().join(found, "document", "left_anti")
    absent = storage.parsed_insights(
        gone.select(F.lit(None).cast("string").alias("value"), F.col("document").alias("path")), F.col("path"), F.lit(now)
    )
    return found.unionByName(absent.withColumn("document", F.element_at("source", "path")))


def latest(found: DataFrame) -> DataFrame:
    """The whole document with the newest time it states, ties by name; status ``no_data`` before the first."""
    stated = F.col("evaluated_at")
    zoned = F.when(stated.rlike(_ZONED), stated).otherwise(F.concat(stated, F.lit("Z")))
    time = F.coalesce(F.try_to_timestamp(zoned), F.timestamp_seconds(F.lit(0)))
    order = F.struct(time, F.col("document"))
    newest = found.filter(F.col("status") == "ok").agg(F.max_by(F.struct("*"), order).alias("d"))
    columns = [c for c in found.columns if c != "status"]
    return newest.select(
        *[F.col(f"d.{c}").alias(c) for c in columns], F.coalesce("d.status", F.lit("no_data")).alias("status")
    )
