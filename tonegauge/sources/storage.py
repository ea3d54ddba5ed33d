"""Result tables, models' sidecar files and the insight document."""

import json
import uuid
from datetime import datetime

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tonegauge import schemas


def shared_dir(spark: SparkSession, purpose: str) -> str:
    """A new folder path under ``spark.checkpoint.dir``, which every executor can reach; where that is unset, under the
    warehouse folder, which is shared too."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        base = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_checkpoints"
    return f"{base.rstrip('/')}/tonegauge/{purpose}-{uuid.uuid4().hex}"


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """The rows written to a new shared folder and read back: later readers do not compute them again, and
    losing an executor loses nothing."""
    path = shared_dir(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def save_features(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def load_features(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def save_splits(df: DataFrame, path: str) -> None:
    """One CSV folder per value of ``split``, written in a single pass and in parallel."""
    (
        df.write.mode("overwrite").partitionBy("split")
        .option("header", True).option("escape", '"').csv(path)
    )


def save_json(spark: SparkSession, document: dict, path: str) -> None:
    """A small document (training metadata, thresholds, insight) as one JSON line."""
    text = json.dumps(document, ensure_ascii=False)
    spark.range(1).select(F.lit(text).alias("value")).coalesce(1).write.mode("overwrite").text(path)


def load_json(spark: SparkSession, path: str) -> dict:
    return json.loads(spark.read.text(path, wholetext=True).first()["value"])


def replace_table(df: DataFrame, path: str, now: datetime) -> None:
    """Replaces a result table, stamped ``aggregated_at``.

    The new rows go to a version folder of their own. Only after they are complete one row is added to the
    list of versions, so a reader sees the old table or the new one and never an empty or half-written one. Old versions
    are removed, but for the last few.
    """
    spark = df.sparkSession
    version = f"{now:%Y%m%dT%H%M%S%f}-{uuid.uuid4().hex}"
    stamped = df.withColumn("aggregated_at", F.lit(now.strftime("%Y-%m-%d %H:%M:%S.%f")).cast("timestamp_ntz"))
    stamped.write.mode("overwrite").parquet(f"{path}/data/v={version}")
    entry = spark.range(1).select(F.lit(version).alias("version"))
    entry.coalesce(1).write.mode("append").json(f"{path}/versions")
    _forget(spark, f"{path}/data", KEPT)
    _forget(spark, f"{path}/versions", 2 * KEPT)


#: Versions that stay, for readers that began before the newest was complete.
KEPT = 5


def _forget(spark: SparkSession, path: str, keep: int) -> None:
    """Deletes all but the newest entries of a folder of versions."""
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(path)
    fs = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    listed = [(x.getModificationTime(), x.getPath().getName(), x.getPath()) for x in fs.listStatus(folder)]
    entries = sorted((x for x in listed if not x[1].startswith(("_", "."))), key=lambda x: x[:2])
    for _, _, old in entries[:-keep]:
        fs.delete(old, True)


def read_table(spark: SparkSession, path: str) -> DataFrame | None:
    """The newest complete version of a result table; None before the first."""
    try:
        listed = spark.read.schema("version string").json(f"{path}/versions")
    except AnalysisException:
        return None
    newest = listed.agg(F.max("version")).first()[0]
    return spark.read.parquet(f"{path}/data/v={newest}")


def append_history(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


def ingest_insight(spark: SparkSession, path: str, now: datetime) -> DataFrame:
    """One insight row from a JSON document.

    No document gives status ``missing`` and the error ``missing_file``, a broken one ``invalid_json``.
    Metadata is lifted from the top level when the document has no metadata field.
    """
    try:
        found = spark.read.text(path, wholetext=True)
    except AnalysisException:
        found = spark.createDataFrame([], "value string")
    # a global aggregate gives one row also when the file is missing
    text = found.agg(F.max("value").alias("value"))
    return parsed_insights(text, F.lit(path), F.lit(now.isoformat()))


def parsed_insights(texts: DataFrame, path: Column, otherwise: Column) -> DataFrame:
    """One insight row for each text in ``value``; ``otherwise`` is the time of documents that name none. Null is no document."""
    schema = f"{schemas.INSIGHT}, _bad string"
    parsed = texts.select(
        "value", path.alias("_path"), otherwise.alias("_otherwise"),
        F.from_json("value", schema, {"columnNameOfCorruptRecord": "_bad"}).alias("d"),
    )
    missing = F.col("value").isNull()
    broken = ~missing & (F.col("d").isNull() | F.col("d._bad").isNotNull())
    usable = ~missing & ~broken

    def kept(field: str):
        return F.when(usable, F.col(f"d.{field}"))

    lifted = F.struct(*[
        kept(c).alias(c)
        for c in ["model_name", "model_version", "trained_at", "dataset", "notes", "parameters"]
    ])
    errors = F.when(missing, F.array(F.lit("missing_file"))).when(
        broken, F.array(F.lit("invalid_json: not a JSON object"))
    ).otherwise(F.array().cast("array<string>"))
    return parsed.select(
        F.coalesce(kept("evaluated_at"), F.col("_otherwise")).alias("evaluated_at"),
        F.when(usable, F.lit("ok")).otherwise(F.lit("missing")).alias("status"),
        kept("metrics").alias("metrics"),
        kept("confusion_matrix").alias("confusion_matrix"),
        F.coalesce(kept("metadata"), lifted).alias("metadata"),
        F.create_map(F.lit("path"), F.col("_path")).alias("source"),
        errors.alias("errors"),
    )
