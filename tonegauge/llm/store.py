"""Tables written to the folder that the whole cluster shares."""

import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """A new path under ``spark.checkpoint.dir``; where that is unset, under the warehouse folder, which is shared too."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        base = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_checkpoints"
    return f"{base.rstrip('/')}/llm-{uuid.uuid4().hex}"


def stored(df: DataFrame) -> DataFrame:
    """The rows written once and read back, so that no later reader computes them again and a lost executor loses nothing."""
    path = shared_folder(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def written(df: DataFrame) -> tuple[DataFrame, str]:
    """The same, and where the rows are, for who discards them again."""
    path = shared_folder(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def discard(spark: SparkSession, path: str) -> None:
    """Deletes what ``written`` wrote, once everything worked out from it is written itself."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def bucketed(df: DataFrame, key: str) -> DataFrame:
    """The rows written once in files by a hash of ``key``, so that joins on it leave them where they are."""
    spark = df.sparkSession
    name = f"bucketed_{uuid.uuid4().hex}"
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    df.write.bucketBy(buckets, key).sortBy(key).format("parquet").option("path", shared_folder(spark)).saveAsTable(name)
    found = spark.table(name)
    found.schema  # resolved: the files stay when the name goes
    spark.sql(f"DROP TABLE {name}")
    return found
