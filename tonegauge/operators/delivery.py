"""End-to-end check of what was sent against what was predicted."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def delivery_check(sent: DataFrame, stored: DataFrame) -> DataFrame:
    """One row per sent Id: expected class, predicted class or ``not_found``, and whether they agree.

    Stored rows are narrowed to the sent ids and one per id before the join; the latest batch wins.
    """
    order = F.col("batch_id") if "batch_id" in stored.columns else F.lit(0)
    wanted = stored.join(sent.select("Id"), "Id", "left_semi")
    latest = wanted.groupBy("Id").agg(F.max(F.struct(order, F.col("PredictedSentiment"))).alias("_last"))
    found = latest.select("Id", F.col("_last.PredictedSentiment").alias("_name"), F.lit(True).alias("_found"))
    return sent.join(found, "Id", "left").select(
        "Id", "expected",
        F.coalesce("_name", F.lit("not_found")).alias("predicted"),
        F.coalesce("_found", F.lit(False)).alias("found"),
        F.coalesce(F.col("_name") == F.col("expected"), F.lit(False)).alias("agrees"),
    )
