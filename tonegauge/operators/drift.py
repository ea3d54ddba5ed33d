"""Check of the distribution of predicted classes."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tonegauge.functions import numbers
from tonegauge.operators import dashboard

# Alert above these shares, no check below this many predictions.
NEUTRAL_LIMIT = 0.30
NEGATIVE_LIMIT = 0.40
MINIMUM = 100


def with_drift(
    counts: DataFrame, neutral: float = NEUTRAL_LIMIT, negative: float = NEGATIVE_LIMIT, minimum: int = MINIMUM
) -> DataFrame:
    """Ratios, alerts and verdict for rows with total, positive, neutral, negative."""
    enough = F.col("total") >= minimum
    limits = {"neutral": neutral, "negative": negative}
    out = counts.select(
        "*",
        *[
            F.when(enough, numbers.ratio(F.col(s), F.col("total"))).otherwise(F.lit(0.0)).alias(f"{s}_ratio")
            for s in limits
        ],
    )
    alerts = [
        F.when(
            F.col(f"{s}_ratio") > limit,
            F.format_string(
                f"{s.upper()} drift: %.2f%% > {limit * 100:.0f}%% threshold",
                numbers.percent(F.col(s), F.col("total"), 2),
            ),
        )
        for s, limit in limits.items()
    ]
    return out.select(
        "*",
        F.filter(F.array(*alerts), lambda a: a.isNotNull()).alias("alerts"),
        F.when(~enough, F.lit("insufficient_data")).alias("reason"),
    ).withColumn("drift_detected", F.size("alerts") > 0)


def drift(
    pred: DataFrame, neutral: float = NEUTRAL_LIMIT, negative: float = NEGATIVE_LIMIT, minimum: int = MINIMUM
) -> DataFrame:
    """One status row for a table of predictions."""
    return with_drift(dashboard.overall_stats(pred), neutral, negative, minimum)


def latest_drift(history: DataFrame) -> DataFrame:
    """The newest status row; zeros and the reason ``no_data`` before the first. Missing ratios are recomputed."""
    newest = history.agg(F.max_by(F.struct("*"), F.col("evaluated_at")).alias("d"))
    zero = F.lit(0).cast("bigint")
    rows = newest.select(
        F.col("d").isNull().alias("empty"),
        F.col("d.evaluated_at").alias("evaluated_at"),
        *[F.coalesce(f"d.{s}", zero).alias(s) for s in dashboard.REPORTED],
        F.col("d.total").alias("total"),
        F.col("d.neutral_ratio").alias("neutral_ratio"),
        F.col("d.negative_ratio").alias("negative_ratio"),
        F.coalesce("d.drift_detected", F.lit(False)).alias("drift_detected"),
        F.coalesce("d.alerts", F.array().cast("array<string>")).alias("alerts"),
        F.col("d.reason").alias("reason"),
    )
    summed = F.col("positive") + F.col("neutral") + F.col("negative")
    filled = rows.withColumn("total", F.coalesce(F.nullif("total", zero), summed))
    for s in ["neutral", "negative"]:
        known = F.col(f"{s}_ratio")
        filled = filled.withColumn(f"{s}_ratio", F.coalesce(known, numbers.ratio(F.col(s), F.col("total"))))
    reason = F.when(F.col("empty"), F.lit("no_data")).otherwise(F.col("reason"))
    return filled.withColumn("reason", reason).drop("empty")


def weekly_report(status: DataFrame) -> DataFrame:
    """The status as lines of text: total, classes with percentage, verdict and alerts."""
    lines = [F.format_string("Total predictions : %d", "total")]
    lines += [
        F.when(
            F.col("total") > 0,
            F.format_string(f"{s.capitalize():10s} : %6d (%.1f%%)", s, numbers.percent(F.col(s), F.col("total"))),
        )
        for s in dashboard.REPORTED
    ]
    verdict = F.when(F.col("drift_detected"), F.lit("STATUS : DRIFT DETECTED")).otherwise(
        F.lit("STATUS : HEALTHY")
    )
    alerts = F.when(F.size("alerts") > 0, F.array_join("alerts", "\n"))
    return status.select(F.concat_ws("\n", *lines, verdict, alerts).alias("report"))
