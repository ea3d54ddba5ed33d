"""Sentiment names, numeric labels and class weights."""

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

# Class names in label order, weight per label, drift and scoring defaults.
SENTIMENTS = ["negative", "neutral", "positive"]
UNKNOWN = "unknown"
CLASS_WEIGHTS = {0: 3.0, 1: 8.0, 2: 0.5}


# Each function below uses its argument once. A chain of CASE branches would copy it into every branch, and
# chained columns would then grow into plans too large to compile.


def _names() -> Column:
    return F.array(*[F.lit(s) for s in SENTIMENTS])


def sentiment(score: Column) -> Column:
    """Class name of a rating: below 3, exactly 3, above 3; no usable rating gives ``unknown``."""
    value = F.nanvl(score.try_cast("double"), F.lit(None).cast("double"))
    place = (F.signum(value - 3) + 1).cast("int")
    return F.coalesce(F.get(_names(), place), F.lit(UNKNOWN))


def label(name: Column) -> Column:
    """Numeric label 0, 1, 2 of a class name in any case; null for anything else."""
    place = F.array_position(_names(), F.lower(name))
    return (F.nullif(place, F.lit(0).cast("bigint")) - 1).cast("int")


def sentiment_of_label(code: Column) -> Column:
    """Class name of a numeric label or prediction; null and unmapped codes give ``unknown``."""
    return F.coalesce(F.get(_names(), code.try_cast("int")), F.lit(UNKNOWN))


def fixed_weight(code: Column, weights: Mapping[int, float] = CLASS_WEIGHTS, other: float = 1.0) -> Column:
    """Weight of a label from a small fixed table."""
    out = F.lit(float(other))
    for known, weight in weights.items():
        out = F.when(code == known, F.lit(float(weight))).otherwise(out)
    return out
