"""Ratios and percentages whose rounding does not depend on floating point ties."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def scaled_half_up(part: Column, total: Column, scale: int) -> Column:
    """``round(scale * part / total)`` in whole numbers, half up; 0 where the total is not positive."""
    p, t = part.cast("bigint"), total.cast("bigint")
    doubled = F.lit(2 * scale).cast("bigint") * p + t
    quotient = F.call_function("div", doubled, F.nullif(F.lit(2).cast("bigint") * t, F.lit(0).cast("bigint")))
    return F.when(t > 0, quotient).otherwise(F.lit(0).cast("bigint"))


def percent(part: Column, total: Column, digits: int = 1) -> Column:
    """Percentage rounded half up to ``digits`` decimals; 0.0 where the total is not positive."""
    step = 10 ** digits
    return scaled_half_up(part, total, 100 * step) / F.lit(float(step))


def ratio(part: Column, total: Column) -> Column:
    """Plain share as double; 0.0 where the total is not positive."""
    share = part.cast("double") / F.nullif(total.cast("double"), F.lit(0.0))
    return F.when(total > 0, share).otherwise(F.lit(0.0))


def safe_divide(top: Column, bottom: Column) -> Column:
    """Division that gives 0.0 for a zero divisor."""
    return F.coalesce(top / F.nullif(bottom, F.lit(0.0)), F.lit(0.0))
