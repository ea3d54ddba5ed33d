"""Deterministic randomness: every random choice is an md5 of a seed and a row key, so it does not
depend on how rows are partitioned and can be repeated by any engine."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def seeded_hash(key: Column, seed: int) -> Column:
    """32 hex digits of ``seed:key``."""
    return F.md5(F.concat(F.lit(f"{seed}:"), key.cast("string")).cast("binary"))


def hex_bound(fraction: float) -> str:
    """Eight-digit hex bound so that a uniform hash lies below it with the given probability."""
    scaled = round(fraction * 16 ** 8)
    return "g" if scaled >= 16 ** 8 else format(max(scaled, 0), "08x")


def falls_below(hashed: Column, fraction: float) -> Column:
    return F.substring(hashed, 1, 8) < F.lit(hex_bound(fraction))
