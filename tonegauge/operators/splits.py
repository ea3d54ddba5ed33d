"""Splits and samples. All are decided by a seeded hash of the row key, so they survive repartitioning."""

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tonegauge.functions import hashing, labels
from tonegauge.operators import ranking


def _hash_of(key: str, seed: int):
    """Rows without a key have a place in hash order too."""
    return F.coalesce(hashing.seeded_hash(F.col(key), seed), hashing.seeded_hash(F.lit(""), seed))


def _row_hash(df: DataFrame, key: str, seed: int):
    """The hash of a row's key; where it has none, of the row as JSON (rows alike in all columns stay together)."""
    whole = F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"})
    return F.coalesce(hashing.seeded_hash(F.col(key), seed), hashing.seeded_hash(whole, seed))


def stratified_split(
    df: DataFrame, column: str = "Sentiment", seed: int = 42, key: str = "Id",
    values: Sequence = tuple(labels.SENTIMENTS), tenths: tuple[int, int] = (8, 1),
) -> DataFrame:
    """Exact split per class: the first 8/10 in hash order are train, the next 1/10 val, the rest test.

    Rows whose class is not in ``values`` are left out. The rows are not sorted or shuffled: the two cut keys of
    every class are found first, then each row is compared with them. Rows with the same key stay together.
    """
    rows = df.filter(F.col(column).isin(*values)).withColumn("_h", _hash_of(key, seed))
    train, val = tenths

    def tenth_part(total, tenth: int):
        return F.floor(total * tenth / 10)

    cuts = ranking.nth_keys(rows, column, "_h", key, {
        "train": lambda total: tenth_part(total, train),
        "val": lambda total: tenth_part(total, train) + tenth_part(total, val),
    })

    def cut(name: str):
        picked = F.max(F.when(F.col("name") == name, F.struct("cut_hash", "cut_key")))
        return picked.alias(f"_{name}")

    # one row per class in ``values``, so the broadcast cannot grow with the table
    ends = cuts.groupBy(column).agg(cut("train"), cut("val"))
    place = F.struct(F.col("_h").alias("cut_hash"), F.col(key).alias("cut_key"))
    split = (
        F.when(place <= F.col("_train"), "train").when(place <= F.col("_val"), "val").otherwise("test")
    )
    return rows.join(F.broadcast(ends), column, "left").select(*df.columns, split.alias("split"))


def approx_split(
    df: DataFrame, column: str = "Sentiment", seed: int = 42, key: str = "Id", train: float = 0.8
) -> DataFrame:
    """Approximate split per class: train by one hash, the rest halved into val and test by another."""
    by_class = F.concat_ws(":", F.col(column), F.coalesce(F.col(key).cast("string"), _row_hash(df, key, seed)))
    first = hashing.falls_below(hashing.seeded_hash(by_class, seed), train)
    second = hashing.falls_below(hashing.seeded_hash(by_class, seed + 1), 0.5)
    return df.withColumn("split", F.when(first, "train").when(second, "val").otherwise("test"))


def random_split(
    df: DataFrame, fractions: Sequence[tuple[str, float]] = (("train", 0.8), ("test", 0.2)),
    seed: int = 42, key: str = "Id",
) -> DataFrame:
    """Plain random split into named parts whose fractions sum to one. Rows without a key are split by all their columns."""
    hashed = _row_hash(df, key, seed)
    out = F.lit(fractions[-1][0])
    below = 1.0
    for (name, _), (_, later) in zip(reversed(fractions[:-1]), reversed(fractions[1:])):
        below -= later
        out = F.when(hashing.falls_below(hashed, below), F.lit(name)).otherwise(out)
    return df.withColumn("split", out)


def sample(df: DataFrame, fraction: float, seed: int = 42, key: str = "Id") -> DataFrame:
    """Each row kept with the given probability. Rows without a key are drawn by all their columns."""
    return df.filter(hashing.falls_below(_row_hash(df, key, seed), fraction))


def sample_n(df: DataFrame, n: int, seed: int = 42, key: str = "Id", by: str | None = None) -> DataFrame:
    """A sample of ``n`` rows, or ``n`` per value of ``by`` (a column with few values, null being one of them).

    The cut key that bounds the sample is found from hash bucket counts, so no task gathers more than the
    rows of one bucket. Rows whose key is the first behind the cut fill the sample up, in the order of all their columns.
    """
    rows = df.withColumn("_h", _hash_of(key, seed))
    group = by or "_all"
    if by is None:
        # the same for every row, yet not a literal: joins on a literal become nested loops
        rows = rows.withColumn("_all", F.length("_h"))
    cuts = ranking.nth_keys(rows, group, "_h", key, {"cut": lambda total: F.least(total, F.lit(n))})
    cuts = cuts.select(F.col(group).alias("_group"), F.struct("cut_hash", "cut_key").alias("_cut"))
    place = F.struct(F.col("_h").alias("cut_hash"), F.col(key).alias("cut_key"))
    # one row, or one per value of ``by``
    placed = rows.join(F.broadcast(cuts), F.col(group).eqNullSafe(F.col("_group")))
    placed = placed.select(*rows.columns, place.alias("_place"), (place <= F.col("_cut")).alias("_inside"))
    sizes = placed.groupBy(F.col(group).alias("_group")).agg(
        F.count_if("_inside").alias("_taken"), F.min(F.when(~F.col("_inside"), F.col("_place"))).alias("_next")
    )
    following = placed.filter(~F.col("_inside")).join(F.broadcast(sizes), F.col(group).eqNullSafe(F.col("_group")))
    order = W.partitionBy(group).orderBy(F.xxhash64(*df.columns), *df.columns)
    filling = (
        following.filter(F.col("_place").eqNullSafe(F.col("_next")) & (F.col("_taken") < n))
        .withColumn("_rank", F.row_number().over(order)).filter(F.col("_rank") <= n).filter(F.col("_taken") + F.col("_rank") <= n)
    )
    return placed.filter("_inside").select(*df.columns).unionAll(filling.select(*df.columns))


def split_audit(df: DataFrame, column: str = "Sentiment") -> DataFrame:
    """Rows and share of each class within each split."""
    from tonegauge.functions import numbers

    counts = df.groupBy("split", column).agg(F.count(F.lit(1)).alias("count"))
    totals = counts.groupBy("split").agg(F.sum("count").alias("split_total"))
    return counts.join(totals, "split").withColumn(
        "share", numbers.percent(F.col("count"), F.col("split_total"), 2)
    )
