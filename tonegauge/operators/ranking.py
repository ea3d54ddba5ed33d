"""Exact ranks, running totals and quantiles without sorting a whole group in one task.

The common idea: rows are first counted per distinct value, the values are cut into ranges of about equal number by a sketch,
the few range totals are summed in order, and only rows of one range are ever ordered together.
"""

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def running_totals(
    df: DataFrame, by: Sequence[str], bucket: str, order: Sequence[Column], measures: Sequence[str]
) -> DataFrame:
    """Adds ``<measure>_before``: the sum of a measure over all earlier rows of the group.

    ``bucket`` must rise with ``order`` inside a group. Windows cover one bucket, or the bucket totals.
    """
    earlier = W.partitionBy(*by).orderBy(bucket).rowsBetween(W.unboundedPreceding, -1)
    totals = df.groupBy(*by, bucket).agg(*[F.sum(m).alias(f"_{m}_sum") for m in measures])
    starts = totals.select(
        *by, bucket,
        *[F.coalesce(F.sum(f"_{m}_sum").over(earlier), F.lit(0)).alias(f"_{m}_start") for m in measures],
    )
    inside = W.partitionBy(*by, bucket).orderBy(*order).rowsBetween(W.unboundedPreceding, -1)
    local = df.select(
        "*", *[F.coalesce(F.sum(m).over(inside), F.lit(0)).alias(f"_{m}_local") for m in measures]
    )
    same = [F.col(f"l.{c}").eqNullSafe(F.col(f"s.{c}")) for c in [*by, bucket]]
    # as many rows as there are buckets
    joined = local.alias("l").join(F.broadcast(starts).alias("s"), same)
    return joined.select(
        *[F.col(f"l.{c}") for c in df.columns],
        *[(F.col(f"_{m}_start") + F.col(f"_{m}_local")).alias(f"{m}_before") for m in measures],
    )


def value_counts(df: DataFrame, value: Column, by: Sequence[str] = ()) -> DataFrame:
    """Rows per distinct value and group, as ``value`` and ``n``; null and NaN are left out."""
    values = df.select(*by, value.cast("double").alias("value"))
    present = F.col("value").isNotNull() & ~F.isnan("value")
    # they are left out after counting: a filter on rows would be pushed below the columns of ``df`` and work them out once more
    return values.groupBy(*by, "value").agg(F.count_if(present).alias("n")).filter(F.col("n") > 0)


def with_one_group(counts: DataFrame) -> DataFrame:
    """Adds ``_all``, the same for every row. It is computed, because joins on a literal become nested loops."""
    return counts.withColumn("_all", F.col("n") > 0)


def splitters(buckets: int) -> Column:
    """Aggregate: values of ``value`` that cut its distinct values into ranges of about equal number, from a mergeable sketch.

    The ranges follow the values and not their distance: an outlier or a crowd of close values makes none of them large. The
    error of the sketch only moves a border, never a rank.
    """
    shares = F.array(*[F.lit(k / buckets) for k in range(1, buckets)])
    return F.percentile_approx("value", shares, 16 * buckets)


def range_of(value: Column, cuts: Column, buckets: int) -> Column:
    """The number of the range (0 to buckets - 1, a power of two) of a value: a binary search among the cuts below it."""
    steps = F.array(*[F.lit(buckets >> k) for k in range(1, buckets.bit_length())])
    return F.aggregate(
        steps, F.lit(0), lambda at, step: at + F.when(F.get(cuts, at + step - 1) < value, step).otherwise(F.lit(0))
    )


def in_ranges(counts: DataFrame, keys: Sequence[str], buckets: int, totals: Sequence[str] = ()) -> DataFrame:
    """``counts`` (one row per group and distinct ``value``) with ``_bucket``, which rises with the value inside a group, and
    ``_<total>_total`` for the group's sums. One row per group, ``buckets`` numbers each, goes to every task."""
    groups = counts.groupBy(*keys).agg(splitters(buckets).alias("_cuts"), *[F.sum(t).alias(f"_{t}_total") for t in totals])
    # nulls in the key must meet each other
    same = [F.col(f"c.{k}").eqNullSafe(F.col(f"g.{k}")) for k in keys]
    joined = counts.alias("c").join(F.broadcast(groups).alias("g"), same)
    return joined.select(
        *[F.col(f"c.{c}") for c in counts.columns], *[F.col(f"_{t}_total") for t in totals],
        range_of(F.col("value"), F.col("_cuts"), buckets).alias("_bucket"),
    )


def quantiles_of_counts(
    counts: DataFrame, probabilities: Sequence[float], by: Sequence[str] = (), buckets: int = 256
) -> DataFrame:
    """Exact quantiles with linear interpolation, one row per group and probability, from value counts.

    Meant for a few groups (classes, scores, column names): their cuts are broadcast.

    All groups and probabilities in one go: cuts from a sketch, one exact count of each range between cuts, and then only the
    ranges that hold a wanted rank are ordered.
    """
    by = list(by)
    keys = by or ["_all"]
    if not by:
        counts = with_one_group(counts)
    spread = in_ranges(counts, keys, buckets, ["n"])
    sizes = spread.groupBy(*keys, "_bucket", "_n_total").agg(F.sum("n").alias("_size"))
    upto = W.partitionBy(*keys).orderBy("_bucket").rowsBetween(W.unboundedPreceding, W.currentRow)
    wanted = F.explode(F.array(*[F.lit(float(p)) for p in probabilities])).alias("p")
    placed = sizes.withColumn("_upto", F.sum("_size").over(upto)).select("*", wanted)
    placed = placed.withColumn("_at", F.col("p") * (F.col("_n_total") - 1))
    # a wanted rank lies between two whole ones, which can lie in two ranges
    ranks = placed.select(
        *keys, "_bucket", "p", (F.col("_upto") - F.col("_size")).alias("_before"), "_upto", "_at",
        F.explode(F.array(F.floor("_at"), F.ceil("_at"))).alias("_rank"),
    ).filter((F.col("_rank") >= F.col("_before")) & (F.col("_rank") < F.col("_upto")))
    held = ranks.groupBy(*keys, "_bucket", "_before").agg(F.collect_set(F.struct("p", "_at", "_rank")).alias("_ranks"))
    same = [F.col(f"s.{k}").eqNullSafe(F.col(f"h.{k}")) for k in [*keys, "_bucket"]]
    # at most two ranges a group and probability
    chosen = spread.alias("s").join(F.broadcast(held).alias("h"), same).select(
        *[F.col(f"s.{k}") for k in [*keys, "_bucket"]], "value", "n", "_before", "_ranks"
    )
    inside = W.partitionBy(*keys, "_bucket").orderBy("value").rowsBetween(W.unboundedPreceding, -1)
    ordered = chosen.withColumn("n_before", F.col("_before") + F.coalesce(F.sum("n").over(inside), F.lit(0)))
    found = (
        ordered.select(*keys, "value", "n", "n_before", F.inline("_ranks")).filter(_covers("_rank"))
        .groupBy(*keys, "p")
        .agg(
            F.min("value").alias("_a"), F.max("value").alias("_b"), F.max(F.col("_at") - F.floor("_at")).alias("_part"),
        )
    )
    return found.select(*by, "p", (F.col("_a") + (F.col("_b") - F.col("_a")) * F.col("_part")).alias("q"))


def _covers(rank: str) -> Column:
    return (F.col("n_before") <= F.col(rank)) & (F.col(rank) < F.col("n_before") + F.col("n"))


def exact_quantiles(
    df: DataFrame, value: Column, probabilities: Sequence[float], by: Sequence[str] = ()
) -> DataFrame:
    return quantiles_of_counts(value_counts(df, value, by), probabilities, by)


def nth_keys(
    df: DataFrame, group: str, hashed: str, tie: str, wanted: Mapping[str, Callable[[Column], Column]],
    digits: int = 4,
) -> DataFrame:
    """The last key inside the first ``n`` rows of each group in (hash, tie) order, for several ``n`` at once.

    ``wanted`` gives each ``n`` a name and derives it from the size of the group. Only the hash buckets that
    hold a wanted rank are ordered, a ``16 ** -digits`` part of the table each. The result has at most one row
    per group and name: group, name, cut_hash, cut_key.
    """
    bucket = F.substring(hashed, 1, digits).alias("_bucket")
    sizes = df.groupBy(group, bucket).agg(F.count(F.lit(1)).alias("_size"))
    upto = W.partitionBy(group).orderBy("_bucket").rowsBetween(W.unboundedPreceding, W.currentRow)
    placed = sizes.select(
        "*", F.sum("_size").over(upto).alias("_upto"), F.sum("_size").over(W.partitionBy(group)).alias("_total")
    )
    ranks = F.array(*[
        F.struct(F.lit(name).alias("name"), n(F.col("_total")).cast("bigint").alias("n"))
        for name, n in wanted.items()
    ])
    located = (
        placed.select("*", F.inline(ranks))
        .filter((F.col("n") > F.col("_upto") - F.col("_size")) & (F.col("n") <= F.col("_upto")))
        .select(group, "_bucket", "name", (F.col("n") - F.col("_upto") + F.col("_size")).alias("_left"))
    )
    # copies of a key are one counted row, so a key that fills the bucket stays small
    rows, wanted_buckets = df.select(group, hashed, tie, bucket).alias("r"), F.broadcast(located).alias("l")
    # a null group is a group
    same = F.col(f"r.{group}").eqNullSafe(F.col(f"l.{group}")) & (F.col("r._bucket") == F.col("l._bucket"))
    keys = (
        rows.join(wanted_buckets, same).select("r.*", "name", "_left")
        .groupBy(group, "name", "_left", F.col(hashed).alias("cut_hash"), F.col(tie).alias("cut_key"))
        .agg(F.count(F.lit(1)).alias("_copies"))
    )
    inside = (
        W.partitionBy(group, "name").orderBy("cut_hash", "cut_key")
        .rowsBetween(W.unboundedPreceding, W.currentRow)
    )
    through = keys.withColumn("_through", F.sum("_copies").over(inside))
    # the bare bucket prefix sorts below every key in it: the cut when not even its first key fits
    nothing = F.lit(None).cast(df.schema[tie].dataType)
    floor = located.select(group, "name", F.col("_bucket").alias("cut_hash"), nothing.alias("cut_key"))
    fitting = through.filter(F.col("_through") <= F.col("_left")).select(floor.columns).unionByName(floor)
    return fitting.groupBy(group, "name").agg(
        F.max(F.struct("cut_hash", "cut_key")).alias("_cut")
    ).select(group, "name", "_cut.cut_hash", "_cut.cut_key")
