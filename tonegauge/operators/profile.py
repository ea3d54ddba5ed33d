"""Data profiling. Every number is a grouped aggregate; quantiles are exact and never sort a whole column in
one task."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tonegauge.functions import clock, labels, numbers
from tonegauge.functions import text as words
from tonegauge.operators import ranking

_QUARTILES = [0.25, 0.5, 0.75]


def _one(df: DataFrame) -> Column:
    """Row count as a scalar."""
    return df.agg(F.count(F.lit(1))).scalar()


def shape(df: DataFrame) -> DataFrame:
    """Number of rows and columns."""
    return df.agg(F.count(F.lit(1)).alias("rows")).withColumn("columns", F.lit(len(df.columns)))


def column_types(df: DataFrame) -> DataFrame:
    """Name and type of every column, in order."""
    fields = [(i, f.name, f.dataType.simpleString()) for i, f in enumerate(df.schema.fields)]
    return df.sparkSession.createDataFrame(fields, "place int, column string, type string")


def _long(df: DataFrame, columns: Sequence[str], kind: str) -> DataFrame:
    """Columns as (column, value) rows."""
    return df.unpivot([], [F.col(c).cast(kind).alias(c) for c in columns], "column", "value")


def numeric_summary(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """count, mean, std, min, quartiles and max per numeric column, all from one table of value counts."""
    counts = ranking.value_counts(_long(df, columns, "double"), F.col("value"), ["column"])
    total = F.sum("n")
    mean = F.sum(F.col("value") * F.col("n")) / total
    # deviations are summed around the mean of the column, which is joined back (one row per column)
    means = counts.groupBy("column").agg(
        total.alias("count"), mean.alias("mean"), F.min("value").alias("min"), F.max("value").alias("max")
    )
    spread = counts.join(F.broadcast(means.select("column", "mean")), "column").groupBy("column").agg(
        F.sum(F.col("n") * (F.col("value") - F.col("mean")) ** 2).alias("_squares")
    )
    quartiles = ranking.quantiles_of_counts(counts, _QUARTILES, ["column"]).groupBy("column").agg(
        *[F.max(F.when(F.col("p") == p, F.col("q"))).alias(f"q{round(p * 100)}") for p in _QUARTILES]
    )
    std = F.sqrt(F.col("_squares") / F.nullif(F.col("count") - 1, F.lit(0)))
    return means.join(spread, "column").join(quartiles, "column").select(
        "column", "count", "mean", std.alias("std"), "min", "q25", "q50", "q75", "max"
    )


def text_summary(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """count, distinct values, most frequent value and its frequency per text column; ties take the smallest."""
    counts = (
        _long(df, columns, "string").filter(F.col("value").isNotNull())
        .groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))
    )
    best = F.min_by(F.struct("value", "n"), F.struct(-F.col("n"), F.col("value")))
    return counts.groupBy("column").agg(
        F.sum("n").alias("count"), F.count(F.lit(1)).alias("unique"), best.alias("_top")
    ).select("column", "count", "unique", F.col("_top.value").alias("top"), F.col("_top.n").alias("freq"))


def profile(df: DataFrame) -> DataFrame:
    """Numeric and text summary of all columns in one table."""
    numeric = [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]
    text = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    return numeric_summary(df, numeric).unionByName(text_summary(df, text), allowMissingColumns=True)


def missing(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Missing values (null or NaN) per column, number and percentage, only columns that have some, most first."""
    columns = list(columns or df.columns)
    fractional = {f.name for f in df.schema.fields if isinstance(f.dataType, (T.FloatType, T.DoubleType))}
    absent = lambda c: F.col(c).isNull() | F.isnan(c) if c in fractional else F.col(c).isNull()
    counts = df.agg(
        F.count(F.lit(1)).alias("_total"),
        *[F.count_if(absent(c)).alias(c) for c in columns],
    )
    rows = counts.unpivot(["_total"], columns, "column", "missing").filter(F.col("missing") > 0)
    return rows.select(
        "column", "missing", numbers.percent(F.col("missing"), F.col("_total"), 2).alias("missing_pct")
    ).orderBy(F.desc("missing"), "column")


def duplicates(df: DataFrame, text: str = "Text") -> DataFrame:
    """Copies beyond the first, of whole rows and of the text, number and percentage. Nulls equal each other."""
    def extra(kind: str, keys: Sequence[str]) -> DataFrame:
        groups = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
        return groups.agg(
            F.lit(kind).alias("kind"),
            F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).cast("bigint").alias("extra"),
            F.coalesce(F.sum("_n"), F.lit(0)).cast("bigint").alias("_total"),
        )

    both = extra("row", df.columns).unionByName(extra("text", [text]))
    return both.select("kind", "extra", numbers.percent(F.col("extra"), F.col("_total"), 2).alias("extra_pct"))


def invalid_votes(df: DataFrame) -> DataFrame:
    bad = F.count_if(F.col("HelpfulnessNumerator") > F.col("HelpfulnessDenominator"))
    return df.agg(bad.alias("invalid"))


def distribution(df: DataFrame, column: str) -> DataFrame:
    """Rows and percentage per value of a column with few values."""
    counts = ranking.with_one_group(df.groupBy(column).agg(F.count(F.lit(1)).alias("n")))
    # one row per value: the table itself is read once
    total = F.sum("n").over(W.partitionBy("_all"))
    return counts.select(column, F.col("n").alias("count"), numbers.percent(F.col("n"), total).alias("share"))


def sentiment_balance(df: DataFrame) -> DataFrame:
    """One row: rows per class and the positive to neutral ratio."""
    counts = df.agg(*[F.count_if(F.col("Sentiment") == s).alias(s) for s in labels.SENTIMENTS])
    ratio = F.col("positive") / F.nullif(F.col("neutral").cast("double"), F.lit(0.0))
    return counts.withColumn("positive_to_neutral", ratio)


def date_span(df: DataFrame) -> DataFrame:
    """First and last review date and the whole years between, at 365 days each."""
    ends = df.agg(F.min("Time").alias("a"), F.max("Time").alias("b"))
    days = F.floor((F.col("b") - F.col("a")) / 86400)
    return ends.select(
        clock.event_date(F.col("a")).alias("first_day"),
        clock.event_date(F.col("b")).alias("last_day"),
        F.floor(days / 365).cast("bigint").alias("years"),
    )


def _year() -> Column:
    return F.year(clock.event_date(F.col("Time"))).cast("bigint")


def per_year(df: DataFrame) -> DataFrame:
    return df.groupBy(_year().alias("year")).agg(F.count(F.lit(1)).alias("count"))


def year_by_sentiment(df: DataFrame) -> DataFrame:
    """One row per year with a column per class, 0 where there is none."""
    return df.groupBy(_year().alias("year")).agg(
        *[F.count_if(F.col("Sentiment") == s).alias(s) for s in labels.SENTIMENTS]
    )


def avg_score(df: DataFrame) -> DataFrame:
    """Mean score per year, and overall in the row whose year is null and ``overall`` is true."""
    dated = df.select(_year().alias("year"), "Score").filter(F.col("year").isNotNull())
    return dated.rollup("year").agg(
        F.avg("Score").alias("mean_score"), (F.grouping("year") == 1).alias("overall")
    )


def with_word_counts(df: DataFrame) -> DataFrame:
    """Reviews with text and summary, and the number of words of both."""
    present = df.filter(F.col("Text").isNotNull() & F.col("Summary").isNotNull())
    return present.withColumn("text_words", words.word_count(F.col("Text"))).withColumn(
        "summary_words", words.word_count(F.col("Summary"))
    )


def with_text_length(df: DataFrame) -> DataFrame:
    return df.withColumn("text_len", F.length("Text"))


def histogram(
    df: DataFrame, value: Column, by: Sequence[str] = (), bins: int = 60, clip: float | None = 0.99
) -> DataFrame:
    """Equal-width bins per group between the smallest and largest value: bin, from, to, count, density.

    ``clip`` first cuts values at that quantile of their group. The last bin includes its upper end. The groups
    should be few (classes, scores): one row per group is broadcast.
    """
    by = list(by)
    keys = by or ["_all"]
    counts = ranking.value_counts(df, value, by)
    if not by:
        counts = ranking.with_one_group(counts)
    if clip is not None:
        top = ranking.quantiles_of_counts(counts, [clip], keys).select(*keys, F.col("q").alias("_top"))
        counts = counts.join(F.broadcast(top), keys).withColumn("value", F.least("value", "_top"))
    ranges = counts.groupBy(*keys).agg(
        F.min("value").alias("_lo"), F.max("value").alias("_hi"), F.sum("n").alias("_total")
    )
    # a single value gets a bin range of one around it
    flat = F.col("_lo") == F.col("_hi")
    ranges = ranges.select(
        *keys, "_total",
        F.when(flat, F.col("_lo") - 0.5).otherwise(F.col("_lo")).alias("_lo"),
        F.when(flat, F.col("_hi") + 0.5).otherwise(F.col("_hi")).alias("_hi"),
    )
    width = (F.col("_hi") - F.col("_lo")) / bins
    place = F.least(F.floor((F.col("value") - F.col("_lo")) / width), F.lit(bins - 1)).cast("bigint")
    binned = counts.join(F.broadcast(ranges), keys).groupBy(*keys, place.alias("bin"), "_lo", "_hi", "_total").agg(
        F.sum("n").alias("count")
    )
    return binned.select(
        *by, "bin",
        (F.col("_lo") + F.col("bin") * width).alias("from"),
        (F.col("_lo") + (F.col("bin") + 1) * width).alias("to"),
        "count",
        (F.col("count") / (F.col("_total") * width)).alias("density"),
    )


def box_stats(df: DataFrame, value: Column, by: Sequence[str], cap: float | None = None) -> DataFrame:
    """Quartiles, whiskers (last value within 1.5 quartile ranges) and number of outliers per group."""
    by = list(by)
    capped = F.least(value, F.lit(cap)) if cap is not None else value
    counts = ranking.value_counts(df, capped, by)
    quartiles = ranking.quantiles_of_counts(counts, _QUARTILES, by).groupBy(*by).agg(
        *[F.max(F.when(F.col("p") == p, F.col("q"))).alias(f"q{round(p * 100)}") for p in _QUARTILES]
    )
    reach = 1.5 * (F.col("q75") - F.col("q25"))
    inside = F.col("value").between(F.col("q25") - reach, F.col("q75") + reach)
    return counts.join(F.broadcast(quartiles), by).groupBy(*by, "q25", "q50", "q75").agg(
        F.min(F.when(inside, F.col("value"))).alias("low_whisker"),
        F.max(F.when(inside, F.col("value"))).alias("high_whisker"),
        F.coalesce(F.sum(F.when(~inside, F.col("n"))), F.lit(0)).cast("bigint").alias("outliers"),
        F.sum("n").alias("count"),
    )


def voted_share(df: DataFrame) -> DataFrame:
    """Reviews with a helpfulness vote, number and percentage."""
    counts = df.agg(F.count_if(F.col("HelpfulnessDenominator") > 0).alias("voted"), F.count(F.lit(1)).alias("_n"))
    return counts.select("voted", numbers.percent(F.col("voted"), F.col("_n")).alias("voted_pct"))


def top_n(df: DataFrame, column: str = "ProductId", n: int = 15) -> DataFrame:
    counts = df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("count"))
    return counts.orderBy(F.desc("count"), column).limit(n)


def distincts(df: DataFrame, columns: Sequence[str] = ("ProductId", "UserId"), approximate: bool = False) -> DataFrame:
    """Distinct non-null values per column; exact, or within a few percent in one pass."""
    if approximate:
        one = df.agg(*[F.approx_count_distinct(c).alias(c) for c in columns])
        return one.unpivot([], list(columns), "column", "distinct")
    pairs = _long(df, columns, "string").filter(F.col("value").isNotNull()).distinct()
    return pairs.groupBy("column").agg(F.count(F.lit(1)).alias("distinct"))


def product_sentiment(df: DataFrame, product: str) -> DataFrame:
    """Rows per class for one product, all three classes, 0 where there is none."""
    counts = df.filter(F.col("ProductId") == product).agg(
        *[F.count_if(F.col("Sentiment") == s).alias(s) for s in labels.SENTIMENTS]
    )
    return counts.unpivot([], labels.SENTIMENTS, "Sentiment", "count")


def _per_user(df: DataFrame) -> DataFrame:
    return df.filter(F.col("UserId").isNotNull()).groupBy("UserId").agg(F.count(F.lit(1)).alias("reviews"))


def user_activity(df: DataFrame) -> DataFrame:
    """Users with one review, with more than ten, and the largest number of one user."""
    return _per_user(df).agg(
        F.count_if(F.col("reviews") == 1).alias("users_with_one"),
        F.count_if(F.col("reviews") > 10).alias("users_over_ten"),
        F.max("reviews").alias("most_by_one"),
    )


def user_activity_histogram(df: DataFrame, cap: int = 20, bins: int = 20) -> DataFrame:
    """Users by number of reviews, numbers above the cap counted at the cap."""
    return histogram(_per_user(df), F.least("reviews", F.lit(cap)), bins=bins, clip=None)


def examples(df: DataFrame, seed: int = 42, characters: int = 400) -> DataFrame:
    """One random review per class with the start of its text."""
    from tonegauge.operators import splits

    rows = df.filter(F.col("Sentiment").isin(*labels.SENTIMENTS))
    chosen = splits.sample_n(rows, 1, seed=seed, by="Sentiment")
    return chosen.select(
        "Id", "Sentiment", "Score", "Summary", F.substring("Text", 1, characters).alias("Text")
    )
