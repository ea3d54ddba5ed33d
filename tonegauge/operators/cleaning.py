"""Row filters, cleaning and labelled columns."""

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tonegauge.functions import clock, labels


def drop_empty_text(df: DataFrame, keep_blank: bool = False) -> DataFrame:
    """Rows with a Text; ``keep_blank`` drops only nulls and keeps empty strings."""
    present = F.col("Text").isNotNull()
    return df.filter(present if keep_blank else present & (F.col("Text") != ""))


def text_digest(text: Column) -> Column:
    """A number that equal texts share."""
    return F.xxhash64(text)


def dedupe_text(df: DataFrame, key: str = "Id") -> DataFrame:
    """One row per exact Text, the one with the smallest key.

    The smallest whole row is a plain aggregate, so copies collapse inside each task before the shuffle and a
    text that fills a third of the table costs one row per task. Rows are ordered by a digest of the text: texts are
    compared only where digests are equal, and different texts with one digest stay apart.
    """
    rest = [c for c in df.columns if c not in (key, "Text")]
    kept = df.groupBy(text_digest(F.col("Text")).alias("_digest"), "Text").agg(F.min(F.struct(key, *rest)).alias("_row"))
    return kept.select(*[F.col("Text") if c == "Text" else F.col(f"_row.{c}").alias(c) for c in df.columns])


def valid_helpfulness(df: DataFrame) -> DataFrame:
    """No more helpful votes than votes, or no votes at all; nulls are dropped."""
    votes = F.col("HelpfulnessDenominator")
    return df.filter((votes == 0) | (F.col("HelpfulnessNumerator") <= votes))


def fill_summary(df: DataFrame) -> DataFrame:
    return df.withColumn("Summary", F.coalesce(F.col("Summary").cast("string"), F.lit("")))


def clean(df: DataFrame) -> DataFrame:
    """All cleaning rules in order."""
    return fill_summary(valid_helpfulness(dedupe_text(drop_empty_text(df))))


def clean_audit(df: DataFrame) -> DataFrame:
    """One row per cleaning rule: rows before it, rows after it, rows removed by it.

    Every stage is counted in one pass over texts that were counted map-side first.
    """
    votes, helpful = F.col("HelpfulnessDenominator"), F.col("HelpfulnessNumerator")
    valid = F.coalesce((votes == 0) | (helpful <= votes), F.lit(False))
    per_text = df.groupBy(text_digest(F.col("Text")).alias("_digest"), "Text").agg(
        F.count(F.lit(1)).alias("rows"),
        F.min(F.struct(F.col("Id"), valid.alias("valid"))).alias("first"),
    )
    present = F.col("Text").isNotNull()
    filled = F.coalesce(F.col("Text") != "", F.lit(False))

    def total(rows, condition):
        return F.coalesce(F.sum(F.when(condition, rows)), F.lit(0)).cast("bigint")

    stages = per_text.agg(
        F.coalesce(F.sum("rows"), F.lit(0)).cast("bigint").alias("s0"),
        total(F.col("rows"), present).alias("s1"),
        total(F.col("rows"), filled).alias("s2"),
        total(F.lit(1), filled).alias("s3"),
        total(F.lit(1), filled & F.col("first.valid")).alias("s4"),
    )
    rules = ["null_text", "empty_text", "duplicate_text", "invalid_helpfulness"]
    rows = F.array(*[
        F.struct(
            F.lit(k + 1).alias("step"),
            F.lit(rule).alias("rule"),
            F.col(f"s{k}").alias("rows_before"),
            F.col(f"s{k + 1}").alias("rows_after"),
            (F.col(f"s{k}") - F.col(f"s{k + 1}")).alias("removed"),
        )
        for k, rule in enumerate(rules)
    ])
    return stages.select(F.inline(rows))


def with_sentiment(df: DataFrame) -> DataFrame:
    return df.withColumn("Sentiment", labels.sentiment(F.col("Score")))


def with_label(df: DataFrame) -> DataFrame:
    return df.withColumn("label", labels.label(F.col("Sentiment")))


def labelled(df: DataFrame) -> DataFrame:
    """Rows with a class name and label; rows without a usable score are left out."""
    return with_label(with_sentiment(df)).filter(F.col("label").isNotNull())


def index_label(df: DataFrame, column: str = "Sentiment", out: str = "label_index") -> DataFrame:
    """Label by falling frequency, ties in alphabetical order."""
    from pyspark.ml.feature import StringIndexer

    return StringIndexer(inputCol=column, outputCol=out, handleInvalid="keep").fit(df).transform(df)


def fixed_weights(df: DataFrame, weights: Mapping[int, float] = labels.CLASS_WEIGHTS) -> DataFrame:
    return df.withColumn("classWeight", labels.fixed_weight(F.col("label"), weights))


def balanced_weights(df: DataFrame, by: DataFrame | None = None) -> DataFrame:
    """Inverse-frequency weights ``total / (3 * count)`` taken from ``by`` (the training rows), 1.0 for other labels.

    At most three counted rows are joined back, so the table itself is not shuffled.
    """
    codes = range(len(labels.SENTIMENTS))
    source = (df if by is None else by).filter(F.col("label").isin(*codes))
    counts = source.groupBy("label").agg(F.count(F.lit(1)).alias("_n"))
    total = counts.agg(F.sum("_n").cast("double")).scalar()
    weights = counts.select(
        "label", (total / (F.lit(len(labels.SENTIMENTS)) * F.col("_n"))).alias("classWeight")
    )
    joined = df.join(F.broadcast(weights), "label", "left")
    return joined.withColumn("classWeight", F.coalesce("classWeight", F.lit(1.0)))


def fuse_text(df: DataFrame, times: int = 2) -> DataFrame:
    """Text becomes the summary, repeated, followed by the text."""
    parts = [F.col("Summary")] * times + [F.col("Text")]
    return df.withColumn("Text", F.concat_ws(" ", *parts))


def prediction_view(df: DataFrame) -> DataFrame:
    """Columns of a stored prediction, with the highest class probability as confidence where there is one."""
    out = df.withColumn("PredictedSentiment", labels.sentiment_of_label(F.col("prediction"))).withColumn(
        "ProcessingTime", clock.event_time(F.col("Time"))
    )
    columns = [
        "Id", "ProductId", "UserId", "ProfileName", "Score", "Time", "ProcessingTime",
        "Summary", "Text", "prediction", "PredictedSentiment",
    ]
    if "probability" in df.columns:
        out = out.withColumn("max_prob", F.array_max(probability_array(df)))
        columns.append("max_prob")
    return out.select(*[c for c in columns if c in out.columns])


def probability_array(df: DataFrame):
    """The probability column as array, whether it is an ML vector or an array."""
    from pyspark.ml.functions import vector_to_array
    from pyspark.sql.types import ArrayType

    if isinstance(df.schema["probability"].dataType, ArrayType):
        return F.col("probability")
    return vector_to_array(F.col("probability"))


def search(df: DataFrame, text: str) -> DataFrame:
    """Rows whose product, profile name or summary contains the text in any case."""
    wanted = F.lower(F.lit(text))
    hits = [
        F.coalesce(F.contains(F.lower(F.col(c)), wanted), F.lit(False))
        for c in ["ProductId", "ProfileName", "Summary"]
    ]
    return df.filter(hits[0] | hits[1] | hits[2])


def helpfulness(df: DataFrame) -> DataFrame:
    """Reviews with a vote and their share of helpful votes."""
    share = F.col("HelpfulnessNumerator") / F.col("HelpfulnessDenominator")
    return df.filter(F.col("HelpfulnessDenominator") > 0).withColumn("helpfulness_ratio", share)
