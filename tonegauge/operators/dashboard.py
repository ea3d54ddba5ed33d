"""Tables behind the dashboard: statistics, monthly trends, product scores, recent predictions.

Predictions are grouped straight from the table; every grouping combines inside the task first, so a product
or a month with a third of all rows costs each task one row.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tonegauge.functions import clock, labels, numbers

# Fixed order of the three reported classes.
REPORTED = ["positive", "neutral", "negative"]


def _class_counts(name: Column, count: Column | None = None) -> list[Column]:
    """One summed column per reported class; the class name may be in any case."""
    lowered = F.lower(name)
    count = F.lit(1) if count is None else count
    return [
        F.coalesce(F.sum(F.when(lowered == s, count)), F.lit(0)).cast("bigint").alias(s) for s in REPORTED
    ]


def _total(df: DataFrame) -> DataFrame:
    return df.withColumn("total", F.col("positive") + F.col("neutral") + F.col("negative"))


def overall_stats(pred: DataFrame) -> DataFrame:
    """One row: predictions per class and their sum; other class names do not count."""
    return _total(pred.agg(*_class_counts(F.col("PredictedSentiment"))))


def overall_from_monthly(monthly: DataFrame) -> DataFrame:
    """The same from the monthly table."""
    return _total(monthly.agg(*_class_counts(F.col("sentiment"), F.col("count"))))


def monthly_sentiment(pred: DataFrame) -> DataFrame:
    """Predictions per UTC month of ``Time`` and class name; rows without a whole-number time are skipped."""
    dated = pred.filter(F.col("PredictedSentiment").isNotNull()).select(
        clock.event_date(F.col("Time")).alias("date"), F.col("PredictedSentiment").alias("sentiment")
    )
    return (
        dated.filter(F.col("date").isNotNull())
        .groupBy(F.year("date").alias("year"), F.month("date").alias("month"), "sentiment")
        .agg(F.count(F.lit(1)).alias("count"))
    )


def live_trend(pred: DataFrame) -> DataFrame:
    """One row per month with the three class counts, from ProcessingTime or else Time.

    Numbers are epoch seconds, text must be a full date and time; anything else is skipped.
    """
    def as_text(name: str) -> Column:
        if pred.schema[name].dataType.typeName() == "string":
            return F.nullif(F.col(name), F.lit(""))
        return clock.event_time(F.col(name))

    # a filled ProcessingTime decides even when it cannot be parsed
    moment = F.coalesce(*[as_text(c) for c in ["ProcessingTime", "Time"] if c in pred.columns])
    date = clock.parsed_date(moment)
    # rows without a date or a reported class drop out after grouping, so the date is worked out once per row
    month = F.trunc(date, "month")
    months = pred.groupBy(month.alias("_start")).agg(
        *_class_counts(F.col("PredictedSentiment")), F.count(month).alias("_dated")
    )
    kept = months.filter((F.col("_dated") > 0) & (F.col("positive") + F.col("neutral") + F.col("negative") > 0))
    return _with_label(kept.select(F.year("_start").alias("year"), F.month("_start").alias("month"), *REPORTED))


def trend_from_monthly(monthly: DataFrame) -> DataFrame:
    """The same from the monthly table; months that do not exist and other class names are skipped."""
    valid = monthly.filter(
        clock.month_start(F.col("year"), F.col("month")).isNotNull()
        & F.lower("sentiment").isin(*REPORTED)
    )
    return _with_label(valid.groupBy("year", "month").agg(*_class_counts(F.col("sentiment"), F.col("count"))))


def _with_label(months: DataFrame) -> DataFrame:
    start = clock.month_start(F.col("year"), F.col("month"))
    named = months.withColumn("label", clock.month_label(start))
    # one row per calendar month: a sort in one task, where a global sort would first sample its whole input
    return named.repartition(1).sortWithinPartitions("year", "month")


def product_scoring(pred: DataFrame) -> DataFrame:
    """Per product the counts by class name, ``total_all`` over every name, ``total`` over the three classes."""
    known = pred.filter(F.col("PredictedSentiment").isNotNull() & F.col("ProductId").isNotNull())
    counts = known.groupBy(
        F.col("ProductId").alias("product"), F.col("PredictedSentiment").alias("sentiment")
    ).agg(F.count(F.lit(1)).alias("count"))
    reported = F.lower("sentiment").isin(*REPORTED)
    # a product has as many entries here as there are class names
    return counts.groupBy("product").agg(
        F.array_sort(F.collect_list(F.struct("sentiment", "count"))).alias("sentiments"),
        F.sum("count").alias("total_all"),
        F.coalesce(F.sum(F.when(reported, F.col("count"))), F.lit(0)).cast("bigint").alias("total"),
    )


def _named(product: Column) -> Column:
    return F.coalesce(F.nullif(product, F.lit("")), F.lit("Unknown"))


def top_products(pred: DataFrame, n: int = 8) -> DataFrame:
    """Products with the most predictions; a missing product id shows as ``Unknown``."""
    counts = pred.groupBy(F.col("ProductId").alias("product")).agg(F.count(F.lit(1)).alias("count"))
    return _largest(counts, n).select(_named(F.col("product")).alias("product"), "count")


def top_products_from_scoring(scoring: DataFrame, n: int = 8) -> DataFrame:
    counts = scoring.select("product", F.col("total_all").alias("count"))
    return _largest(counts, n).select(_named(F.col("product")).alias("product"), "count")


def _largest(counts: DataFrame, n: int) -> DataFrame:
    return counts.orderBy(F.desc("count"), F.asc_nulls_first("product")).limit(n)


def top_products_with_fallback(scoring: DataFrame | None, pred: DataFrame, n: int = 8) -> DataFrame:
    """From the scored table, or from the predictions when that table is missing or empty."""
    if scoring is None or scoring.isEmpty():
        return top_products(pred, n)
    return top_products_from_scoring(scoring, n)


def _entry_count(name: str) -> Column:
    """Sum of the counts of one class in the ``sentiments`` entries."""
    own = F.filter("sentiments", lambda e: F.lower(e["sentiment"]) == name)
    return F.aggregate(own, F.lit(0).cast("bigint"), lambda acc, e: acc + e["count"])


def with_shares(df: DataFrame, total: str = "total") -> DataFrame:
    """Adds the percentage of each class in the row, one decimal, 0 for an empty row."""
    return df.select(
        "*", *[numbers.percent(F.col(s), F.col(total)).alias(f"{s}_pct") for s in REPORTED]
    )


def scored_counts(scoring: DataFrame) -> DataFrame:
    """The scored table with one count and one percentage column per class."""
    wide = scoring.select("product", "total", *[_entry_count(s).alias(s) for s in REPORTED])
    return with_shares(wide)


def top_products_sentiment(scoring: DataFrame, n: int = 8) -> DataFrame:
    """The largest products with counts and percentages."""
    top = scoring.orderBy(F.desc("total_all"), F.asc("product")).limit(n)
    return scored_counts(top)


def live_product_counts(pred: DataFrame) -> DataFrame:
    """Counts and percentages of every product straight from the predictions."""
    known = pred.filter(F.col("PredictedSentiment").isNotNull())
    counts = known.groupBy(F.col("ProductId").alias("product")).agg(
        *_class_counts(F.col("PredictedSentiment"))
    )
    return with_shares(_total(counts)).select("product", "total", *REPORTED, *[f"{s}_pct" for s in REPORTED])


def score_product(product: str, scoring: DataFrame | None, pred: DataFrame) -> DataFrame:
    """One row for one product: from the scored table, else from the predictions, else zeros."""
    stored = None if scoring is None else scored_counts(scoring.filter(F.col("product") == product))
    live = live_product_counts(pred.filter(F.col("ProductId") == product))
    found = live if stored is None else stored.withColumn("rank", F.lit(0)).unionByName(
        live.withColumn("rank", F.lit(1))
    )
    fields = ["total", *REPORTED, *[f"{s}_pct" for s in REPORTED]]
    # an aggregate over no rows still gives one row, which turns into zeros
    order = F.col("rank") if "rank" in found.columns else F.lit(0)
    first = found.agg(F.min_by(F.struct(*fields), order).alias("r"))
    return first.select(
        F.lit(product).alias("product"),
        *[F.coalesce(F.col(f"r.{f}"), F.lit(0)).cast(found.schema[f].dataType).alias(f) for f in fields],
    )


def score_all_products(scoring: DataFrame, pred: DataFrame) -> DataFrame:
    """Scores of every product, stored ones first, live ones for the products the stored table lacks."""
    stored = scored_counts(scoring)
    live = live_product_counts(pred.filter(F.col("ProductId").isNotNull()))
    return stored.unionByName(live.join(stored.select("product"), "product", "left_anti"))


def newest_first(id: str = "Id") -> list[Column]:
    """Larger ids first: by number, and as text where they are no whole numbers."""
    return [F.col(id).try_cast("decimal(38,0)").desc_nulls_last(), F.desc(id)]


def recent(pred: DataFrame, n: int = 20, product: str | None = None) -> DataFrame:
    """Newest predictions: latest batch first, then the largest Id."""
    rows = pred.filter(F.col("PredictedSentiment").isNotNull())
    if product is not None:
        rows = rows.filter(F.col("ProductId") == product)
    columns = ["Id", "ProductId", "ProfileName", "Score", "PredictedSentiment", "Summary", "ProcessingTime"]
    return rows.orderBy(F.desc("batch_id"), *newest_first()).limit(n).select(*columns)


def freshness(monthly: DataFrame, products: DataFrame) -> DataFrame:
    """Latest aggregation stamp of each table and of both; an empty table gives null."""
    stamps = monthly.select(F.col("aggregated_at").alias("m"), F.lit(None).cast("timestamp_ntz").alias("p"))
    stamps = stamps.unionByName(
        products.select(F.lit(None).cast("timestamp_ntz").alias("m"), F.col("aggregated_at").alias("p"))
    )
    return stamps.agg(F.max("m").alias("m"), F.max("p").alias("p")).select(
        F.greatest("m", "p").alias("last_aggregated_at"),
        F.col("m").alias("monthly_last_aggregated_at"),
        F.col("p").alias("product_last_aggregated_at"),
    )


def latest_insight(history: DataFrame) -> DataFrame:
    """The newest insight document; status ``no_data`` before the first."""
    columns = [c for c in history.columns if c not in ("status", "errors")]
    newest = history.agg(F.max_by(F.struct("*"), F.col("evaluated_at")).alias("d"))
    return newest.select(
        *[F.col(f"d.{c}").alias(c) for c in columns],
        F.when(F.col("d").isNull(), F.lit("no_data")).otherwise(F.coalesce("d.status", F.lit("ok"))).alias("status"),
        F.coalesce("d.errors", F.array().cast("array<string>")).alias("errors"),
    )


def monthly_summary(trend: DataFrame) -> DataFrame:
    """One row: sum, mean per month, month with the best positive share and with the worst negative share.

    The earliest month wins a tie.
    """
    months = _total(trend).withColumn("_month", F.col("year") * 12 + F.col("month"))
    positive = numbers.ratio(F.col("positive"), F.col("total"))
    negative = numbers.ratio(F.col("negative"), F.col("total"))

    def best(share: Column) -> Column:
        return F.max_by(F.struct("label", share.alias("share")), F.struct(share, -F.col("_month")))

    out = months.agg(
        F.coalesce(F.sum("total"), F.lit(0)).cast("bigint").alias("total"),
        F.coalesce(F.avg("total"), F.lit(0.0)).alias("avg_per_month"),
        best(positive).alias("p"), best(negative).alias("n"),
    )
    return out.select(
        "total", "avg_per_month",
        F.col("p.label").alias("best_positive_month"), F.col("p.share").alias("best_positive_share"),
        F.col("n.label").alias("worst_negative_month"), F.col("n.share").alias("worst_negative_share"),
    )


def monthly_shares(trend: DataFrame) -> DataFrame:
    """Row total and percentages of every month."""
    return with_shares(_total(trend))


def total_predictions(pred: DataFrame) -> DataFrame:
    return pred.agg(F.count(F.lit(1)).alias("total"))


def score_vs_prediction(pred: DataFrame, product: str | None = None) -> DataFrame:
    """Predictions per product, customer score and predicted class."""
    rows = pred if product is None else pred.filter(F.col("ProductId") == product)
    return rows.groupBy("ProductId", "Score", "PredictedSentiment").agg(F.count(F.lit(1)).alias("count"))


def run_report(sent: DataFrame, pred: DataFrame) -> DataFrame:
    """One text line with the rows sent and the predictions stored."""
    counts = sent.agg(F.count(F.lit(1)).alias("sent")).withColumn(
        "stored", pred.agg(F.count(F.lit(1))).scalar()
    )
    line = F.format_string("Reviews sent this run : %d\nTotal predictions : %d", "sent", "stored")
    return counts.select(line.alias("report"))


def aggregation_report(monthly: DataFrame, products: DataFrame) -> DataFrame:
    """One text with the sizes of the two result tables."""
    counts = monthly.agg(F.count(F.lit(1)).alias("buckets")).withColumn(
        "products", products.agg(F.count(F.lit(1))).scalar()
    )
    line = F.format_string("Monthly buckets : %d\nProducts scored : %d", "buckets", "products")
    return counts.select(line.alias("report"))
