"""Dashboard tables, drift and delivery checks."""

from pyspark.sql import functions as F

from tonegauge.functions import labels
from tonegauge.operators import cleaning, delivery, drift
from tonegauge.operators import dashboard as ops
from tonegauge.plans import views_sql as v
from tonegauge.sources import views


def _flat(scoring):
    """Entries of the scored table as one text, so that any engine compares them."""
    parts = F.transform("sentiments", lambda e: F.concat_ws(":", e["sentiment"], e["count"].cast("string")))
    return scoring.select("product", F.array_join(parts, ",").alias("sentiments"), "total", "total_all")


def _mixed_case(spark, folder):
    """Predictions whose class names differ in case, with some unknown ones."""
    names = [*labels.SENTIMENTS, *[n.capitalize() for n in labels.SENTIMENTS]]
    place = F.col("prediction").cast("int") + F.when(F.col("Score") == 5, 3).otherwise(0)
    unknown = (F.col("Score") == 1) & (F.col("HelpfulnessDenominator") == 0)
    named = F.get(F.array(*[F.lit(n) for n in names]), F.when(~unknown, place))
    return views.predictions(spark, folder).withColumn(
        "PredictedSentiment", F.coalesce(named, F.lit(labels.UNKNOWN))
    )


def a1_overall_stats(spark, folder):
    return ops.overall_stats(_mixed_case(spark, folder))


def a2_overall_from_monthly(spark, folder):
    return ops.overall_from_monthly(ops.monthly_sentiment(_mixed_case(spark, folder)))


def a3_monthly_sentiment(spark, folder):
    out = ops.monthly_sentiment(views.predictions(spark, folder))
    return out.select(F.col("year").cast("bigint").alias("year"), F.col("month").cast("bigint").alias("month"),
                      "sentiment", "count")


def _trend(df):
    return df.select(F.col("year").cast("bigint").alias("year"), F.col("month").cast("bigint").alias("month"),
                     "label", *ops.REPORTED)


def a4_live_trend(spark, folder):
    """Moments written in three ways, some not dates, some only as a number in Time."""
    rows = _mixed_case(spark, folder)
    kind = F.col("HelpfulnessDenominator")
    written = F.concat(
        F.replace(F.col("ProcessingTime"), F.lit(" "), F.when(kind == 0, "T").otherwise(" ")),
        F.when(kind == 0, "Z").otherwise(""),
    )
    shapes = (
        F.when(kind == 1, F.lit("")).when((kind == 2) & (F.col("Score") == 3), F.lit("last week")).otherwise(written)
    )
    return _trend(ops.live_trend(rows.withColumn("ProcessingTime", shapes)))


def a4_live_trend_text_time(spark, folder):
    """Only text times: digits are skipped, full dates count."""
    digits = F.col("HelpfulnessDenominator") == 2
    time = F.when(digits, F.col("Time").cast("string")).otherwise(F.col("ProcessingTime"))
    rows = views.predictions(spark, folder).withColumn("Time", time).drop("ProcessingTime")
    return _trend(ops.live_trend(rows))


def a5_trend_from_monthly(spark, folder):
    return _trend(ops.trend_from_monthly(ops.monthly_sentiment(_mixed_case(spark, folder))))


def a6_product_scoring(spark, folder):
    return _flat(ops.product_scoring(_mixed_case(spark, folder)))


def a7_top_products(spark, folder):
    product = F.when(F.col("HelpfulnessDenominator") != 3, F.col("ProductId"))
    return ops.top_products(views.predictions(spark, folder).withColumn("ProductId", product))


def a7_top_products_scored(spark, folder):
    return ops.top_products_from_scoring(ops.product_scoring(views.predictions(spark, folder)))


def a8_top_products_sentiment(spark, folder):
    return ops.top_products_sentiment(ops.product_scoring(_mixed_case(spark, folder)))


def a9_score_product(spark, folder):
    pred = views.predictions(spark, folder)
    return ops.score_product("P17", ops.product_scoring(pred), pred)


def a9_score_missing_product(spark, folder):
    pred = views.predictions(spark, folder)
    return ops.score_product("P0000", None, pred)


def a9_score_all_products(spark, folder):
    """Products whose id ends in 7 are missing from the stored table and come from the predictions."""
    pred = views.predictions(spark, folder)
    stored = ops.product_scoring(pred.filter(~F.col("ProductId").endswith("7")))
    return ops.score_all_products(stored, pred)


def a10_recent(spark, folder):
    return ops.recent(views.predictions(spark, folder, users=True), 20)


def a10_recent_of_product(spark, folder):
    return ops.recent(views.predictions(spark, folder, users=True), 50, product="P17")


def _status(df):
    return df.withColumn("alerts", F.array_join("alerts", "; ")).select(
        *[c for c in df.columns if c not in ("neutral_ratio", "negative_ratio", "alerts")],
        F.round("neutral_ratio", 6).alias("neutral_ratio"),
        F.round("negative_ratio", 6).alias("negative_ratio"), "alerts",
    )


def a11a_drift(spark, folder):
    return _status(drift.drift(views.predictions(spark, folder)))


def a11b_drift_per_product(spark, folder):
    """The same check per product: small products have too little data, some exceed a limit."""
    counts = ops.live_product_counts(views.predictions(spark, folder)).select("product", "total", *ops.REPORTED)
    return _status(drift.with_drift(counts, minimum=30))


def _drift_history(spark, folder):
    per_year = ops.trend_from_monthly(ops.monthly_sentiment(views.predictions(spark, folder)))
    counts = per_year.groupBy("year").agg(*[F.sum(s).cast("bigint").alias(s) for s in ops.REPORTED])
    counts = counts.withColumn("total", F.col("positive") + F.col("neutral") + F.col("negative"))
    return drift.with_drift(counts).withColumn("evaluated_at", F.col("year").cast("string"))


def a11c_latest_drift(spark, folder):
    return _status(drift.latest_drift(_drift_history(spark, folder)))


def a12_freshness(spark, folder):
    pred = views.predictions(spark, folder)
    stamp = F.to_timestamp_ntz(F.col("ProcessingTime"))
    stamps = ops.freshness(
        pred.filter(F.col("Score") < 3).select(stamp.alias("aggregated_at")),
        pred.filter(F.col("Score") >= 3).select(stamp.alias("aggregated_at")),
    )
    return stamps.select(*[F.date_format(c, "yyyy-MM-dd HH:mm:ss").alias(c) for c in stamps.columns])


def a14_monthly_summary(spark, folder):
    out = ops.monthly_summary(ops.trend_from_monthly(ops.monthly_sentiment(views.predictions(spark, folder))))
    digits = ["avg_per_month", "best_positive_share", "worst_negative_share"]
    return out.select(*[F.round(c, 6).alias(c) if c in digits else F.col(c) for c in out.columns])


def a15_monthly_shares(spark, folder):
    trend = ops.monthly_shares(ops.trend_from_monthly(ops.monthly_sentiment(views.predictions(spark, folder))))
    return trend.drop("year", "month")


def a15_overall_shares(spark, folder):
    return ops.with_shares(ops.overall_stats(views.predictions(spark, folder)))


def a16_total_predictions(spark, folder):
    return ops.total_predictions(views.predictions(spark, folder))


def a17_weekly_report(spark, folder):
    return drift.weekly_report(drift.drift(views.predictions(spark, folder)))


def a17_run_report(spark, folder):
    return ops.run_report(views.table(spark, folder, "events"), views.predictions(spark, folder))


def a17_aggregation_report(spark, folder):
    pred = views.predictions(spark, folder)
    return ops.aggregation_report(ops.monthly_sentiment(pred), ops.product_scoring(pred))


def a18_score_vs_prediction(spark, folder):
    return ops.score_vs_prediction(views.predictions(spark, folder))


def p16_product_filter(spark, folder):
    rows = cleaning.with_sentiment(views.reviews(spark, folder)).filter(F.col("ProductId") == "P17")
    return rows.select("Id", "ProductId", "Sentiment")


def r7_delivery_check(spark, folder):
    sent = cleaning.with_sentiment(views.reviews(spark, folder)).select("Id", F.col("Sentiment").alias("expected"))
    stored = views.predictions(spark, folder).filter(F.md5(F.col("Id").cast("binary")) < "e")
    return delivery.delivery_check(sent, stored)


QUERIES = {
    name: run for name, run in globals().items()
    if callable(run) and name[0] in "apr" and name[1:2].isdigit()
}

_UNKNOWN_CASE = """CASE WHEN Score = 5 THEN upper(substr(PredictedSentiment, 1, 1)) || substr(PredictedSentiment, 2)
  WHEN Score = 1 AND HelpfulnessDenominator = 0 THEN 'unknown' ELSE PredictedSentiment END"""
_MIXED = v.PREDICTIONS + f", mixed AS (SELECT * REPLACE ({_UNKNOWN_CASE} AS PredictedSentiment) FROM predictions)"
_NAMES = ["positive", "neutral", "negative"]
_PCTS = ", ".join(f"{v.percent(s, 'total')} AS {s}_pct" for s in _NAMES)
_SUMMED = f"""SELECT positive + neutral + negative AS total, positive, neutral, negative
  FROM (SELECT {v.counts('PredictedSentiment')} FROM %s)"""
_TREND = f"""SELECT CAST(year(day) AS BIGINT) AS year, CAST(month(day) AS BIGINT) AS month,
  strftime(min(day), '%%b''%%y') AS label, {v.counts('PredictedSentiment')}
  FROM %s WHERE lower(PredictedSentiment) IN ('positive', 'neutral', 'negative') GROUP BY 1, 2"""
_PRODUCTS = f"""per_product AS (SELECT *, positive + neutral + negative AS total FROM (
  SELECT ProductId AS product, count(*) AS total_all, {v.counts('PredictedSentiment')} FROM %s GROUP BY 1))"""


def _drift(total_at_least: int) -> str:
    def alert(s, limit):
        pct = v.percent(s, "total", 2)
        return (
            f"CASE WHEN {s}_ratio > {limit} THEN printf('{s.upper()} drift: %.2f%% > {limit * 100:.0f}%% threshold',"
            f" {pct}) END"
        )

    return f"""
      ratios AS (SELECT *, {', '.join(
          f"CASE WHEN total >= {total_at_least} THEN {v.share(s, 'total')} ELSE 0.0 END AS {s}_ratio"
          for s in ['neutral', 'negative'])} FROM counted),
      status AS (SELECT *, concat_ws('; ', {alert('neutral', 0.3)}, {alert('negative', 0.4)}) AS alerts,
        CASE WHEN total < {total_at_least} THEN 'insufficient_data' END AS reason FROM ratios)
      """


_STATUS = """total, positive, neutral, negative, reason, alerts <> '' AS drift_detected, alerts,
  round(neutral_ratio, 6) AS neutral_ratio, round(negative_ratio, 6) AS negative_ratio"""
_MONTHS = f"months AS ({_TREND % 'predictions'}), totals AS (SELECT *, positive + neutral + negative AS total FROM months)"

SQL = {
    "a1_overall_stats": f"WITH {_MIXED} {_SUMMED % 'mixed'}",
    "a2_overall_from_monthly": f"WITH {_MIXED} {_SUMMED % 'mixed'}",
    "a3_monthly_sentiment": f"""WITH {v.PREDICTIONS} SELECT CAST(year(day) AS BIGINT) AS year,
        CAST(month(day) AS BIGINT) AS month, PredictedSentiment AS sentiment, count(*) AS count
        FROM predictions GROUP BY 1, 2, 3""",
    "a4_live_trend": f"""WITH {_MIXED}, dated AS (SELECT * FROM mixed
        WHERE NOT (HelpfulnessDenominator = 2 AND Score = 3)) {_TREND % 'dated'}""",
    "a4_live_trend_text_time": f"""WITH {v.PREDICTIONS}, dated AS (SELECT * FROM predictions
        WHERE HelpfulnessDenominator <> 2) {_TREND % 'dated'}""",
    "a5_trend_from_monthly": f"WITH {_MIXED} {_TREND % 'mixed'}",
    "a6_product_scoring": f"""WITH {_MIXED}, counted AS (
        SELECT ProductId AS product, PredictedSentiment AS s, count(*) AS c FROM mixed GROUP BY 1, 2)
        SELECT product, string_agg(s || ':' || c, ',' ORDER BY s) AS sentiments,
          CAST(coalesce(sum(c) FILTER (lower(s) IN ('positive', 'neutral', 'negative')), 0) AS BIGINT) AS total,
          CAST(sum(c) AS BIGINT) AS total_all
        FROM counted GROUP BY product""",
    "a7_top_products": f"""WITH {v.PREDICTIONS}, holes AS (
        SELECT CASE WHEN HelpfulnessDenominator <> 3 THEN ProductId END AS p FROM predictions),
        counted AS (SELECT p, count(*) AS count FROM holes GROUP BY p ORDER BY count DESC, p NULLS FIRST LIMIT 8)
        SELECT coalesce(p, 'Unknown') AS product, count FROM counted""",
    "a7_top_products_scored": f"""WITH {v.PREDICTIONS} SELECT ProductId AS product, count(*) AS count
        FROM predictions GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 8""",
    "a8_top_products_sentiment": f"""WITH {_MIXED}, {_PRODUCTS % 'mixed'}
        SELECT product, total, positive, neutral, negative, {_PCTS}
        FROM per_product ORDER BY total_all DESC, product LIMIT 8""",
    "a9_score_product": f"""WITH {v.PREDICTIONS}, {_PRODUCTS % "predictions"}
        SELECT product, total, positive, neutral, negative, {_PCTS} FROM per_product WHERE product = 'P17'""",
    "a9_score_missing_product": f"""WITH {v.PREDICTIONS}, c AS (
        {_SUMMED % "predictions WHERE ProductId = 'P0000'"}) SELECT 'P0000' AS product, *, {_PCTS} FROM c""",
    "a9_score_all_products": f"""WITH {v.PREDICTIONS}, {_PRODUCTS % 'predictions'}
        SELECT product, total, positive, neutral, negative, {_PCTS} FROM per_product""",
    "a10_recent": f"""WITH {v.PREDICTIONS} SELECT Id, ProductId, ProfileName, Score, PredictedSentiment, Summary,
        ProcessingTime FROM predictions ORDER BY batch_id DESC, Id DESC LIMIT 20""",
    "a10_recent_of_product": f"""WITH {v.PREDICTIONS} SELECT Id, ProductId, ProfileName, Score, PredictedSentiment,
        Summary, ProcessingTime FROM predictions WHERE ProductId = 'P17' ORDER BY batch_id DESC, Id DESC LIMIT 50""",
    "a11a_drift": f"""WITH {v.PREDICTIONS}, counted AS ({_SUMMED % 'predictions'}), {_drift(100)}
        SELECT {_STATUS} FROM status""",
    "a11b_drift_per_product": f"""WITH {v.PREDICTIONS}, {_PRODUCTS % 'predictions'},
        counted AS (SELECT * FROM per_product), {_drift(30)} SELECT product, {_STATUS} FROM status""",
    "a11c_latest_drift": f"""WITH {v.PREDICTIONS}, counted AS (
        SELECT *, positive + neutral + negative AS total FROM (
          SELECT CAST(year(day) AS VARCHAR) AS evaluated_at, {v.counts('PredictedSentiment')}
          FROM predictions GROUP BY 1)), {_drift(100)}
        SELECT evaluated_at, {_STATUS} FROM status ORDER BY evaluated_at DESC LIMIT 1""",
    "a12_freshness": f"""WITH {v.PREDICTIONS}, m AS (SELECT max(ProcessingTime) FILTER (Score < 3) AS a,
        max(ProcessingTime) FILTER (Score >= 3) AS b FROM predictions)
        SELECT greatest(a, b) AS last_aggregated_at, a AS monthly_last_aggregated_at,
        b AS product_last_aggregated_at FROM m""",
    "a14_monthly_summary": f"""WITH {v.PREDICTIONS}, {_MONTHS},
        good AS (SELECT label, positive / total AS r FROM totals ORDER BY r DESC, year, month LIMIT 1),
        bad AS (SELECT label, negative / total AS r FROM totals ORDER BY r DESC, year, month LIMIT 1)
        SELECT CAST(sum(total) AS BIGINT) AS total, round(avg(total), 6) AS avg_per_month,
          (SELECT label FROM good) AS best_positive_month, (SELECT round(r, 6) FROM good) AS best_positive_share,
          (SELECT label FROM bad) AS worst_negative_month, (SELECT round(r, 6) FROM bad) AS worst_negative_share
        FROM totals""",
    "a15_monthly_shares": f"""WITH {v.PREDICTIONS}, {_MONTHS}
        SELECT label, positive, neutral, negative, total, {_PCTS} FROM totals""",
    "a15_overall_shares": f"WITH {v.PREDICTIONS}, c AS ({_SUMMED % 'predictions'}) SELECT *, {_PCTS} FROM c",
    "a16_total_predictions": "SELECT count(*) AS total FROM lineitem",
    "a17_weekly_report": f"""WITH {v.PREDICTIONS}, counted AS ({_SUMMED % 'predictions'}), {_drift(100)}
        SELECT concat_ws(chr(10), printf('Total predictions : %d', total), {', '.join(
            f"printf('{s.capitalize():10s} : %6d (%.1f%%)', {s}, {v.percent(s, 'total')})" for s in _NAMES)},
          CASE WHEN alerts <> '' THEN 'STATUS : DRIFT DETECTED' ELSE 'STATUS : HEALTHY' END,
          nullif(replace(alerts, '; ', chr(10)), '')) AS report FROM status""",
    "a17_run_report": """SELECT printf('Reviews sent this run : %d', (SELECT count(*) FROM events)) || chr(10)
        || printf('Total predictions : %d', (SELECT count(*) FROM lineitem)) AS report""",
    "a17_aggregation_report": f"""WITH {v.PREDICTIONS} SELECT printf('Monthly buckets : %d',
        count(DISTINCT (year(day), month(day), PredictedSentiment))) || chr(10)
        || printf('Products scored : %d', count(DISTINCT ProductId)) AS report FROM predictions""",
    "a18_score_vs_prediction": f"""WITH {v.PREDICTIONS} SELECT ProductId, Score, PredictedSentiment,
        count(*) AS count FROM predictions GROUP BY ALL""",
    "p16_product_filter": f"""WITH {v.LABELLED} SELECT Id, ProductId, Sentiment FROM labelled
        WHERE ProductId = 'P17'""",
    "r7_delivery_check": f"""WITH {v.PREDICTIONS}, sent AS (SELECT Id, CASE WHEN Score < 3 THEN 'negative'
        WHEN Score = 3 THEN 'neutral' ELSE 'positive' END AS expected FROM reviews),
        stored AS (SELECT Id, arg_max(PredictedSentiment, (batch_id, PredictedSentiment)) AS PredictedSentiment
          FROM predictions WHERE h < 'e' GROUP BY Id)
        SELECT sent.Id, expected, coalesce(PredictedSentiment, 'not_found') AS predicted,
          PredictedSentiment IS NOT NULL AS found, coalesce(PredictedSentiment = expected, false) AS agrees
        FROM sent LEFT JOIN stored USING (Id)""",
}
