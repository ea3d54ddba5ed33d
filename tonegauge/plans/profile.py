"""Profiling queries."""

from pyspark.sql import functions as F

from tonegauge.operators import cleaning
from tonegauge.operators import profile as ops
from tonegauge.operators import text as text_ops
from tonegauge.plans import text
from tonegauge.plans import views_sql as v
from tonegauge.sources import views


def _named(spark, folder, users=False):
    return cleaning.with_sentiment(views.reviews(spark, folder, users))


def _docs(spark, folder):
    return cleaning.with_sentiment(views.doc_reviews(spark, folder))


def _rounded(df, digits=6, *columns):
    return df.select(*[F.round(c, digits).alias(c) if c in columns else F.col(c) for c in df.columns])


def e1_shape(spark, folder):
    return ops.shape(views.doc_reviews(spark, folder))


def e1_profile(spark, folder):
    rows = _named(spark, folder).drop("Summary")
    return _rounded(ops.profile(rows), 2, "mean", "std", "q25", "q50", "q75")


def e2_missing(spark, folder):
    rows = views.doc_reviews(spark, folder)
    holes = F.when(F.col("UserId") != "de", F.col("UserId"))
    return ops.missing(rows.withColumn("UserId", holes))


def e3_duplicates(spark, folder):
    docs = views.table(spark, folder, "documents")
    return ops.duplicates(docs.select(F.col("text").alias("Text"), "lang", "source"))


def e4_invalid_votes(spark, folder):
    return ops.invalid_votes(views.reviews(spark, folder))


def e5_score_distribution(spark, folder):
    return ops.distribution(views.reviews(spark, folder), "Score")


def e6_sentiment_distribution(spark, folder):
    return ops.distribution(_named(spark, folder), "Sentiment")


def e6_sentiment_balance(spark, folder):
    return _rounded(ops.sentiment_balance(_named(spark, folder)), 6, "positive_to_neutral")


def e7_date_span(spark, folder):
    out = ops.date_span(views.reviews(spark, folder))
    return out.select(F.col("first_day").cast("string").alias("first_day"),
                      F.col("last_day").cast("string").alias("last_day"), "years")


def e8_per_year(spark, folder):
    return ops.per_year(views.reviews(spark, folder))


def e9_year_by_sentiment(spark, folder):
    return ops.year_by_sentiment(_named(spark, folder))


def e10_avg_score(spark, folder):
    return _rounded(ops.avg_score(views.reviews(spark, folder)), 6, "mean_score")


def e11_word_counts(spark, folder):
    return ops.with_word_counts(_docs(spark, folder)).select("Id", "text_words", "summary_words")


def e11_word_count_summary(spark, folder):
    out = ops.numeric_summary(ops.with_word_counts(_docs(spark, folder)), ["text_words", "summary_words"])
    return _rounded(out, 2, "mean", "std", "q25", "q50", "q75")


def _bins(df):
    return _rounded(df, 6, "from", "to", "density")


def e12_word_histogram(spark, folder):
    rows = ops.with_word_counts(_docs(spark, folder))
    return _bins(ops.histogram(rows, F.col("text_words"), ["Sentiment"]))


def e12_helpfulness_histogram(spark, folder):
    rows = cleaning.helpfulness(_named(spark, folder))
    return _bins(ops.histogram(rows, F.col("helpfulness_ratio"), ["Sentiment"], bins=50, clip=None))


def e12_token_histogram(spark, folder):
    rows = text_ops.token_reduction(views.doc_texts(spark, folder))
    return _bins(ops.histogram(rows, F.col("filtered_count"), bins=50, clip=None))


def e13_box_stats(spark, folder):
    rows = ops.with_word_counts(_docs(spark, folder))
    return _rounded(ops.box_stats(rows, F.col("text_words"), ["Sentiment"], cap=300), 6, "q25", "q50", "q75")


def _with_outlier(spark, folder):
    """Text lengths, of which the smallest document's is a million million."""
    docs = _docs(spark, folder).withColumn("text_len", F.length("Text"))
    return docs.withColumn("text_len", F.when(F.col("Id") == "0", F.lit(1e12)).otherwise(F.col("text_len").cast("double")))


def e12_outlier_histogram(spark, folder):
    return _bins(ops.histogram(_with_outlier(spark, folder), F.col("text_len"), ["Sentiment"], bins=20))


def e13_outlier_box_stats(spark, folder):
    return _rounded(ops.box_stats(_with_outlier(spark, folder), F.col("text_len"), ["Sentiment"]), 6, "q25", "q50", "q75")


def e13_box_stats_by_score(spark, folder):
    rows = ops.with_text_length(views.doc_reviews(spark, folder)).filter(F.col("Score").isNotNull())
    return _rounded(ops.box_stats(rows, F.col("text_len"), ["Score"]), 6, "q25", "q50", "q75")


def e14_voted_share(spark, folder):
    return ops.voted_share(views.reviews(spark, folder))


def e15_top_products(spark, folder):
    return ops.top_n(views.reviews(spark, folder))


def e15_distincts(spark, folder):
    return ops.distincts(views.reviews(spark, folder, users=True))


def e16_product_sentiment(spark, folder):
    return ops.product_sentiment(_named(spark, folder), "P17")


def e17_user_activity(spark, folder):
    return ops.user_activity(views.reviews(spark, folder, users=True))


def e17_user_histogram(spark, folder):
    return _bins(ops.user_activity_histogram(views.reviews(spark, folder, users=True)))


def e18_examples(spark, folder):
    return ops.examples(_docs(spark, folder))


def e19_text_length(spark, folder):
    return ops.with_text_length(views.doc_texts(spark, folder)).select("Id", "text_len")


QUERIES = {
    name: run for name, run in globals().items()
    if callable(run) and name[0] == "e" and name[1:2].isdigit()
}

_NAMED = """CASE WHEN Score IS NULL THEN 'unknown' WHEN Score < 3 THEN 'negative' WHEN Score = 3 THEN 'neutral'
  ELSE 'positive' END AS Sentiment"""
_DOCS = v.DOC_REVIEWS + rf""",
docs AS (SELECT *, {_NAMED}, CAST(len(regexp_extract_all(Text, '\S+')) AS INT) AS text_words,
  CAST(len(regexp_extract_all(Summary, '\S+')) AS INT) AS summary_words, length(Text) AS text_len FROM doc_reviews)"""

_OUTLIER = "far AS (SELECT *, CASE WHEN Id = '0' THEN 1e12 ELSE CAST(text_len AS DOUBLE) END AS text_far FROM docs)"


def _numeric(name, column, source):
    return f"""SELECT '{name}' AS "column", count({column}) AS count, round(avg({column}), 2) AS mean,
      round(stddev_samp({column}), 2) AS std, CAST(min({column}) AS DOUBLE) AS min,
      round(quantile_cont({column}, 0.25), 2) AS q25, round(quantile_cont({column}, 0.5), 2) AS q50,
      round(quantile_cont({column}, 0.75), 2) AS q75, CAST(max({column}) AS DOUBLE) AS max FROM {source}"""


def _text(name):
    return f"""SELECT '{name}' AS "column", CAST(sum(n) AS BIGINT) AS count, NULL AS mean, NULL AS std, NULL AS min,
      NULL AS q25, NULL AS q50, NULL AS q75, NULL AS max, count(*) AS unique, arg_min(x, (-n, x)) AS top,
      max(n) AS freq FROM (SELECT {name} AS x, count(*) AS n FROM labelled WHERE {name} IS NOT NULL GROUP BY 1)"""


def histogram_sql(source, value, by, bins, clip):
    group, keys = (f"{by},", f"GROUP BY {by}") if by else ("", "")
    part = f"PARTITION BY {by}" if by else ""
    cut = f"least({value}, quantile_cont({value}, {clip}) OVER ({part}))" if clip else value
    same = f"USING ({by})" if by else "ON true"
    return f"""x AS (SELECT {group} CAST({cut} AS DOUBLE) AS x FROM {source} WHERE {value} IS NOT NULL),
      r0 AS (SELECT {group} min(x) AS lo, max(x) AS hi, count(*) AS total FROM x {keys}),
      r AS (SELECT {group} total, CASE WHEN lo = hi THEN lo - 0.5 ELSE lo END AS lo,
        CASE WHEN lo = hi THEN hi + 0.5 ELSE hi END AS hi FROM r0),
      b AS (SELECT {group} CAST(least(floor((x - lo) / ((hi - lo) / {bins})), {bins - 1}) AS BIGINT) AS bin,
        lo, (hi - lo) / {bins} AS w, total FROM x JOIN r {same})
      SELECT {group} bin, round(min(lo + bin * w), 6) AS "from", round(min(lo + (bin + 1) * w), 6) AS "to",
        count(*) AS count, round(count(*) / min(total * w), 6) AS density FROM b GROUP BY {group} bin"""


def _box(source, value, by):
    return f"""x AS (SELECT {by}, CAST({value} AS DOUBLE) AS x FROM {source}),
      q AS (SELECT {by}, quantile_cont(x, 0.25) AS q25, quantile_cont(x, 0.5) AS q50,
        quantile_cont(x, 0.75) AS q75 FROM x GROUP BY {by}),
      y AS (SELECT *, x BETWEEN q25 - 1.5 * (q75 - q25) AND q75 + 1.5 * (q75 - q25) AS inside FROM x JOIN q USING ({by}))
      SELECT {by}, round(min(q25), 6) AS q25, round(min(q50), 6) AS q50, round(min(q75), 6) AS q75,
        min(x) FILTER (inside) AS low_whisker, max(x) FILTER (inside) AS high_whisker,
        count(*) FILTER (NOT inside) AS outliers, count(*) AS count FROM y GROUP BY {by}"""


def _extra(kind, keys):
    return f"""SELECT '{kind}' AS kind, CAST(sum(n - 1) AS BIGINT) AS extra,
      {v.percent('sum(n - 1)', 'sum(n)', 2)} AS extra_pct
      FROM (SELECT count(*) AS n FROM documents GROUP BY {keys})"""


SQL = {
    "e1_shape": "SELECT count(*) AS rows, 7 AS columns FROM documents",
    "e1_profile": f"""WITH {v.LABELLED} """ + " UNION ALL ".join(
        _numeric(c, c, "labelled").replace(" FROM labelled", ", NULL AS unique, NULL AS top, NULL AS freq FROM labelled")
        for c in ["Score", "Time", "HelpfulnessNumerator", "HelpfulnessDenominator"]
    ) + " UNION ALL " + " UNION ALL ".join(_text(c) for c in ["Id", "ProductId", "Sentiment"]),
    "e2_missing": f"""WITH {v.DOC_REVIEWS}, m AS (
        SELECT 'Score' AS "column", count(*) FILTER (Score IS NULL) AS missing, count(*) AS n FROM doc_reviews
        UNION ALL SELECT 'UserId', count(*) FILTER (UserId = 'de'), count(*) FROM doc_reviews)
        SELECT "column", missing, {v.percent('missing', 'n', 2)} AS missing_pct FROM m WHERE missing > 0""",
    "e3_duplicates": _extra("row", "text, lang, source") + " UNION ALL " + _extra("text", "text"),
    "e4_invalid_votes": f"""WITH {v.REVIEWS} SELECT count(*) FILTER (HelpfulnessNumerator > HelpfulnessDenominator)
        AS invalid FROM reviews""",
    "e5_score_distribution": f"""WITH {v.REVIEWS}, c AS (SELECT Score, count(*) AS count FROM reviews GROUP BY 1),
        t AS (SELECT *, sum(count) OVER () AS n FROM c) SELECT Score, count, {v.percent('count', 'n')} AS share FROM t""",
    "e6_sentiment_distribution": f"""WITH {v.LABELLED}, c AS (SELECT Sentiment, count(*) AS count FROM labelled
        GROUP BY 1), t AS (SELECT *, sum(count) OVER () AS n FROM c)
        SELECT Sentiment, count, {v.percent('count', 'n')} AS share FROM t""",
    "e6_sentiment_balance": f"""WITH {v.LABELLED} SELECT count(*) FILTER (label = 0) AS negative,
        count(*) FILTER (label = 1) AS neutral, count(*) FILTER (label = 2) AS positive,
        round(count(*) FILTER (label = 2) / count(*) FILTER (label = 1), 6) AS positive_to_neutral FROM labelled""",
    "e7_date_span": f"""WITH {v.REVIEWS} SELECT CAST(min(day) AS VARCHAR) AS first_day,
        CAST(max(day) AS VARCHAR) AS last_day, CAST((max(Time) - min(Time)) // 86400 // 365 AS BIGINT) AS years
        FROM reviews""",
    "e8_per_year": f"WITH {v.REVIEWS} SELECT CAST(year(day) AS BIGINT) AS year, count(*) AS count FROM reviews GROUP BY 1",
    "e9_year_by_sentiment": f"""WITH {v.LABELLED} SELECT CAST(year(day) AS BIGINT) AS year,
        count(*) FILTER (label = 0) AS negative, count(*) FILTER (label = 1) AS neutral,
        count(*) FILTER (label = 2) AS positive FROM labelled GROUP BY 1""",
    "e10_avg_score": f"""WITH {v.REVIEWS} SELECT CAST(year(day) AS BIGINT) AS year, round(avg(Score), 6) AS mean_score,
        false AS overall FROM reviews GROUP BY 1
        UNION ALL SELECT NULL, round(avg(Score), 6), true FROM reviews""",
    "e11_word_counts": f"WITH {_DOCS} SELECT Id, text_words, summary_words FROM docs",
    "e11_word_count_summary": f"""WITH {_DOCS} {_numeric('text_words', 'text_words', 'docs')}
        UNION ALL {_numeric('summary_words', 'summary_words', 'docs')}""",
    "e12_word_histogram": f"WITH {_DOCS}, {histogram_sql('docs', 'text_words', 'Sentiment', 60, 0.99)}",
    "e12_helpfulness_histogram": f"""WITH {v.LABELLED}, h AS (
        SELECT *, HelpfulnessNumerator / HelpfulnessDenominator AS ratio FROM labelled
        WHERE HelpfulnessDenominator > 0), {histogram_sql('h', 'ratio', 'Sentiment', 50, None)}""",
    "e12_token_histogram": f"""WITH t AS ({text.SQL['t13_token_reduction']}),
        {histogram_sql('t', 'filtered_count', None, 50, None)}""",
    "e13_box_stats": f"WITH {_DOCS}, {_box('docs', 'least(text_words, 300)', 'Sentiment')}",
    "e12_outlier_histogram": f"""WITH {_DOCS}, {_OUTLIER}, {histogram_sql('far', 'text_far', 'Sentiment', 20, 0.99)}""",
    "e13_outlier_box_stats": f"WITH {_DOCS}, {_OUTLIER}, {_box('far', 'text_far', 'Sentiment')}",
    "e13_box_stats_by_score": f"""WITH {_DOCS}, scored AS (SELECT * FROM docs WHERE Score IS NOT NULL),
        {_box('scored', 'text_len', 'Score')}""",
    "e14_voted_share": f"""WITH {v.REVIEWS}, c AS (SELECT count(*) FILTER (HelpfulnessDenominator > 0) AS voted,
        count(*) AS n FROM reviews) SELECT voted, {v.percent('voted', 'n')} AS voted_pct FROM c""",
    "e15_top_products": f"""WITH {v.REVIEWS} SELECT ProductId, count(*) AS count FROM reviews GROUP BY 1
        ORDER BY 2 DESC, 1 LIMIT 15""",
    "e15_distincts": f"""WITH {v.REVIEWS} SELECT 'ProductId' AS "column", count(DISTINCT ProductId) AS distinct
        FROM reviews UNION ALL SELECT 'UserId', count(DISTINCT UserId) FROM reviews""",
    "e16_product_sentiment": f"""WITH {v.LABELLED}, s AS (SELECT unnest(['negative', 'neutral', 'positive']) AS name)
        SELECT name AS Sentiment, count(Id) AS count FROM s
        LEFT JOIN labelled ON Sentiment = name AND ProductId = 'P17' GROUP BY name""",
    "e17_user_activity": f"""WITH {v.REVIEWS}, u AS (SELECT UserId, count(*) AS n FROM reviews GROUP BY 1)
        SELECT count(*) FILTER (n = 1) AS users_with_one, count(*) FILTER (n > 10) AS users_over_ten,
        max(n) AS most_by_one FROM u""",
    "e17_user_histogram": f"""WITH {v.REVIEWS}, u AS (SELECT least(count(*), 20) AS n FROM reviews GROUP BY UserId),
        {histogram_sql('u', 'n', None, 20, None)}""",
    "e18_examples": f"""WITH {_DOCS} SELECT Id, Sentiment, Score, Summary, substr(Text, 1, 400) AS Text FROM docs
        WHERE Sentiment <> 'unknown'
        QUALIFY row_number() OVER (PARTITION BY Sentiment ORDER BY md5('42:' || Id), Id) = 1""",
    "e19_text_length": "SELECT CAST(doc_id AS VARCHAR) AS Id, CAST(length(text) AS INT) AS text_len FROM documents",
}
