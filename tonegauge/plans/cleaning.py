"""Cleaning, labels, sources and splits."""

from pyspark.sql import functions as F

from tonegauge.functions import clock, labels, numbers
from tonegauge.functions import text as words
from tonegauge.operators import cleaning as ops
from tonegauge.operators import splits
from tonegauge.plans import views_sql as v
from tonegauge.sources import reviews as src
from tonegauge.sources import storage, views

MESSAGE_TIME = 1700000000


def _labelled(spark, folder):
    return ops.labelled(views.reviews(spark, folder))


def _doc_votes(spark, folder):
    """Documents as reviews with votes that break the rules now and then, some texts null or empty."""
    number = F.col("Id").cast("bigint")
    text = F.when(number % 17 == 0, F.lit(None)).when(number % 19 == 0, F.lit("")).otherwise(F.col("Text"))
    return views.doc_texts(spark, folder).select(
        number.alias("Id"), text.alias("Text"),
        F.when(number % 5 != 0, F.concat(F.lit("s"), number)).alias("Summary"),
        (number % 4).cast("int").alias("HelpfulnessNumerator"),
        (number % 3).cast("int").alias("HelpfulnessDenominator"),
    )


DOC_VOTES = """
doc_votes AS (
  SELECT doc_id AS Id,
    CASE WHEN doc_id % 17 = 0 THEN NULL WHEN doc_id % 19 = 0 THEN '' ELSE text END AS Text,
    CASE WHEN doc_id % 5 <> 0 THEN concat('s', doc_id) END AS Summary,
    CAST(doc_id % 4 AS INT) AS HelpfulnessNumerator, CAST(doc_id % 3 AS INT) AS HelpfulnessDenominator
  FROM documents)
"""


def s1_review_scan(spark, folder):
    """Documents written as review files and read back with their types."""
    path = storage.shared_dir(spark, "reviews")
    src.write_review_text(views.doc_reviews(spark, folder), path)
    return src.read_reviews(spark, path).select("Id", "ProductId", "UserId", "HelpfulnessNumerator", "Score", "Time", "Summary", "Text")


def s2_quoted_csv(spark, folder):
    """Fields with quotes, commas and line breaks of both kinds, in review files whose splits end inside fields."""
    path = storage.shared_dir(spark, "reviews")
    said = F.concat(F.lit('"'), F.replace("text", F.lit(". "), F.lit('.",\r\n"')), F.lit('"'))
    docs = views.table(spark, folder, "documents").select(
        F.col("doc_id").alias("Id"), F.col("source").alias("ProductId"), said.alias("Summary"), F.col("text").alias("Text")
    )
    src.write_review_text(docs, path)
    return src.read_review_text(spark, path, strict=True).select("Id", "ProductId", "Summary", "Text")


def s3_slim(spark, folder):
    return src.slim(views.doc_reviews(spark, folder))


def _messages(spark, folder):
    records = src.with_file_position(views.table(spark, folder, "events"))
    shaped = event_columns(records)
    return src.to_messages(shaped, MESSAGE_TIME, "position")


def event_columns(events):
    key = F.get_json_object("props", "$.k").cast("bigint")
    number = F.col("event_id")
    return events.select(
        F.when(number % 7 == 0, F.lit("")).otherwise(number.cast("string")).alias("ID"),
        F.concat(F.lit("P"), key).alias("productid"),
        F.col("user_id").cast("string").alias("USERID"),
        (1 + key % 5).cast("string").alias("score"),
        F.when(number % 11 != 0, clock.epoch_seconds(F.col("ts").cast("timestamp_ntz")).cast("string")).alias("TIME"),
        F.col("event_type").alias("summary"),
        "file", "position",
    )


def s5_bounded(spark, folder):
    events = src.with_file_position(views.table(spark, folder, "events"))
    return src.bounded(events, 50).select("event_id", "event_type", "position")


def s5_bounded_per_file(spark, folder):
    events = src.with_file_position(views.table(spark, folder, "events"))
    return src.bounded(events, 120, per_file=True).select("event_id", "event_type", "position")


def s8_decode(spark, folder):
    return src.decode(views.event_messages(spark, folder))


def s10_feature_set(spark, folder):
    """Feature vectors with their row's fields, written and read back; vectors are shown by length, first number and sum."""
    from pyspark.ml.functions import vector_to_array

    path = storage.shared_dir(spark, "features")
    rows = views.vectors(spark, folder).withColumn("Sentiment", F.lit("neutral"))
    storage.save_features(splits.stratified_split(rows).select("Id", "label", "split", "features"), path)
    numbers = vector_to_array(F.col("features"))
    total = F.aggregate(numbers, F.lit(0.0), lambda a, x: a + x)
    return storage.load_features(spark, path).select(
        "Id", "label", "split", F.size(numbers).alias("length"), F.get(numbers, F.lit(0)).alias("first"), F.round(total, 9).alias("total")
    )


def s11_split_files(spark, folder):
    path = storage.shared_dir(spark, "splits")
    rows = ops.labelled(views.reviews(spark, folder)).select("Id", "ProductId", "Score", "Time", "Sentiment")
    storage.save_splits(splits.stratified_split(rows), path)
    schema = "Id string, ProductId string, Score int, Time bigint, Sentiment string, split string"
    written = spark.read.schema(schema).option("header", True).option("escape", '"').csv(path)
    return written


def p1_drop_empty_text(spark, folder):
    return ops.drop_empty_text(_doc_votes(spark, folder)).select("Id", "Text")


def p2_dedupe_text(spark, folder):
    return ops.dedupe_text(views.doc_texts(spark, folder).withColumn("Id", F.col("Id").cast("bigint")))


def p3_valid_helpfulness(spark, folder):
    kept = ops.valid_helpfulness(views.reviews(spark, folder))
    return kept.select("Id", "HelpfulnessNumerator", "HelpfulnessDenominator")


def p4_fill_summary(spark, folder):
    return ops.fill_summary(_doc_votes(spark, folder)).select("Id", "Summary")


def p5_sentiment(spark, folder):
    return ops.with_sentiment(views.doc_reviews(spark, folder)).select("Id", "Score", "Sentiment")


def p6_label(spark, folder):
    return _labelled(spark, folder).select("Id", "Sentiment", "label")


def p6b_index_label(spark, folder):
    rows = ops.with_sentiment(views.doc_reviews(spark, folder)).select("Id", "Sentiment")
    return ops.index_label(rows)


def p7_fixed_weights(spark, folder):
    return ops.fixed_weights(_labelled(spark, folder)).select("Id", "label", "classWeight")


def p8_balanced_weights(spark, folder):
    return ops.balanced_weights(_labelled(spark, folder)).select(
        "Id", "label", F.round("classWeight", 6).alias("classWeight")
    )


def p9_fuse_text(spark, folder):
    return ops.fuse_text(ops.fill_summary(_doc_votes(spark, folder))).select("Id", "Text")


def p10_normalise_text(spark, folder):
    return views.doc_texts(spark, folder).select(
        "Id", words.normalise(F.col("Text")).alias("clean"), words.letters_only(F.col("Text")).alias("letters")
    )


def p11_guards(spark, folder):
    """How many rows each guard of the aggregations lets through, on predictions with gaps in every field."""
    rows = views.predictions(spark, folder)
    h = F.md5(F.col("Id").cast("binary"))
    gaps = rows.select(
        F.when(F.substring(h, 5, 1) != "0", F.col("PredictedSentiment")).alias("PredictedSentiment"),
        F.when(F.substring(h, 6, 1) != "0", F.col("ProductId")).alias("ProductId"),
        F.when(F.substring(h, 7, 1) == "0", F.lit("soon"))
        .when(F.substring(h, 8, 1) != "0", F.col("Time").cast("string")).alias("Time"),
    )
    from tonegauge.operators import dashboard

    monthly = dashboard.monthly_sentiment(gaps).agg(F.sum("count").alias("monthly_rows"))
    return monthly.withColumn(
        "product_rows", dashboard.product_scoring(gaps).agg(F.sum("total_all")).scalar()
    )


def p12_decode_prediction(spark, folder):
    code = F.when(F.col("Score") < 5, F.col("Score").cast("double"))
    return views.reviews(spark, folder).select(
        "Id", labels.sentiment_of_label(code).alias("name")
    )


def p13_event_date(spark, folder):
    time = F.when(F.col("HelpfulnessDenominator") == 0, F.concat(F.col("Time"), F.lit(".5"))).otherwise(
        F.col("Time").cast("string")
    )
    return views.reviews(spark, folder).select("Id", time.alias("raw")).select(
        "Id", clock.event_date(F.col("raw")).cast("string").alias("day"),
        clock.event_time(F.col("raw")).alias("moment"),
    )


def p14_prediction_view(spark, folder):
    rows = ops.prediction_view(views.predictions(spark, folder, users=True).withColumn("Text", F.col("Summary")))
    return rows.withColumn("max_prob", F.round("max_prob", 6))


def p15_search(spark, folder):
    return ops.search(views.predictions(spark, folder, users=True), "p11").select("Id", "ProductId", "ProfileName")


def p15_search_profile(spark, folder):
    return ops.search(views.predictions(spark, folder, users=True), "READER 7").select("Id", "ProfileName")


def p17_helpfulness(spark, folder):
    return ops.helpfulness(views.reviews(spark, folder)).select(
        "Id", F.round("helpfulness_ratio", 6).alias("helpfulness_ratio")
    )


def p18_clean_audit(spark, folder):
    return ops.clean_audit(_doc_votes(spark, folder))


def c1_stratified_split(spark, folder):
    return splits.stratified_split(_labelled(spark, folder)).select("Id", "Sentiment", "split")


def c2_approx_split(spark, folder):
    return splits.approx_split(_labelled(spark, folder)).select("Id", "Sentiment", "split")


def c3_random_split(spark, folder):
    rows = views.reviews(spark, folder)
    two = splits.random_split(rows, (("train", 0.7), ("test", 0.3)))
    return two.select("Id", "split")


def c4_sample(spark, folder):
    return splits.sample(views.reviews(spark, folder), 0.1).select("Id", "Score")


def c5_sample_n(spark, folder):
    return splits.sample_n(views.reviews(spark, folder), 5000).select("Id", "Score")


def c5_sample_per_class(spark, folder):
    return splits.sample_n(_labelled(spark, folder), 1, by="Sentiment").select("Id", "Sentiment")


def c6_split_audit(spark, folder):
    return splits.split_audit(splits.stratified_split(_labelled(spark, folder)))


QUERIES = {
    "s3_slim": s3_slim,
    "s4_messages": _messages,
    "s5_bounded": s5_bounded,
    "s5_bounded_per_file": s5_bounded_per_file,
    "s8_decode": s8_decode,
    "s1_review_scan": s1_review_scan,
    "s2_quoted_csv": s2_quoted_csv,
    "s10_feature_set": s10_feature_set,
    "s11_split_files": s11_split_files,
    "p1_drop_empty_text": p1_drop_empty_text,
    "p2_dedupe_text": p2_dedupe_text,
    "p3_valid_helpfulness": p3_valid_helpfulness,
    "p4_fill_summary": p4_fill_summary,
    "p5_sentiment": p5_sentiment,
    "p6_label": p6_label,
    "p6b_index_label": p6b_index_label,
    "p7_fixed_weights": p7_fixed_weights,
    "p8_balanced_weights": p8_balanced_weights,
    "p9_fuse_text": p9_fuse_text,
    "p10_normalise_text": p10_normalise_text,
    "p11_guards": p11_guards,
    "p12_decode_prediction": p12_decode_prediction,
    "p13_event_date": p13_event_date,
    "p14_prediction_view": p14_prediction_view,
    "p15_search": p15_search,
    "p15_search_profile": p15_search_profile,
    "p17_helpfulness": p17_helpfulness,
    "p18_clean_audit": p18_clean_audit,
    "c1_stratified_split": c1_stratified_split,
    "c2_approx_split": c2_approx_split,
    "c3_random_split": c3_random_split,
    "c4_sample": c4_sample,
    "c5_sample_n": c5_sample_n,
    "c5_sample_per_class": c5_sample_per_class,
    "c6_split_audit": c6_split_audit,
}

_SPLIT = v.LABELLED + """,
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY Sentiment ORDER BY md5('42:' || Id), Id) AS rn,
    count(*) OVER (PARTITION BY Sentiment) AS n FROM labelled),
split AS (
  SELECT *, CASE WHEN rn <= n * 8 // 10 THEN 'train' WHEN rn <= n * 8 // 10 + n // 10 THEN 'val' ELSE 'test' END
    AS split FROM ranked)
"""
_EVENT_KEY = "CAST(json_extract_string(props, '$.k') AS BIGINT)"

SQL = {
    "s3_slim": f"""WITH {v.DOC_REVIEWS}
        SELECT CAST(Id AS BIGINT) AS id, CAST(Score AS INT) AS score, Summary AS summary, Text AS text
        FROM doc_reviews WHERE Score IS NOT NULL""",
    "s4_messages": f"""
        WITH placed AS (SELECT *, row_number() OVER (ORDER BY event_id) AS place FROM events)
        SELECT CASE WHEN event_id % 7 = 0 THEN printf('TEST_%03d', place) ELSE CAST(event_id AS VARCHAR) END AS Id,
          concat('P', {_EVENT_KEY}) AS ProductId, CAST(user_id AS VARCHAR) AS UserId,
          CAST(NULL AS VARCHAR) AS ProfileName, CAST(NULL AS VARCHAR) AS HelpfulnessNumerator,
          CAST(NULL AS VARCHAR) AS HelpfulnessDenominator,
          CAST(1 + {_EVENT_KEY} % 5 AS VARCHAR) AS Score,
          CASE WHEN event_id % 11 = 0 THEN '{MESSAGE_TIME}'
            ELSE CAST(CAST(floor(epoch(ts)) AS BIGINT) AS VARCHAR) END AS Time,
          event_type AS Summary, CAST(NULL AS VARCHAR) AS Text
        FROM placed""",
    "s5_bounded": """SELECT event_id, event_type, row_number() OVER (ORDER BY event_id) AS position
        FROM events ORDER BY event_id LIMIT 50""",
    "s5_bounded_per_file": """SELECT event_id, event_type, row_number() OVER (ORDER BY event_id) AS position
        FROM events ORDER BY event_id LIMIT 120""",
    "s8_decode": f"""
        SELECT CASE WHEN ok THEN CAST(event_id AS VARCHAR) END AS Id,
          CASE WHEN ok THEN concat('P', k) END AS ProductId,
          CASE WHEN ok THEN CAST(user_id AS VARCHAR) END AS UserId,
          CAST(NULL AS VARCHAR) AS ProfileName, CAST(NULL AS VARCHAR) AS HelpfulnessNumerator,
          CAST(NULL AS VARCHAR) AS HelpfulnessDenominator,
          CASE WHEN ok THEN CAST(1 + k % 5 AS VARCHAR) END AS Score,
          CASE WHEN ok THEN CAST(CAST(floor(epoch(ts)) AS BIGINT) AS VARCHAR) END AS Time,
          CASE WHEN ok THEN event_type END AS Summary,
          CASE WHEN ok AND event_id % 5 <> 0 THEN event_type ELSE '' END AS Text
        FROM (SELECT *, {_EVENT_KEY} AS k, event_id % 13 <> 0 AS ok FROM events)""",
    "s1_review_scan": f"""WITH {v.DOC_REVIEWS}
        SELECT Id, ProductId, UserId, CAST(NULL AS INT) AS HelpfulnessNumerator, Score, Time, Summary, Text FROM doc_reviews""",
    "s2_quoted_csv": """SELECT CAST(doc_id AS VARCHAR) AS Id, source AS ProductId,
        concat('"', replace(text, '. ', concat('.",', chr(13), chr(10), '"')), '"') AS Summary, text AS Text FROM documents""",
    "s10_feature_set": """WITH ranked AS (SELECT *, CAST(vec_id AS VARCHAR) AS Id, count(*) OVER () AS n,
          row_number() OVER (ORDER BY md5('42:' || CAST(vec_id AS VARCHAR)), CAST(vec_id AS VARCHAR)) AS rn FROM embeddings)
        SELECT Id, label, CASE WHEN rn <= n * 8 // 10 THEN 'train' WHEN rn <= n * 8 // 10 + n // 10 THEN 'val' ELSE 'test' END AS split,
          CAST(len(embedding) AS INT) AS length, CAST(embedding[1] AS DOUBLE) AS first,
          round(list_reduce(list_transform(embedding, lambda x: CAST(x AS DOUBLE)), lambda a, x: a + x, CAST(0 AS DOUBLE)), 9) AS total FROM ranked""",
    "s11_split_files": f"WITH {_SPLIT} SELECT Id, ProductId, Score, Time, Sentiment, split FROM split",
    "p1_drop_empty_text": f"WITH {DOC_VOTES} SELECT Id, Text FROM doc_votes WHERE Text <> ''",
    "p2_dedupe_text": "SELECT min(doc_id) AS Id, text AS Text FROM documents GROUP BY text",
    "p3_valid_helpfulness": f"""WITH {v.REVIEWS}
        SELECT Id, HelpfulnessNumerator, HelpfulnessDenominator FROM reviews
        WHERE HelpfulnessDenominator = 0 OR HelpfulnessNumerator <= HelpfulnessDenominator""",
    "p4_fill_summary": f"WITH {DOC_VOTES} SELECT Id, coalesce(Summary, '') AS Summary FROM doc_votes",
    "p5_sentiment": f"""WITH {v.DOC_REVIEWS}
        SELECT Id, Score, CASE WHEN Score IS NULL THEN 'unknown' WHEN Score < 3 THEN 'negative'
          WHEN Score = 3 THEN 'neutral' ELSE 'positive' END AS Sentiment FROM doc_reviews""",
    "p6_label": f"WITH {v.LABELLED} SELECT Id, Sentiment, label FROM labelled",
    "p6b_index_label": f"""WITH {v.DOC_REVIEWS}, named AS (
        SELECT Id, CASE WHEN Score IS NULL THEN 'unknown' WHEN Score < 3 THEN 'negative'
          WHEN Score = 3 THEN 'neutral' ELSE 'positive' END AS Sentiment FROM doc_reviews),
        ranked AS (SELECT Sentiment, CAST(row_number() OVER (ORDER BY count(*) DESC, Sentiment) - 1 AS DOUBLE)
          AS label_index FROM named GROUP BY Sentiment)
        SELECT Id, Sentiment, label_index FROM named JOIN ranked USING (Sentiment)""",
    "p7_fixed_weights": f"""WITH {v.LABELLED} SELECT Id, label,
        CAST(CASE label WHEN 0 THEN 3.0 WHEN 1 THEN 8.0 WHEN 2 THEN 0.5 ELSE 1.0 END AS DOUBLE) AS classWeight
        FROM labelled""",
    "p8_balanced_weights": f"""WITH {v.LABELLED} SELECT Id, label,
        round(CAST(count(*) OVER () AS DOUBLE) / (3 * count(*) OVER (PARTITION BY label)), 6) AS classWeight
        FROM labelled""",
    "p9_fuse_text": f"""WITH {DOC_VOTES} SELECT Id,
        concat_ws(' ', coalesce(Summary, ''), coalesce(Summary, ''), Text) AS Text FROM doc_votes""",
    "p10_normalise_text": r"""SELECT CAST(doc_id AS VARCHAR) AS Id,
        regexp_replace(regexp_replace(lower(text), '[^a-z0-9\s]', ' ', 'g'), '\s+', ' ', 'g') AS clean,
        lower(regexp_replace(text, '[^a-zA-Z\s]', '', 'g')) AS letters FROM documents""",
    "p11_guards": f"""WITH {v.PREDICTIONS} SELECT
        count(*) FILTER (substr(h, 5, 1) <> '0' AND substr(h, 7, 1) <> '0' AND substr(h, 8, 1) <> '0') AS monthly_rows,
        count(*) FILTER (substr(h, 5, 1) <> '0' AND substr(h, 6, 1) <> '0') AS product_rows
        FROM predictions""",
    "p12_decode_prediction": f"""WITH {v.REVIEWS} SELECT Id, CASE Score WHEN 1 THEN 'neutral' WHEN 2 THEN 'positive'
        ELSE 'unknown' END AS name FROM reviews""",
    "p13_event_date": f"""WITH {v.REVIEWS} SELECT Id,
        CASE WHEN HelpfulnessDenominator <> 0 THEN CAST(day AS VARCHAR) END AS day,
        CASE WHEN HelpfulnessDenominator <> 0 THEN
          strftime(TIMESTAMP '1970-01-01' + to_seconds(Time), '%Y-%m-%d %H:%M:%S') END AS moment
        FROM reviews""",
    "p14_prediction_view": f"""WITH {v.PREDICTIONS} SELECT Id, ProductId, UserId, ProfileName, Score, Time,
        ProcessingTime, Summary, Summary AS Text, CAST(prediction AS DOUBLE) AS prediction, PredictedSentiment,
        round(greatest(p0, p1, p2), 6) AS max_prob FROM predictions""",
    "p15_search": f"""WITH {v.PREDICTIONS} SELECT Id, ProductId, ProfileName FROM predictions
        WHERE contains(lower(ProductId), 'p11') OR contains(lower(ProfileName), 'p11')
          OR contains(lower(Summary), 'p11')""",
    "p15_search_profile": f"""WITH {v.PREDICTIONS} SELECT Id, ProfileName FROM predictions
        WHERE lower(ProfileName) LIKE '%reader 7%'""",
    "p17_helpfulness": f"""WITH {v.REVIEWS} SELECT Id,
        round(HelpfulnessNumerator / HelpfulnessDenominator, 6) AS helpfulness_ratio
        FROM reviews WHERE HelpfulnessDenominator > 0""",
    "p18_clean_audit": f"""WITH {DOC_VOTES},
        a AS (SELECT * FROM doc_votes WHERE Text IS NOT NULL),
        b AS (SELECT * FROM a WHERE Text <> ''),
        c AS (SELECT * FROM b QUALIFY row_number() OVER (PARTITION BY Text ORDER BY Id) = 1),
        d AS (SELECT * FROM c WHERE HelpfulnessDenominator = 0 OR HelpfulnessNumerator <= HelpfulnessDenominator),
        n AS (SELECT (SELECT count(*) FROM doc_votes) AS n0, (SELECT count(*) FROM a) AS n1,
          (SELECT count(*) FROM b) AS n2, (SELECT count(*) FROM c) AS n3, (SELECT count(*) FROM d) AS n4)
        SELECT 1 AS step, 'null_text' AS rule, n0 AS rows_before, n1 AS rows_after, n0 - n1 AS removed FROM n
        UNION ALL SELECT 2, 'empty_text', n1, n2, n1 - n2 FROM n
        UNION ALL SELECT 3, 'duplicate_text', n2, n3, n2 - n3 FROM n
        UNION ALL SELECT 4, 'invalid_helpfulness', n3, n4, n3 - n4 FROM n""",
    "c1_stratified_split": f"WITH {_SPLIT} SELECT Id, Sentiment, split FROM split",
    "c2_approx_split": f"""WITH {v.LABELLED} SELECT Id, Sentiment,
        CASE WHEN substr(md5('42:' || Sentiment || ':' || Id), 1, 8) < 'cccccccd' THEN 'train'
          WHEN substr(md5('43:' || Sentiment || ':' || Id), 1, 8) < '80000000' THEN 'val' ELSE 'test' END AS split
        FROM labelled""",
    "c3_random_split": f"""WITH {v.REVIEWS} SELECT Id,
        CASE WHEN substr(md5('42:' || Id), 1, 8) < 'b3333333' THEN 'train' ELSE 'test' END AS split FROM reviews""",
    "c4_sample": f"""WITH {v.REVIEWS} SELECT Id, Score FROM reviews
        WHERE substr(md5('42:' || Id), 1, 8) < '1999999a'""",
    "c5_sample_n": f"""WITH {v.REVIEWS} SELECT Id, Score FROM reviews ORDER BY md5('42:' || Id), Id LIMIT 5000""",
    "c5_sample_per_class": f"""WITH {v.LABELLED} SELECT Id, Sentiment FROM labelled
        QUALIFY row_number() OVER (PARTITION BY Sentiment ORDER BY md5('42:' || Id), Id) = 1""",
    "c6_split_audit": f"""WITH {_SPLIT},
        counted AS (SELECT split, Sentiment, count(*) AS count FROM split GROUP BY ALL),
        totalled AS (SELECT *, CAST(sum(count) OVER (PARTITION BY split) AS BIGINT) AS split_total FROM counted)
        SELECT *, {v.percent('count', 'split_total', 2)} AS share FROM totalled""",
}
