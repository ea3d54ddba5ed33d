"""Streams and sinks run to the end of the given tables, then read back."""

from datetime import datetime

from pyspark.sql import functions as F

from tonegauge.operators import dashboard, features, metrics, models
from tonegauge.operators.cleaning import probability_array
from tonegauge.operators.sentiment_model import SentimentModel
from tonegauge.plans import cleaning, views_sql as v
from tonegauge.plans import dashboard as dashboard_plans
from tonegauge.plans import models as model_plans
from tonegauge.sources import reviews, storage, views
from tonegauge.streaming import commits, insights, live, replay, scoring, waiting

ALL_NOW = {"availableNow": True}


def _finished(stream, purpose):
    """A stream written to a new folder until its source is used up."""
    path = storage.shared_dir(stream.sparkSession, purpose)
    query = (
        stream.writeStream.format("parquet").option("path", path)
        .option("checkpointLocation", storage.shared_dir(stream.sparkSession, "offsets"))
        .trigger(**ALL_NOW).start()
    )
    query.awaitTermination()
    return stream.sparkSession.read.schema(stream.schema).parquet(path)


def _stream_predictions(spark, folder):
    items = views.table_stream(spark, folder, "lineitem")
    return views.predictions(spark, folder, items=items).withColumn("ProfileName", F.lit(None).cast("string"))


def s6_publish(spark, folder):
    """Messages written as JSON text and decoded again."""
    path = storage.shared_dir(spark, "topic")
    reviews.publish(cleaning.QUERIES["s4_messages"](spark, folder), path)
    return reviews.decode(spark.read.text(path))


def s7_message_stream(spark, folder):
    """The same folder read as a stream from its first message on."""
    path = storage.shared_dir(spark, "topic")
    reviews.publish(cleaning.QUERIES["s4_messages"](spark, folder), path)
    return _finished(reviews.decode(reviews.message_stream(spark, path)), "decoded")


def s8_decode_stream(spark, folder):
    events = views.table_stream(spark, folder, "events")
    return _finished(reviews.decode(views.event_messages(spark, folder, events)), "decoded")


def s9_prediction_sink(spark, folder):
    """Two batches, the second written twice."""
    pred = views.predictions(spark, folder).select("Id", "prediction", "PredictedSentiment", "Score")
    path = storage.shared_dir(spark, "predictions")
    late = pred.filter(F.col("Score") > 2)
    scoring.write_predictions(pred.filter(F.col("Score") <= 2), 0, path)
    scoring.write_predictions(late, 1, path)
    scoring.write_predictions(late, 1, path)
    return scoring.read_predictions(spark, path).select("Id", "PredictedSentiment", "batch_id")


def r2_timed_append(spark, folder):
    """Predictions appended by a stream, started twice with one checkpoint, and its first batch written once more."""
    stream = _stream_predictions(spark, folder).select("Id", "ProductId", "Score", "Time", "prediction", "PredictedSentiment")
    path, checkpoint = storage.shared_dir(spark, "predictions"), storage.shared_dir(spark, "append")
    for _ in range(2):
        scoring.start_append(stream, path, checkpoint, trigger=ALL_NOW).awaitTermination()
    stored = scoring.read_predictions(spark, path)
    scoring.write_predictions(stored.select("Id", "Score"), 0, path, run=stored.first()["run"])
    return scoring.read_predictions(spark, path).select("Id", "ProductId", "Score", "Time", "prediction", "PredictedSentiment", "batch_id")


def r3_restarted_sink(spark, folder):
    """A run of two batches, the second replayed, and a run with a new checkpoint whose first batch has the same number."""
    pred = views.predictions(spark, folder).select("Id", "prediction", "PredictedSentiment", "Score")
    path = storage.shared_dir(spark, "predictions")
    parts = [("a", 0, F.col("Score") <= 2), ("a", 1, F.col("Score") == 3), ("a", 1, F.col("Score") == 3), ("b", 0, F.col("Score") > 3)]
    for run, batch, rows in parts:
        scoring.write_predictions(pred.filter(rows), batch, path, run=run)
    return scoring.read_predictions(spark, path).select("Id", "PredictedSentiment", "run", "batch_id")


def s14_replace_table(spark, folder):
    """A result table replaced by a newer one."""
    pred = views.predictions(spark, folder)
    path = storage.shared_dir(spark, "monthly")
    storage.replace_table(dashboard.monthly_sentiment(pred.filter(F.col("Score") < 3)), path, datetime(2024, 1, 1))
    storage.replace_table(dashboard.monthly_sentiment(pred), path, datetime(2024, 1, 2))
    table = storage.read_table(spark, path)
    return table.select(
        F.col("year").cast("bigint").alias("year"), F.col("month").cast("bigint").alias("month"), "sentiment",
        "count", F.date_format("aggregated_at", "yyyy-MM-dd").alias("aggregated_at"),
    )


def s15_history(spark, folder):
    """Scores of two runs appended to one history."""
    pred = views.predictions(spark, folder)
    path = storage.shared_dir(spark, "history")
    for run, limit in enumerate([3, 6]):
        status = dashboard.overall_stats(pred.filter(F.col("Score") < limit)).withColumn("run", F.lit(run))
        storage.append_history(status, path)
    return spark.read.parquet(path)


def _document_messages(documents):
    return documents.select(
        F.to_json(F.struct(
            F.col("doc_id").cast("string").alias("Id"), F.col("source").alias("ProductId"),
            F.col("text").alias("Text"), F.lit("1325376000").alias("Time"),
        )).alias("value")
    )


def _fitted(docs):
    """A model fitted on all rows. Their tokens are worked out once, for the features' fit and the classifier's."""
    fitted, wide = features.fit_and_transform(docs, train=F.lit(True))
    return SentimentModel(fitted, models.train_lr(storage.stored(wide, "features")))


def _scored_stream(spark, folder):
    """A model fitted on the labelled documents, and the predictions it has made of all of them as a stream of messages."""
    model = _fitted(model_plans._labelled_docs(spark, folder))
    stream = _document_messages(views.table_stream(spark, folder, "documents"))
    path = storage.shared_dir(spark, "predictions")
    scoring.start_scoring(stream, model, path, storage.shared_dir(spark, "scoring"), trigger=ALL_NOW).awaitTermination()
    return model, scoring.read_predictions(spark, path)


def r1_scored_stream(spark, folder):
    """Documents as messages, scored by a model fitted on the labelled ones."""
    return _scored_stream(spark, folder)[1].select("Id", "prediction", "PredictedSentiment", "ProcessingTime")


def r1_stream_equals_batch(spark, folder):
    """Rows scored by the stream or by a batch job, and rows on which both agree."""
    model, streamed = _scored_stream(spark, folder)
    batch = model.predictions(reviews.decode(_document_messages(views.table(spark, folder, "documents"))))
    both = streamed.select("Id", "prediction", "max_prob").join(
        batch.select("Id", F.col("prediction").alias("prediction2"), F.col("max_prob").alias("prob2")), "Id", "full")
    same = (F.col("prediction") == F.col("prediction2")) & (F.abs(F.col("max_prob") - F.col("prob2")) < 1e-9)
    return both.agg(F.count(F.lit(1)).alias("rows"), F.count_if(same).alias("same"))


def r4_live_monthly(spark, folder):
    path = storage.shared_dir(spark, "monthly")
    live.start_monthly(_stream_predictions(spark, folder), path, storage.shared_dir(spark, "live"), trigger=ALL_NOW).awaitTermination()
    table = storage.read_table(spark, path)
    return table.select(F.col("year").cast("bigint").alias("year"), F.col("month").cast("bigint").alias("month"),
                        "sentiment", "count")


def r4_live_stats(spark, folder):
    path = storage.shared_dir(spark, "monthly")
    live.start_monthly(_stream_predictions(spark, folder), path, storage.shared_dir(spark, "live"), trigger=ALL_NOW).awaitTermination()
    return live.live_stats(spark, path)


def r5_live_recent(spark, folder):
    path = storage.shared_dir(spark, "recent")
    live.start_recent(_stream_predictions(spark, folder), path, storage.shared_dir(spark, "live"), trigger=ALL_NOW).awaitTermination()
    return storage.read_table(spark, path).select("Id", "ProductId", "Score", "PredictedSentiment", "Summary")


def r6_paced_replay(spark, folder):
    """Events as messages, replayed at 20 000 a second, stopped in between and started again; each message arrives once."""
    shaped = replay.numbered(cleaning.event_columns(reviews.with_file_position(views.table(spark, folder, "events"))))
    messages = reviews.to_messages(shaped, cleaning.MESSAGE_TIME, "position", keep=["number"])
    path, checkpoint = storage.shared_dir(spark, "topic"), storage.shared_dir(spark, "replay")

    def send(batch, number, run):
        commits.write(reviews.as_json(batch), path, run, number, "text")

    # a batch takes most of a second whatever its rows, so shorter intervals would not hold the rate
    for seconds in (0.5, None):
        running = replay.start_paced(messages, checkpoint, 20_000, send, interval=2.0)
        running.wait(seconds)
        running.stop()
    return reviews.decode(commits.read(spark, path, "value string", "text"))


def s13_sidecar(spark, folder):
    """Counts of the predictions written as a small document and read back."""
    counts = dashboard.overall_stats(views.predictions(spark, folder)).first().asDict()
    path = storage.shared_dir(spark, "sidecar")
    storage.save_json(spark, {"dataset": "predictions", "counts": counts}, path)
    found = storage.load_json(spark, path)
    names = sorted(found["counts"])
    return spark.createDataFrame([(found["dataset"], n, found["counts"][n]) for n in names], "dataset string, name string, count bigint")


def _insights(spark, folder):
    """Documents of the evaluation of each score's predictions, a broken one and a missing one, ingested one after the other."""
    pred, base = views.predictions(spark, folder), storage.shared_dir(spark, "insights")
    history = f"{base}/history"
    for score in (1, 3, 5):
        meta = {"model_name": f"model {score}", "dataset": "predictions", "notes": "{rows} rows"}
        doc = metrics.insight(pred.filter(F.col("Score") == score), meta, datetime(2024, 1, score))
        doc.coalesce(1).write.json(f"{base}/doc{score}")
        storage.append_history(storage.ingest_insight(spark, f"{base}/doc{score}", datetime(2024, 2, 1)), history)
    pred.agg(F.concat(F.lit("{"), F.count("*"), F.lit(" rows")).alias("value")).coalesce(1).write.text(f"{base}/broken")
    for day, name in ((1, "broken"), (2, "none")):
        storage.append_history(storage.ingest_insight(spark, f"{base}/{name}", datetime(2023, 1, day)), history)
    return spark.read.parquet(history)


def s16_insight_ingest(spark, folder):
    return _insights(spark, folder).select(
        "evaluated_at", "status", F.col("metadata.model_name").alias("model_name"), F.col("metadata.notes").alias("notes"),
        F.col("metrics.accuracy").alias("accuracy"), F.element_at(F.split(F.get("errors", F.lit(0)), ":"), 1).alias("error"),
    )


def a13_latest_insight(spark, folder):
    newest = dashboard.latest_insight(_insights(spark, folder))
    return newest.select(
        "evaluated_at", "status", F.col("metadata.model_name").alias("model_name"), F.col("metrics.accuracy").alias("accuracy"),
        F.array_join(F.flatten("confusion_matrix.matrix").cast("array<string>"), ",").alias("matrix"),
    )


def _insight_stream(spark, folder):
    """Documents of the evaluation of each score, a broken one among them, taken in by a query that is started twice."""
    pred, base = views.predictions(spark, folder), storage.shared_dir(spark, "insight-files")

    def write(scores):
        for score in scores:
            meta = {"model_name": f"model {score}", "dataset": "predictions", "notes": "{rows} rows"}
            doc = metrics.insight(pred.filter(F.col("Score") == score), meta, datetime(2024, 1, 7 - score))
            doc.coalesce(1).write.json(f"{base}/files/score{score}")

    def take_in():
        texts = insights.documents(spark, f"{base}/files", per_trigger=2)
        insights.take_in(texts, f"{base}/table", f"{base}/checkpoint", "scores").awaitTermination()

    write((1, 3))
    broken = pred.agg(F.concat(F.lit("{"), F.count("*"), F.lit(" rows")).alias("value"))
    broken.coalesce(1).write.text(f"{base}/files/broken")
    take_in()
    write((5,))
    take_in()
    return insights.history(spark, f"{base}/table")


def s16_insight_stream(spark, folder):
    expected = spark.createDataFrame([(n,) for n in ("score1", "score3", "score5", "broken", "none")], "document string")
    rows = insights.with_missing(_insight_stream(spark, folder), expected, "2024-02-01T00:00:00Z")
    return rows.select(
        "document", "status", F.when(F.col("status") == "ok", F.col("evaluated_at")).alias("evaluated_at"),
        F.col("metadata.notes").alias("notes"), F.col("metrics.accuracy").alias("accuracy"),
        F.element_at(F.split(F.get("errors", F.lit(0)), ":"), 1).alias("error"),
    )


def a13_latest_of_stream(spark, folder):
    newest = insights.latest(_insight_stream(spark, folder))
    return newest.select("document", "evaluated_at", "status", F.col("metrics.accuracy").alias("accuracy"))


def s12_saved_model(spark, folder):
    """Documents scored by a model and by the same model saved and loaded: rows, and rows on which both agree."""
    model = _fitted(model_plans._labelled_docs(spark, folder))
    path = storage.shared_dir(spark, "model")
    model.save(spark, path)
    loaded = SentimentModel.load(spark, path)
    every = views.doc_reviews(spark, folder)
    scored = [m.predict(every) for m in (model, loaded)]
    one, two = (rows.select("Id", "prediction", probability_array(rows).alias("p")) for rows in scored)
    both = one.join(two.withColumnsRenamed({"prediction": "prediction2", "p": "p2"}), "Id")
    same = (F.col("prediction") == F.col("prediction2")) & (F.col("p") == F.col("p2"))
    return both.agg(F.count("*").alias("scored"), F.count_if(same).alias("same"))


def r7_waiting_check(spark, folder):
    """Messages and predictions as two streams; a prediction comes 1 to 16 minutes after its message or never, ten count.

    A last message and prediction of a far later time end the wait for all others, and are left out again. Topics hold the
    rows in the order of time and are taken a file a batch, so state holds a few files' rows and not the table's."""
    rows = views.predictions(spark, folder)
    h, sent_at = F.md5(F.col("Id").cast("binary")), F.timestamp_seconds("Time")
    minutes = F.instr(F.lit(views.HEX_DIGITS), F.substring(h, 2, 1))
    sent = rows.select("Id", F.col("Sentiment").alias("expected"), sent_at.alias("sent_at"))
    stored = rows.filter(h < "e").select("Id", "PredictedSentiment", F.timestamp_seconds(F.col("Time") + 60 * minutes).alias("scored_at"))
    last = spark.range(1).select(F.lit("last").alias("Id"), F.lit("").alias("name"), F.timestamp_seconds(F.lit(32503680000)).alias("at"))
    cuts, streams, own = waiting.time_cuts(sent, "sent_at"), [], waiting.own_session(spark)
    for frame in (sent, stored):
        path = storage.shared_dir(spark, "topic")
        waiting.write_in_time(frame.unionAll(last), frame.columns[-1], path, cuts)
        streams.append(own.readStream.schema(frame.schema).option("maxFilesPerTrigger", 1).parquet(path))
    path = storage.shared_dir(spark, "checked")
    checked = waiting.awaited(*streams)
    waiting.start_check(checked, path, storage.shared_dir(spark, "waiting"), ALL_NOW).awaitTermination()
    return waiting.latest(spark.read.schema(checked.schema).parquet(path)).filter(F.col("Id") != "last")


QUERIES = {
    name: run for name, run in globals().items()
    if callable(run) and name[0] in "ars" and name[1:2].isdigit()
}

_MESSAGES = f"SELECT * REPLACE ('' AS Text) FROM ({cleaning.SQL['s4_messages']})"

SQL = {
    "s6_publish": _MESSAGES,
    "s7_message_stream": _MESSAGES,
    "s8_decode_stream": cleaning.SQL["s8_decode"],
    "s9_prediction_sink": f"""WITH {v.PREDICTIONS} SELECT Id, PredictedSentiment,
        CAST(CASE WHEN Score <= 2 THEN 0 ELSE 1 END AS BIGINT) AS batch_id FROM predictions""",
    "r2_timed_append": f"""WITH {v.PREDICTIONS} SELECT Id, ProductId, CAST(Score AS VARCHAR) AS Score, CAST(Time AS VARCHAR) AS Time,
        CAST(prediction AS DOUBLE) AS prediction, PredictedSentiment, CAST(0 AS BIGINT) AS batch_id FROM predictions""",
    "r3_restarted_sink": f"""WITH {v.PREDICTIONS} SELECT Id, PredictedSentiment, CASE WHEN Score <= 3 THEN 'a' ELSE 'b' END AS run,
        CAST(CASE WHEN Score = 3 THEN 1 ELSE 0 END AS BIGINT) AS batch_id FROM predictions""",
    "s14_replace_table": f"""SELECT *, '2024-01-02' AS aggregated_at
        FROM ({dashboard_plans.SQL['a3_monthly_sentiment']})""",
    "s15_history": f"""WITH {v.PREDICTIONS}, r AS (SELECT unnest([0, 1]) AS run)
        SELECT run, count(*) AS total, count(*) FILTER (prediction = 2) AS positive,
          count(*) FILTER (prediction = 1) AS neutral, count(*) FILTER (prediction = 0) AS negative
        FROM predictions JOIN r ON Score < 3 + 3 * run GROUP BY run""",
    "r6_paced_replay": _MESSAGES,
    "r1_stream_equals_batch": "SELECT count(*) AS rows, count(*) AS same FROM documents WHERE text <> ''",
    "s12_saved_model": "SELECT count(*) AS scored, count(*) AS same FROM documents",
    "s13_sidecar": f"""WITH {v.PREDICTIONS}, c AS (SELECT {v.counts('PredictedSentiment')} FROM predictions)
        SELECT 'predictions' AS dataset, name, CAST(count AS BIGINT) AS count
        FROM (SELECT positive + neutral + negative AS total, * FROM c) UNPIVOT (count FOR name IN (total, positive, neutral, negative))""",
    "s16_insight_ingest": f"""WITH {v.PREDICTIONS}
        SELECT concat('2024-01-0', Score, 'T00:00:00Z') AS evaluated_at, 'ok' AS status, concat('model ', Score) AS model_name,
          concat(count(*), ' rows') AS notes, round(count(*) FILTER (label = prediction) / count(*), 4) AS accuracy,
          CAST(NULL AS VARCHAR) AS error FROM predictions WHERE Score IN (1, 3, 5) GROUP BY Score
        UNION ALL SELECT '2023-01-01T00:00:00', 'missing', NULL, NULL, NULL, 'invalid_json'
        UNION ALL SELECT '2023-01-02T00:00:00', 'missing', NULL, NULL, NULL, 'missing_file'""",
    "s16_insight_stream": f"""WITH {v.PREDICTIONS}
        SELECT concat('score', Score) AS document, 'ok' AS status, concat('2024-01-0', 7 - Score, 'T00:00:00Z') AS evaluated_at,
          concat(count(*), ' rows') AS notes, round(count(*) FILTER (label = prediction) / count(*), 4) AS accuracy,
          CAST(NULL AS VARCHAR) AS error FROM predictions WHERE Score IN (1, 3, 5) GROUP BY Score
        UNION ALL SELECT 'broken', 'missing', NULL, NULL, NULL, 'invalid_json'
        UNION ALL SELECT 'none', 'missing', NULL, NULL, NULL, 'missing_file'""",
    "a13_latest_of_stream": f"""WITH {v.PREDICTIONS} SELECT 'score1' AS document, '2024-01-06T00:00:00Z' AS evaluated_at,
        'ok' AS status, round(count(*) FILTER (label = prediction) / count(*), 4) AS accuracy
        FROM predictions WHERE Score = 1""",
    "a13_latest_insight": f"""WITH {v.PREDICTIONS}, p AS (SELECT * FROM predictions WHERE Score = 5)
        SELECT '2024-01-05T00:00:00Z' AS evaluated_at, 'ok' AS status, 'model 5' AS model_name,
          round(count(*) FILTER (label = prediction) / count(*), 4) AS accuracy,
          (SELECT string_agg(c, ',' ORDER BY l, g) FROM (SELECT l, g, count(p.label) AS c FROM (SELECT unnest([0, 1, 2]) AS l),
            (SELECT unnest([0, 1, 2]) AS g) LEFT JOIN p ON label = l AND prediction = g GROUP BY l, g)) AS matrix FROM p""",
    "r7_waiting_check": f"""WITH {v.PREDICTIONS}, w AS (SELECT Id, CASE WHEN Score < 3 THEN 'negative' WHEN Score = 3 THEN 'neutral'
          ELSE 'positive' END AS expected, PredictedSentiment AS name,
          h < 'e' AND instr('0123456789abcdef', substr(h, 2, 1)) <= 10 AS found FROM predictions)
        SELECT Id, expected, CASE WHEN found THEN name ELSE 'not_found' END AS predicted, found, found AND name = expected AS agrees
        FROM w""",
    "r4_live_monthly": dashboard_plans.SQL["a3_monthly_sentiment"],
    "r4_live_stats": f"""WITH {v.PREDICTIONS} SELECT positive + neutral + negative AS total, positive, neutral,
        negative FROM (SELECT {v.counts('PredictedSentiment')} FROM predictions)""",
    "r5_live_recent": f"""WITH {v.PREDICTIONS} SELECT Id, ProductId, Score, PredictedSentiment, Summary
        FROM predictions ORDER BY Id DESC LIMIT 50""",
}
