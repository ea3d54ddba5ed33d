"""Hand-written rows for the corner cases."""

import json
from datetime import datetime

import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator
from pyspark.sql import functions as F

from tonegauge.functions import clock, labels
from tonegauge.functions import text as words
from tonegauge.operators import (
    calibration, cleaning, dashboard, drift, lemma, metrics, profile, ranking, splits,
)
from tonegauge.operators import text as text_ops
from tonegauge.sources import reviews, storage, views


def values(df, *columns):
    return [tuple(r) for r in df.select(*columns).collect()]


def test_sentiment_off_the_grid(spark):
    scores = [(None,), (float("nan"),), (2.5,), (0.0,), (6.0,), (3.0,)]
    df = spark.createDataFrame(scores, "Score double")
    names = [r[0] for r in df.select(labels.sentiment(F.col("Score"))).collect()]
    assert names == ["unknown", "unknown", "negative", "negative", "positive", "neutral"]
    text = spark.createDataFrame([("5",), ("five",), ("2",)], "Score string")
    assert [r[0] for r in text.select(labels.sentiment(F.col("Score"))).collect()] == [
        "positive", "unknown", "negative"]


def test_labels_and_names(spark):
    df = spark.createDataFrame([("Positive",), ("neutral",), ("unknown",), (None,)], "s string")
    assert [r[0] for r in df.select(labels.label(F.col("s"))).collect()] == [2, 1, None, None]
    codes = spark.createDataFrame([(0.0,), (2.0,), (7.0,), (-1.0,), (None,)], "p double")
    assert [r[0] for r in codes.select(labels.sentiment_of_label(F.col("p"))).collect()] == [
        "negative", "positive", "unknown", "unknown", "unknown"]


def test_times(spark):
    rows = [("12.5",), ("abc",), (None,), ("1350777600",), ("1351727999",), ("99999999999999999",)]
    df = spark.createDataFrame(rows, "t string")
    days = [r[0] for r in df.select(clock.event_date(F.col("t")).cast("string")).collect()]
    assert days == [None, None, None, "2012-10-21", "2012-10-31", None]
    moments = [r[0] for r in df.select(clock.event_time(F.col("t"))).collect()]
    assert moments[3:5] == ["2012-10-21 00:00:00", "2012-10-31 23:59:59"]
    # an hour that New York skips
    gap = spark.sql("SELECT TIMESTAMP_NTZ'2024-03-10 02:30:00' AS ts")
    assert gap.select(clock.epoch_seconds(F.col("ts"))).first()[0] == 1710037800


def test_live_trend_formats(spark):
    rows = [("2012-10-21 00:00:00", 1), ("2012-10-21T10:00:00Z", 1), ("1350777600", 1), ("2012-10", 1),
            ("", 1350777600), ("bad", 1350777600), (None, 1350777600)]
    df = spark.createDataFrame([(p, t, "Positive") for p, t in rows],
                               "ProcessingTime string, Time long, PredictedSentiment string")
    assert values(dashboard.live_trend(df), "label", "positive") == [("Oct'12", 4)]


def test_csv_with_quotes_and_line_breaks(spark, tmp_path):
    path = tmp_path / "r.csv"
    path.write_text(
        'Id,ProductId,UserId,ProfileName,HelpfulnessNumerator,HelpfulnessDenominator,Score,Time,Summary,Text\n'
        '1,P1,U1,N,1,2,5,1350777600,ok,"a ""quoted"", x\nsecond line"\n2,P1,U1,N,1,x,4,9,ok,plain\n')
    rows = reviews.read_reviews(spark, str(path)).orderBy("Id").collect()
    assert rows[0].Text == 'a "quoted", x\nsecond line' and rows[0].Score == 5.0
    assert rows[1].HelpfulnessDenominator is None and len(rows) == 2


def test_messages_from_any_header(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id,SCORE,time\n,5,\nx,1,7\n")
    df = reviews.with_file_position(spark.read.option("header", True).csv(str(tmp_path)))
    found = reviews.to_messages(df, 99, "position").orderBy("Id").collect()
    assert [(r.Id, r.Score, r.Time, r.Text) for r in found] == [("TEST_001", "5", "99", None), ("x", "1", "7", None)]


def test_file_positions_of_many_text_files(spark, tmp_path):
    for k in range(3):
        (tmp_path / f"{k}.csv").write_text("v\n" + "".join(f"{k}-{i}\n" for i in range(1, 40)))
    df = reviews.with_file_position(spark.read.schema("v string").option("header", True).csv(str(tmp_path)))
    assert all(int(r.v.split("-")[1]) == r.position for r in df.collect())
    first = reviews.bounded(df, 45)
    assert first.count() == 45 and first.filter(F.col("v").startswith("2-")).count() == 0
    assert reviews.bounded(df, 5, per_file=True).count() == 15
    assert reviews.bounded(df, 0).count() == 117


def test_decode_broken_messages(spark):
    rows = [("not json",), ('{"Id": "1"}',), ('{"Id": "2", "Text": "t", "extra": 1}',), (None,)]
    found = reviews.decode(spark.createDataFrame(rows, "value string")).collect()
    assert [(r.Id, r.Text) for r in found] == [(None, ""), ("1", ""), ("2", "t"), (None, "")]


def test_tokens(spark):
    rows = [("don't",), ("isn't not good",), ("Ça été",), ("",), (None,)]
    df = spark.createDataFrame(rows, "Text string")
    kept = text_ops.remove_stopwords(text_ops.tokenise(df))
    pairs = text_ops.combine(text_ops.add_bigrams(kept, "filtered"), "filtered")
    out = values(pairs, "words", "filtered", "tokens")
    assert out[0] == (["don"], [], [])
    assert out[1] == (["isn", "not", "good"], ["isn", "not", "good"], ["isn", "not", "good", "isn not", "not good"])
    assert out[3] == ([], [], [])
    wide = text_ops.tokenise(df, unicode=True).collect()
    assert wide[2].words == ["ça", "été"]


def test_tokens_equal_the_ml_stages(spark, folder):
    from pyspark.ml.feature import NGram, RegexTokenizer, StopWordsRemover

    df = views.doc_texts(spark, folder)
    ours = text_ops.add_bigrams(text_ops.remove_stopwords(text_ops.tokenise(df)), "filtered")
    ml = RegexTokenizer(inputCol="Text", outputCol="w", pattern=r"\w+", gaps=False, minTokenLength=2).transform(ours)
    ml = StopWordsRemover(inputCol="w", outputCol="f", stopWords=words.english_stop_words()).transform(ml)
    ml = NGram(n=2, inputCol="f", outputCol="b").transform(ml)
    same = (F.col("words") == F.col("w")) & (F.col("filtered") == F.col("f")) & (F.col("bigrams") == F.col("b"))
    assert ml.filter(~same).count() == 0


def test_lemmas_with_a_lexicon(spark):
    lexicon = spark.createDataFrame(
        [("love", "v", "love"), ("battery", "n", "battery"), ("go", "v", "go"), ("went", "v", "go"),
         ("leave", "v", "leave"), ("leaf", "n", "leaf"), ("glass", "n", "glass"), ("bake", "v", "bake")],
        "form string, pos string, lemma string")
    tokens = ["loved", "batteries", "went", "leaves", "glasses", "bakings", "xyz", "loved"]
    df = spark.createDataFrame([("1", tokens), ("2", None), ("3", [])], "Id string, filtered array<string>")
    out = lemma.lemmatise(df, lemma.lemmas_of(df, lexicon)).orderBy("Id")
    assert [r.lemmatized for r in out.collect()] == [
        ["love", "battery", "go", "leave", "glass", "bake", "xyz", "love"], [], []]


def test_cleaning_rules(spark):
    rows = [(1, "a", 1, 0), (2, "a", 0, 0), (3, None, 0, 0), (4, "", 0, 0), (5, "b", 3, 2), (6, "c", None, 1)]
    df = spark.createDataFrame(
        rows, "Id int, Text string, HelpfulnessNumerator int, HelpfulnessDenominator int"
    ).withColumn("Summary", F.lit(None).cast("string"))
    assert sorted(values(cleaning.clean(df), "Id", "Summary")) == [(1, "")]
    audit = values(cleaning.clean_audit(df), "rule", "removed")
    assert audit == [("null_text", 1), ("empty_text", 1), ("duplicate_text", 1), ("invalid_helpfulness", 2)]


def test_weights(spark):
    df = spark.createDataFrame([(0,), (1,), (1,), (2,), (2,), (2,)], "label int")
    got = dict(values(cleaning.balanced_weights(df).distinct(), "label", "classWeight"))
    assert got == {0: 2.0, 1: 1.0, 2: pytest.approx(6 / 9)}
    assert values(cleaning.fixed_weights(df).distinct().orderBy("label"), "classWeight") == [(3.0,), (8.0,), (0.5,)]


def test_split_properties(spark, folder):
    rows = cleaning.labelled(views.reviews(spark, folder)).select("Id", "Sentiment")
    one = splits.stratified_split(rows)
    sizes = {(r.Sentiment, r.split): r["count"] for r in one.groupBy("Sentiment", "split").count().collect()}
    for name in labels.SENTIMENTS:
        n = sum(v for (s, _), v in sizes.items() if s == name)
        assert sizes[name, "train"] == n * 8 // 10 and sizes[name, "val"] == n // 10
    other = splits.stratified_split(rows.repartition(7))
    assert one.exceptAll(other).count() == 0 and one.count() == rows.count()
    assert splits.sample_n(rows, 77).count() == 77
    assert splits.sample_n(rows, 10 ** 9).count() == rows.count()


def test_split_with_one_key_in_a_third_of_the_rows(spark):
    rows = spark.range(900).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("Id"),
        F.lit("neutral").alias("Sentiment"))
    out = splits.stratified_split(rows)
    assert out.count() == 900
    assert out.filter("Id = 'hot'").select("split").distinct().count() == 1
    assert out.filter("split = 'train'").count() <= 720


def test_tiny_classes(spark):
    df = spark.createDataFrame([("a", "neutral"), ("b", "positive")], "Id string, Sentiment string")
    assert values(splits.stratified_split(df), "split") == [("test",), ("test",)]


def test_quantiles_equal_percentile(spark):
    df = spark.range(5000).select((F.col("id") % 3).alias("g"), (F.rand(5) ** 9 * 1000).alias("x"))
    df = df.unionByName(spark.createDataFrame([(3, 1.0), (3, 1.0), (None, 4.0), (None, None)], "g long, x double"))
    df = df.persist()
    probs = [0.0, 0.25, 0.5, 0.99, 1.0]
    ours = {(r.g, r.p): r.q for r in ranking.exact_quantiles(df, F.col("x"), probs, ["g"]).collect()}
    for r in df.groupBy("g").agg(F.percentile("x", F.array(*[F.lit(p) for p in probs])).alias("q")).collect():
        for p, q in zip(probs, r.q):
            assert ours[r.g, p] == pytest.approx(q)


def test_overall_stats_add_up_over_case(spark):
    df = spark.createDataFrame([("Positive",), ("positive",), ("unknown",), (None,)], "PredictedSentiment string")
    assert values(dashboard.overall_stats(df), "total", "positive", "neutral") == [(2, 2, 0)]


def test_products_without_name_and_ties(spark):
    df = spark.createDataFrame(
        [("b", "positive"), ("a", "positive"), (None, "neutral"), (None, "neutral"), ("a", "unknown"), ("b", "neutral")],
        "ProductId string, PredictedSentiment string")
    assert values(dashboard.top_products(df), "product", "count") == [("Unknown", 2), ("a", 2), ("b", 2)]
    scoring = dashboard.product_scoring(df)
    assert sorted(values(scoring, "product", "total", "total_all")) == [("a", 1, 2), ("b", 2, 2)]
    assert values(dashboard.score_product("zz", scoring, df), "total", "positive_pct") == [(0, 0.0)]
    empty = scoring.limit(0)
    assert values(dashboard.top_products_with_fallback(empty, df, 1), "product") == [("Unknown",)]
    assert values(dashboard.score_product("a", empty, df), "total") == [(1,)]


def test_percent_rounds_half_up(spark):
    from tonegauge.functions import numbers

    df = spark.createDataFrame([(3, 2000), (1, 3), (0, 0), (1, 8)], "c long, t long")
    assert [r[0] for r in df.select(numbers.percent(F.col("c"), F.col("t"))).collect()] == [0.2, 33.3, 0.0, 12.5]


@pytest.mark.parametrize("counts, found, reason", [
    ((99, 50, 25, 24), [], "insufficient_data"),
    ((100, 30, 30, 40), [], None),
    ((1000, 299, 301, 400), ["NEUTRAL drift: 30.10% > 30% threshold"], None),
    ((100, 20, 31, 49), ["NEUTRAL drift: 31.00% > 30% threshold", "NEGATIVE drift: 49.00% > 40% threshold"], None),
])
def test_drift_limits(spark, counts, found, reason):
    df = spark.createDataFrame([counts], "total long, positive long, neutral long, negative long")
    row = drift.with_drift(df).first()
    assert row.alerts == found and row.reason == reason and row.drift_detected == bool(found)


def test_latest_drift(spark):
    schema = ("evaluated_at string, total long, positive long, neutral long, negative long, neutral_ratio double, "
              "negative_ratio double, drift_detected boolean, alerts array<string>, reason string")
    none = drift.latest_drift(spark.createDataFrame([], schema)).first()
    assert (none.reason, none.total, none.neutral_ratio, none.alerts) == ("no_data", 0, 0.0, [])
    rows = [("2024-01-01", 10, 5, 3, 2, 0.9, 0.9, True, ["x"], None), ("2024-01-02", None, 5, 3, 2, None, None, None, None, None)]
    last = drift.latest_drift(spark.createDataFrame(rows, schema)).first()
    assert (last.total, last.neutral_ratio, last.drift_detected, last.alerts) == (10, 0.3, False, [])


def test_metrics_with_absent_classes(spark):
    df = spark.createDataFrame([(0, 0.0), (0, 2.0), (2, 2.0), (2, 9.0)], "label int, prediction double")
    row = metrics.metrics(df).first()
    assert (row.recall_neutral, row.f1_neutral, row.precision_negative, row.recall_negative) == (0.0, 0.0, 1.0, 0.5)
    assert metrics.metrics(spark.createDataFrame([], "label int, prediction double")).first().accuracy == 0.0
    assert values(metrics.confusion(df), "predicted_0", "predicted_1", "predicted_2") == [(1, 0, 1), (0, 0, 0), (0, 0, 1)]


def test_metrics_equal_the_evaluators(spark, folder):
    pred = views.predictions(spark, folder).persist()
    row = metrics.metrics(pred, digits=None).first()
    ours = {"accuracy": row.accuracy, "f1": row.f1_weighted, "weightedPrecision": row.precision_weighted,
            "weightedRecall": row.recall_weighted}
    for name, value in ours.items():
        got = MulticlassClassificationEvaluator(metricName=name).evaluate(pred.withColumn("label", F.col("label").cast("double")))
        assert value == pytest.approx(got)
    binary = pred.select((F.col("label") == 1).cast("double").alias("label"), F.get("probability", F.lit(1)).alias("raw"))
    area = BinaryClassificationEvaluator(rawPredictionCol="raw", numBins=0).evaluate(binary)
    assert metrics.auc(pred, 1).first().auc == pytest.approx(area)


def test_thresholds(spark):
    df = spark.createDataFrame([(0, [0.5, 0.5, 0.0]), (1, [0.2, 0.3, 0.5]), (1, [0.3, 0.35, 0.35])],
                               "label int, probability array<double>")
    assert [r.prediction for r in calibration.apply_thresholds(df, (1, 1, 1)).collect()] == [0.0, 2.0, 1.0]
    assert [r.prediction for r in calibration.apply_thresholds(df, (1, .1, 1)).collect()] == [1.0, 1.0, 1.0]
    nothing = calibration.calibrate(df.limit(0)).first()
    assert tuple(nothing) == (*calibration.DEFAULT, 0.0)


def test_duplicates_count_nulls_as_equal(spark):
    df = spark.createDataFrame([(None, 1), (None, 1), ("a", 1), ("a", 2)], "Text string, n int")
    assert values(profile.duplicates(df), "kind", "extra", "extra_pct") == [("row", 1, 25.0), ("text", 2, 50.0)]
    assert [r.type for r in profile.column_types(df).collect()] == ["string", "int"]


def test_insight_documents(spark, tmp_path):
    now = datetime(2024, 1, 1)
    good, broken = tmp_path / "good.json", tmp_path / "broken.json"
    good.write_text(json.dumps({
        "evaluated_at": "2024-05-05T00:00:00Z", "model_name": "LR", "parameters": {"regParam": "0.1"},
        "metrics": {"accuracy": 0.9, "per_class": {"neutral": {"precision": 1, "recall": 1, "f1": 1}}},
        "confusion_matrix": {"labels": ["a"], "matrix": [[1]]}}, indent=2))
    broken.write_text("{not json")
    ok = storage.ingest_insight(spark, str(good), now).first()
    assert (ok.status, ok.metrics.accuracy, ok.metadata.model_name, ok.errors) == ("ok", 0.9, "LR", [])
    bad = storage.ingest_insight(spark, str(broken), now).first()
    assert bad.status == "missing" and bad.errors[0].startswith("invalid_json") and bad.metrics is None
    gone = storage.ingest_insight(spark, str(tmp_path / "none.json"), now).first()
    assert (gone.status, gone.errors, gone.evaluated_at) == ("missing", ["missing_file"], now.isoformat())
    history = storage.ingest_insight(spark, str(good), now).unionByName(storage.ingest_insight(spark, str(broken), now))
    assert dashboard.latest_insight(history).first().status == "ok"
    none = dashboard.latest_insight(history.limit(0)).first()
    assert (none.status, none.errors, none.metrics) == ("no_data", [], None)


def test_replaced_table_is_never_seen_half_written(spark, tmp_path):
    path = str(tmp_path / "t")
    assert storage.read_table(spark, path) is None
    storage.replace_table(spark.range(3), path, datetime(2024, 1, 1))
    # a version without an entry in the list is one that failed midway
    spark.range(9).write.parquet(f"{path}/data/v=99999999")
    assert storage.read_table(spark, path).count() == 3
    storage.replace_table(spark.range(5), path, datetime(2024, 1, 2))
    assert storage.read_table(spark, path).count() == 5


def test_freshness_of_empty_tables(spark):
    some = spark.sql("SELECT TIMESTAMP_NTZ'2024-01-01 00:00:00' AS aggregated_at")
    row = dashboard.freshness(some, some.limit(0)).first()
    assert row.last_aggregated_at == row.monthly_last_aggregated_at and row.product_last_aggregated_at is None


def test_samples_on_repeated_and_null_keys(spark):
    rows = spark.createDataFrame(
        [("a", None, k) for k in range(3)] + [("a", "x", 9), (None, "x", 1), (None, "x", 2)], "Id string, g string, v int"
    )
    for n in (1, 2, 4, 6, 9):
        assert splits.sample_n(rows, n).count() == min(n, 6)
    by_group = splits.sample_n(rows, 2, by="g").groupBy("g").count().collect()
    assert {r.g: r["count"] for r in by_group} == {None: 2, "x": 2}
    assert splits.sample_n(rows.limit(0), 3).count() == 0


def test_null_probability_decides_nothing(spark):
    rows = spark.createDataFrame([([0.2, 0.3, 0.5],), ([None, 0.3, 0.7],), (None,)], "probability array<double>")
    said = [r.prediction for r in calibration.apply_thresholds(rows).collect()]
    assert said[1:] == [None, None] and said[0] in (0.0, 1.0, 2.0)


def test_nan_is_no_value(spark):
    rows = spark.createDataFrame([(float(x),) for x in (1, 2, 3, 4, 5)] + [(float("nan"),), (None,)], "v double")
    assert [r.q for r in ranking.exact_quantiles(rows, F.col("v"), [0.0, 0.5, 1.0]).orderBy("p").collect()] == [1.0, 3.0, 5.0]


def test_tokens_count_by_row_and_not_by_key(spark):
    rows = spark.createDataFrame([("1", ["good", "good"]), ("1", ["good"]), ("2", ["bad"]), ("3", []), ("4", None)], "Id string, t array<string>")
    counted = sorted((r.Id, r.token, r.tf) for r in text_ops.occurrences(rows, "t").collect())
    assert counted == [("1", "good", 1), ("1", "good", 2), ("2", "bad", 1)]
    assert {r.token: r.df for r in text_ops.idf(rows, "t", minimum=1).collect()} == {"good": 2, "bad": 1}


def test_lemma_rules_repeat_until_nothing_is_left(spark):
    lexicon = spark.createDataFrame([("walk", "v", "walk")], "form string, pos string, lemma string")
    vocabulary = spark.createDataFrame([("walksssss",), ("walkedings",), ("zzz",)], "token string")
    found = {r.token: r.lemma for r in lemma.lemma_table(vocabulary, lexicon).collect()}
    assert found == {"walksssss": "walk", "walkedings": "walk"}


def test_old_table_versions_go(spark, tmp_path):
    from datetime import timedelta

    path = str(tmp_path / "table")
    for k in range(storage.KEPT + 3):
        storage.replace_table(spark.range(k), path, datetime(2024, 1, 1) + timedelta(seconds=k))
    assert len(list((tmp_path / "table" / "data").glob("v=*"))) == storage.KEPT
    assert storage.read_table(spark, path).count() == storage.KEPT + 2


def test_texts_with_one_digest_stay_apart(spark, monkeypatch):
    rows = [("3", "a", 1), ("1", "b", 2), ("2", "a", 3), ("4", None, 4), ("5", None, 5), ("6", "", 6), ("7", "b", 7)]
    df = spark.createDataFrame(rows, "Id string, Text string, n int")
    want = {("2", "a", 3), ("1", "b", 2), ("4", None, 4), ("6", "", 6)}
    assert {tuple(r) for r in cleaning.dedupe_text(df).collect()} == want
    monkeypatch.setattr(cleaning, "text_digest", lambda text: F.lit(0).cast("bigint"))
    assert {tuple(r) for r in cleaning.dedupe_text(df).collect()} == want


def test_texts_are_ordered_by_digest_first(spark):
    df = spark.createDataFrame([("1", "a")], "Id string, Text string")
    plan = cleaning.dedupe_text(df)._jdf.queryExecution().executedPlan().toString()
    sorts = [line for line in plan.splitlines() if "Sort [" in line]
    assert sorts and all("Sort [_digest" in line or "Sort [_groupingexpression" in line for line in sorts), plan
    assert plan.count("Exchange") == 1
