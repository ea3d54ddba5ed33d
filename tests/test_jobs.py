"""The jobs from a review file to the drift report, and the streams."""

import csv
import random
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tonegauge import schemas
from tonegauge.jobs import aggregate, drift_check, evaluate, preprocess, stream_score, train
from tonegauge.operators import dashboard, features, models
from tonegauge.operators.sentiment_model import SentimentModel
from tonegauge.sources import reviews, storage
from tonegauge.streaming import live, scoring

NOW = datetime(2024, 1, 1)
WORDS = {1: "bad awful waste not good terrible", 3: "average okay fine nothing special", 5: "great love best tasty"}


@pytest.fixture(scope="module")
def review_file(tmp_path_factory):
    path = tmp_path_factory.mktemp("reviews") / "reviews.csv"
    rng = random.Random(1)
    with open(path, "w", newline="") as f:
        out = csv.writer(f)
        out.writerow(schemas.REVIEW_COLUMNS)
        for i in range(300):
            score = rng.choice([1, 3, 5, 5])
            text = " ".join(rng.choices(WORDS[score].split() + ["product", "shop's", "boxes"], k=12)) + f" n{i}"
            out.writerow([i, f"P{i % 7}", f"U{i % 20}", "N", 1, 2, score, 1350777600 + i * 86400, "sum", text])
    return str(path)


@pytest.fixture(scope="module")
def trained(spark, review_file, tmp_path_factory):
    output = str(tmp_path_factory.mktemp("output"))
    preprocess.run(spark, review_file, output, features.FeatureSettings(num_features=1 << 10))
    train.run(spark, output, now=NOW, maxIter=20)
    return output


def test_training_chain(spark, trained, tmp_path):
    history = str(tmp_path / "insights")
    evaluate.run(spark, trained, history, NOW)
    row = dashboard.latest_insight(spark.read.parquet(history)).first()
    assert row.status == "ok" and row.metrics.accuracy > 0.9
    assert row.metadata.model_name == "LogisticRegression" and row.metadata.trained_at == "2024-01-01T00:00:00Z"
    assert sum(sum(r) for r in row.confusion_matrix.matrix) == 32
    saved = storage.load_features(spark, f"{trained}/features")
    assert {r.split: r["count"] for r in saved.groupBy("split").count().collect()}["train"] > 230
    assert features.nonzero_summary(saved).first().max < 100


def test_stream_equals_batch_and_replay_changes_nothing(spark, trained, review_file, tmp_path):
    topic, stored = str(tmp_path / "topic"), str(tmp_path / "predictions")
    rows = reviews.read_review_text(spark, review_file)
    reviews.publish(rows.filter("CAST(Id AS INT) < 200"), topic)
    args = (f"{trained}/model", topic, stored, str(tmp_path / "checkpoint"))
    now = {"trigger": {"availableNow": True}}
    stream_score.run(spark, *args, **now).awaitTermination()
    reviews.publish(rows.filter("CAST(Id AS INT) >= 200").unionByName(rows.limit(0)), topic)
    stream_score.run(spark, *args, **now).awaitTermination()
    pred = scoring.read_predictions(spark, stored)
    assert pred.count() == 300 and pred.select("batch_id").distinct().count() == 2
    model = SentimentModel.load(spark, f"{trained}/model")
    batch = model.predictions(reviews.decode(reviews.as_json(rows)))
    assert pred.select("Id", "prediction", "Text").exceptAll(batch.select("Id", "prediction", "Text")).count() == 0
    scoring.write_predictions(batch.filter("CAST(Id AS INT) >= 200"), 1, stored, run=pred.first()["run"])
    pred = scoring.read_predictions(spark, stored)
    assert pred.count() == 300
    assert model.thresholds is not None and "prediction" in model.predict(rows.limit(5), calibrated=True).columns

    results = str(tmp_path / "results")
    report = aggregate.run(spark, stored, results, NOW)
    assert "Products scored : 7" in report
    monthly = storage.read_table(spark, f"{results}/monthly")
    assert dashboard.overall_from_monthly(monthly).first() == dashboard.overall_stats(pred).first()
    assert dashboard.trend_from_monthly(monthly).collect() == dashboard.live_trend(pred).collect()
    text = drift_check.run(spark, stored, str(tmp_path / "drift"), NOW)
    assert text.startswith("Total predictions : 300")

    fallback = features.FeatureModel.load(spark, f"{trained}/model/features", with_weights=False)
    assert "features" in fallback.transform(rows).columns


def test_rows_without_id_are_scored(spark, trained):
    model = SentimentModel.load(spark, f"{trained}/model")
    df = reviews.decode(spark.createDataFrame([('{"Text": "loves boxes"}',), ("broken",), ('{"Text": "loves boxes"}',)], "value string"))
    assert model.predictions(df).count() == 3
    tokens = [r.tokens for r in model.features.tokens(df).collect()]
    assert sorted(t for row in tokens for t in row if t == "box") in ([], ["box", "box"])


def test_live_recent_survives_a_replay(spark, tmp_path):
    path, source = str(tmp_path / "recent"), str(tmp_path / "in")
    schema = ", ".join(f"{c} string" for c in live.RECENT_COLUMNS)
    for start in (0, 10):
        ids = spark.range(start, start + 10).select(
            F.format_string("%03d", "id").alias("Id"), *[F.lit("x").alias(c) for c in live.RECENT_COLUMNS[1:]])
        ids.coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(schema).parquet(source)
        live.start_recent(stream, path, str(tmp_path / "c"), 12, {"availableNow": True}).awaitTermination()
    first = [r.Id for r in storage.read_table(spark, path).orderBy(F.desc("Id")).collect()]
    assert first == [f"{i:03d}" for i in range(19, 7, -1)]
    # the same files again under a new checkpoint are batch 0 once more
    stream = spark.readStream.schema(schema).parquet(source)
    live.start_recent(stream, path, str(tmp_path / "c2"), 12, {"availableNow": True}).awaitTermination()
    assert storage.read_table(spark, path).count() == 12


def test_replay_is_paced_by_files(spark, review_file, tmp_path):
    rows = reviews.read_review_text(spark, review_file)
    rows.repartition(3).write.option("header", True).option("escape", '"').csv(str(tmp_path / "files"))
    query = (live.replay(spark, str(tmp_path / "files")).writeStream.format("parquet")
             .option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "c"))
             .trigger(availableNow=True).start())
    query.awaitTermination()
    assert len([p for p in query.recentProgress if p["numInputRows"]]) == 3
    assert reviews.decode(spark.read.parquet(str(tmp_path / "out"))).filter("Id IS NOT NULL").count() == 300


def test_tuning_and_benchmark(spark, trained):
    rows = storage.load_features(spark, f"{trained}/features").persist()
    small, val = rows.filter("split = 'train'"), rows.filter("split = 'val'")
    search, table = models.tune_lr(small, {"regParam": [0.01, 0.1], "maxIter": [5]})
    assert table.filter("best").count() >= 1 and table.count() == 2
    results, matrices = models.benchmark(
        {"svc": models.linear_svc(small, maxIter=5), "forest": models.random_forest(numTrees=3, maxDepth=3)}, small, val)
    assert sorted(r.rank_f1 for r in results.collect()) == [1, 2] and matrices.count() == 6
