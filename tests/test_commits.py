"""Batches that are published whole, once, whatever dies in between."""

import json

import pytest
from pyspark.sql import functions as F

from tonegauge.jobs import aggregate, drift_check
from tonegauge.operators import dashboard, profile, splits
from tonegauge.streaming import commits, live, scoring


def rows(spark, start, n):
    return spark.range(start, start + n).select(
        F.col("id").cast("string").alias("Id"), F.lit("P1").alias("ProductId"), F.lit(1.0).alias("prediction"),
        F.lit("neutral").alias("PredictedSentiment"), F.lit("1350777600").alias("Time"),
    )


def ids(spark, path):
    return sorted(int(r.Id) for r in scoring.read_predictions(spark, path).collect())


def test_readers_see_whole_batches(spark, tmp_path):
    path = str(tmp_path / "p")
    assert scoring.read_predictions(spark, path).count() == 0
    scoring.write_predictions(rows(spark, 0, 5), 0, path, run="a")
    before = scoring.read_predictions(spark, path)
    attempt = commits.stage(rows(spark, 5, 5), path, "a", 1)
    assert ids(spark, path) == [0, 1, 2, 3, 4]  # written and not published
    assert commits.publish(spark, path, "a", 1, attempt)
    assert ids(spark, path) == list(range(10)) and before.count() == 5
    other = commits.stage(rows(spark, 100, 3), path, "a", 1)
    assert ids(spark, path) == list(range(10))
    assert not commits.publish(spark, path, "a", 1, other)  # the first attempt stays
    assert ids(spark, path) == list(range(10))
    assert len(list((tmp_path / "p/data/run=a/batch_id=1").glob("attempt=*"))) == 1
    scoring.write_predictions(rows(spark, 50, 2), 1, path, run="b")
    assert ids(spark, path) == [*range(10), 50, 51]
    entries = [json.loads(p.read_text()) for p in (tmp_path / "p/commits").glob("*.json")]
    assert sorted((e["run"], e["batch_id"]) for e in entries) == [("a", 0), ("a", 1), ("b", 1)]


@pytest.mark.parametrize("dies_in", ["publish", "stage", "after"])
def test_a_query_killed_in_a_batch_gives_each_row_once(spark, tmp_path, monkeypatch, dies_in):
    source, path, checkpoint = (str(tmp_path / x) for x in ("in", "out", "c"))
    for start in (0, 10, 20):
        rows(spark, start, 10).coalesce(1).write.mode("append").parquet(source)

    def start():
        stream = spark.readStream.schema(rows(spark, 0, 0).schema).option("maxFilesPerTrigger", 1).parquet(source)
        return scoring.start_append(stream, path, checkpoint, trigger={"availableNow": True})

    calls = []
    real = {n: getattr(commits, n) for n in ("publish", "stage")}

    def dying(*args, **kwargs):
        calls.append(args)
        if len(calls) == 2 and dies_in != "after":
            raise RuntimeError("killed")
        done = real["stage" if dies_in == "stage" else "publish"](*args, **kwargs)
        if len(calls) == 2:
            raise RuntimeError("killed")
        return done

    monkeypatch.setattr(commits, "stage" if dies_in == "stage" else "publish", dying)
    with pytest.raises(Exception, match="killed"):
        start().awaitTermination()
    assert len(ids(spark, path)) == (20 if dies_in == "after" else 10)
    monkeypatch.undo()
    start().awaitTermination()
    assert ids(spark, path) == list(range(30))
    found = scoring.read_predictions(spark, path)
    assert found.select("run").distinct().count() == 1 and {r.batch_id for r in found.collect()} == {0, 1, 2}


def test_jobs_start_before_the_first_prediction(spark, tmp_path):
    none = str(tmp_path / "none")
    assert "Products scored : 0" in aggregate.run(spark, none, str(tmp_path / "results"))
    assert drift_check.run(spark, none, str(tmp_path / "drift")).startswith("Total predictions : 0")
    assert tuple(live.live_stats(spark, none).select("positive", "neutral", "negative", "total").first()) == (0, 0, 0, 0)
    assert live.live_trend(spark, none).count() == 0


def test_newest_ids_by_number(spark):
    found = rows(spark, 1, 12).unionByName(rows(spark, 0, 1).withColumn("Id", F.lit("x9"))).select(
        "*", F.lit(3).alias("batch_id"), *[F.lit("").alias(c) for c in ("ProfileName", "Score", "Summary", "ProcessingTime")]
    )
    assert [r.Id for r in dashboard.recent(found, 4).collect()] == ["12", "11", "10", "9"]
    assert [r.Id for r in dashboard.recent(found, 13).collect()][-1] == "x9"


def test_rows_without_a_key_are_drawn(spark):
    found = spark.range(600).select(F.lit(None).cast("string").alias("Id"), F.col("id").alias("v"), F.lit("neutral").alias("Sentiment"))
    assert 230 < splits.sample(found, 0.5).count() < 370
    parts = {r.split: r["count"] for r in splits.random_split(found).groupBy("split").count().collect()}
    assert 420 < parts["train"] < 540 and sum(parts.values()) == 600
    parts = {r.split: r["count"] for r in splits.approx_split(found).groupBy("split").count().collect()}
    assert 420 < parts["train"] < 540 and set(parts) == {"train", "val", "test"}


def test_nan_is_missing(spark):
    found = spark.createDataFrame([(1.0, "a"), (float("nan"), None), (None, "b")], "x double, y string")
    assert [tuple(r) for r in profile.missing(found).collect()] == [("x", 2, 66.67), ("y", 1, 33.33)]
