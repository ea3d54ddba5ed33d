"""Insight documents taken in from a folder as they come."""

import json

import pytest
from pyspark.sql import functions as F

from tonegauge.streaming import insights


def put(folder, name, text):
    (folder / name).mkdir(parents=True)
    (folder / name / "part-0.json").write_text(text)


def doc(at, accuracy):
    return json.dumps({"evaluated_at": at, "model_name": "LR", "metrics": {"accuracy": accuracy}}, indent=2)


@pytest.fixture
def place(tmp_path):
    (tmp_path / "files").mkdir()
    return tmp_path


def take_in(spark, place, per_trigger=None):
    stream = insights.documents(spark, str(place / "files"), per_trigger)
    insights.take_in(stream, str(place / "table"), str(place / "checkpoint"), "r").awaitTermination()
    return insights.history(spark, str(place / "table"))


def test_nothing_yet(spark, place):
    none = insights.history(spark, str(place / "table"))
    assert none.count() == 0
    assert insights.latest(none).first().status == "no_data"


def test_late_and_broken_documents(spark, place):
    put(place / "files", "new", doc("2024-05-05T00:00:00Z", 0.9))
    put(place / "files", "broken", "{not json")
    first = take_in(spark, place, per_trigger=1)
    assert {r.document: r.status for r in first.collect()} == {"new": "ok", "broken": "missing"}
    put(place / "files", "late", doc("2024-01-01T00:00:00Z", 0.1))
    # the same moment as 23:30 of the day before
    put(place / "files", "zoned", doc("2024-05-05T01:30:00+02:00", 0.2))
    both = take_in(spark, place)
    assert both.count() == 4
    newest = insights.latest(both).first()
    assert (newest.document, newest.metrics.accuracy, newest.status, newest.errors) == ("new", 0.9, "ok", [])
    broken = both.filter("document = 'broken'").first()
    assert broken.errors[0].startswith("invalid_json") and broken.evaluated_at.endswith("Z") and broken.metrics is None


def test_started_again_takes_in_nothing_twice(spark, place):
    put(place / "files", "one", doc("2024-05-05T00:00:00Z", 0.9))
    assert take_in(spark, place).count() == 1
    assert take_in(spark, place).count() == 1


def test_a_killed_batch_counts_once(spark, place, monkeypatch):
    put(place / "files", "one", doc("2024-05-05T00:00:00Z", 0.9))
    publish = insights.commits.publish

    def dies(*args):
        publish(*args)
        raise RuntimeError("lost behind the publication")

    monkeypatch.setattr(insights.commits, "publish", dies)
    with pytest.raises(Exception, match="lost behind"):
        take_in(spark, place)
    monkeypatch.undo()
    assert take_in(spark, place).count() == 1


def test_expected_documents(spark, place):
    put(place / "files", "one", doc("2024-05-05T00:00:00Z", 0.9))
    expected = spark.createDataFrame([("one",), ("two",), ("two",)], "document string")
    rows = insights.with_missing(take_in(spark, place), expected, "2024-06-01T00:00:00Z")
    found = {r.document: (r.status, r.errors, r.evaluated_at) for r in rows.collect()}
    assert found == {"one": ("ok", [], "2024-05-05T00:00:00Z"), "two": ("missing", ["missing_file"], "2024-06-01T00:00:00Z")}
    assert insights.latest(rows).first().document == "one"
    assert insights.latest(rows.filter(F.col("document") == "two")).first().status == "no_data"
