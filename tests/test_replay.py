"""Replay at a rate: pace, restart, limit, and the publishing job."""

import csv
import time

import pytest
from pyspark.sql import functions as F

from tonegauge import schemas
from tonegauge.jobs import publish
from tonegauge.sources import reviews
from tonegauge.streaming import commits, replay


def rows(spark, n):
    return spark.range(n).selectExpr("concat('r', id) AS Id", "id AS number")


def test_rows_a_second_and_restart(spark, tmp_path):
    path, checkpoint, times = str(tmp_path / "out"), str(tmp_path / "c"), []

    def send(batch, number, run):
        times.append((time.monotonic(), batch.count()))
        commits.write(batch, path, run, number)

    first = replay.start_paced(rows(spark, 1500), checkpoint, 100, send, interval=1.0)
    assert not first.wait(11)
    first.stop()
    held = commits.read(spark, path, "Id string").count()
    assert 700 <= held <= 1200 and all(n == 100 for _, n in times)
    gaps = times[-1][0] - times[2][0]
    assert (len(times) - 3) * 100 / gaps == pytest.approx(100, rel=0.1)
    time.sleep(2)  # standing still is not made up for
    before = len(times)
    second = replay.start_paced(rows(spark, 1500), checkpoint, 200, send, interval=1.0)
    assert second.wait(60)
    later = times[before:]
    assert len(later) * 200 <= 1500 - held + 400
    found = [r.Id for r in commits.read(spark, path, "Id string").collect()]
    assert sorted(found) == sorted(f"r{k}" for k in range(1500))


def test_limit(spark, tmp_path):
    for limit, want in ((7, 7), (0, 30), (99, 30)):
        got = []
        running = replay.start_paced(
            rows(spark, 30), str(tmp_path / f"c{limit}"), 1000, lambda b, n, r, got=got: got.extend(x.Id for x in b.collect()), limit, 0.2
        )
        assert running.wait(30) and got == [f"r{k}" for k in range(want)]
    assert replay.start_paced(rows(spark, 0), str(tmp_path / "none"), 10, lambda b, n, r: 1 / 0, interval=0.2).wait(30)
    with pytest.raises(ValueError):
        replay.start_paced(rows(spark, 1), str(tmp_path / "zero"), 0, None)


def test_publishing_job(spark, tmp_path):
    (tmp_path / "in").mkdir()
    for name, count in (("a", 5), ("b", 4)):
        with open(tmp_path / "in" / f"{name}.csv", "w", newline="") as f:
            out = csv.writer(f, lineterminator="\n")
            out.writerow(schemas.REVIEW_COLUMNS)
            out.writerows([["" if k == 2 else f"{name}{k}", "P", "U", "N", 1, 1, 5, "", "s", f"two\nlines, {k}"] for k in range(count)])
    topic = str(tmp_path / "topic")
    assert publish.run(spark, str(tmp_path / "in"), topic, str(tmp_path / "c"), rate=100, limit=8, now=77, interval=0.2, seconds=60)
    sent = reviews.decode(spark.read.text(topic)).collect()
    assert sorted(r.Id for r in sent) == ["TEST_003", "TEST_003", "a0", "a1", "a3", "a4", "b0", "b1"]
    assert all(r.Time == "77" and r.Text.startswith("two\nlines") for r in sent)


def test_a_batch_opens_the_files_of_its_own_numbers(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(replay, "FOLDER_ROWS", 10)
    laid = replay._laid_out(rows(spark, 95).repartition(3), str(tmp_path / "c"), 0)
    for first, last, folders in ((0, 9, 1), (5, 24, 3), (90, 99, 1), (94, 200, 1)):
        batch = replay._between(laid, first, last)
        plan = batch._jdf.queryExecution().executedPlan()
        assert sorted(r.Id for r in batch.collect()) == sorted(f"r{k}" for k in range(first, min(last, 94) + 1))
        assert batch.columns == ["Id"] and "PartitionFilters: [isnotnull(_folder" in plan.toString()
        read = batch.select(F.input_file_name().alias("f")).distinct().collect()
        assert len({r.f.split("_folder=")[1].split("/")[0] for r in read}) == folders
    again = replay._laid_out(rows(spark, 95), str(tmp_path / "c"), 0)
    assert again.inputFiles() and sorted(again.inputFiles()) == sorted(laid.inputFiles())
