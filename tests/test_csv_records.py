"""Multi-line CSV read in small splits, against one parser that reads a file from its start."""

import csv
import random
from collections import Counter

import pytest
from pyspark.sql import types as T

from tonegauge.sources import csv_records, reviews

SCHEMA = T.StructType([T.StructField(c, T.StringType()) for c in "abc"])


def field(rng):
    return rng.choice([
        "", 'x,"y" z', "\n".join(f'l{k} "q" ü' for k in range(rng.randrange(1, 30))), '""', "a\r\nb", ' lead "', f"plain{rng.randrange(99)}",
    ])


@pytest.fixture(scope="module")
def files(tmp_path_factory):
    """LF and CR LF files: empty ones, with empty lines, a header over two lines, and one that ends inside a field."""
    rng, folder = random.Random(3), tmp_path_factory.mktemp("csv")
    for n, rows in enumerate([0, 1, 150, 200]):
        for kind, end in (("lf", "\n"), ("crlf", "\r\n")):
            with open(folder / f"{kind}{n}.csv", "w", newline="", encoding="utf8") as f:
                out = csv.writer(f, lineterminator=end)
                out.writerow(["a", "b\nhead", "c"])
                for k in range(rows):
                    out.writerow([field(rng), field(rng), str(k)])
                    if rng.random() < 0.1:
                        f.write(end)
                if n == 3 and kind == "lf":
                    f.write('"open to the end\nof the file')
    return folder


@pytest.fixture(params=["64", "300", "5000", "134217728"])
def split_bytes(spark, request):
    held = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", request.param)
    yield request.param
    spark.conf.set("spark.sql.files.maxPartitionBytes", held)


def test_like_one_reader_a_file(spark, files, split_bytes):
    path = f"{files}/lf*.csv"
    whole = spark.read.schema(SCHEMA).option("header", True).option("multiLine", True).option("escape", '"').csv(path)
    assert Counter(map(tuple, csv_records.read(spark, path, SCHEMA).collect())) == Counter(map(tuple, whole.collect()))


def test_crlf_like_python(spark, files, split_bytes):
    want = Counter()
    for name in files.glob("crlf*.csv"):
        with open(name, newline="", encoding="utf8") as f:
            want.update(tuple(x or None for x in r) for r in list(csv.reader(f))[1:] if r)
    assert Counter(map(tuple, csv_records.read(spark, f"{files}/crlf*.csv", SCHEMA).collect())) == want


def test_one_file_is_read_by_many_tasks(spark, tmp_path):
    text = "\n".join('he said "yes", then\nno' for _ in range(40))
    with open(tmp_path / "r.csv", "w", newline="", encoding="utf8") as f:
        out = csv.writer(f, lineterminator="\n")
        out.writerow(["a", "b", "c"])
        out.writerows([[str(k), text, "x"] for k in range(300)])
    held = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        assert csv_records.lines(spark, str(tmp_path)).rdd.getNumPartitions() > 8
        found = csv_records.read(spark, str(tmp_path), SCHEMA, strict=True)
        assert sorted((int(r.a), r.b, r.c) for r in found.collect()) == [(k, text, "x") for k in range(300)]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", held)


def test_without_header_and_strict(spark, tmp_path):
    (tmp_path / "r.csv").write_text('1,"a\nb",c\n2,only\n')
    assert csv_records.records(spark, str(tmp_path), header=False).count() == 2
    with pytest.raises(Exception, match="(?i)malformed"):
        csv_records.read(spark, str(tmp_path), SCHEMA, header=False, strict=True).collect()
    rows = csv_records.read(spark, str(tmp_path), SCHEMA, header=False).collect()
    assert {tuple(r) for r in rows} == {("1", "a\nb", "c"), ("2", "only", None)}


def test_written_reviews_come_back(spark, tmp_path):
    rows = [("1", ' "a", b', "x\r\ny\n"), ("2", None, "\n"), ("3", '"', " ")]
    frame = spark.createDataFrame(rows, "Id string, Summary string, Text string")
    reviews.write_review_text(frame, str(tmp_path / "out"))
    assert {(r.Id, r.Summary, r.Text) for r in reviews.read_review_text(spark, str(tmp_path / "out")).collect()} == set(rows)
