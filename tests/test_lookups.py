"""Lookups of counted tokens, and TF-IDF over them."""

from math import log

from pyspark.sql import functions as F

from tonegauge.operators import text


def test_frequent_and_rare_values_are_both_found(spark):
    rows = spark.createDataFrame([("a", i) for i in range(30)] + [(f"t{i}", i) for i in range(20)] + [(None, 1), ("none", 2)],
                                 "token string, n int")
    small = rows.filter("token <> 'none'").groupBy("token").agg(F.count("*").alias("df"))
    for frequent in (1, 3, 10_000):
        found = text.counted_lookup(rows, small, "token", "df", frequent)
        assert sorted((r.token, r.n, r.df) for r in found.collect()) == sorted(
            [("a", i, 30) for i in range(30)] + [(f"t{i}", i, 1) for i in range(20)])


def test_only_few_values_can_be_frequent(spark):
    small = spark.createDataFrame([(str(i), 1 + i % 5) for i in range(200)], "token string, df bigint")
    total = sum(1 + i % 5 for i in range(200))
    for frequent in (1, 10, 100):
        heavy = small.filter(F.col("df") * frequent > total)
        assert heavy.count() < frequent


def test_tf_idf_on_repeated_null_and_empty_rows(spark):
    rows = spark.createDataFrame(
        [("1", ["a", "a", "b"]), ("1", ["a"]), (None, ["a", "c"]), (None, None), ("5", [])], "Id string, w array<string>")
    found = sorted((r.Id or "", r.token, r.tf, round(r.tfidf, 9)) for r in text.tf_idf(rows, "w", minimum=3).collect())
    weight = round(log(6 / 4), 9)
    assert found == [("", "a", 1, weight), ("", "c", 1, 0.0), ("1", "a", 1, weight), ("1", "a", 2, round(2 * log(6 / 4), 9)), ("1", "b", 1, 0.0)]


def test_tf_idf_of_nothing(spark):
    assert text.tf_idf(spark.createDataFrame([], "Id string, w array<string>"), "w").count() == 0


def test_tokens_are_read_back_and_not_worked_out_again(spark):
    rows = spark.createDataFrame([("1", "some words")], "Id string, Text string")
    found = text.tf_idf(text.tokenise(rows), "words")
    assert "regexp_extract_all" not in found._jdf.queryExecution().executedPlan().toString()
