"""Models as tables: the same answers as the fitted objects, and certificates that notice a wrong table."""

import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from tonegauge.operators import model_tables, models


@pytest.fixture(scope="module")
def rows(spark):
    """Sparse, dense and empty rows of three classes; feature 9 is the same everywhere."""
    made = []
    for i in range(240):
        label = i % 3
        places = sorted({label, 3 + i % 4, 7 if i % 5 else 8, 9})
        values = [2.0 if p == 9 else 1.0 + (i * (p + 1)) % 7 for p in places]
        made.append((str(i), float(label), 1.0 + label, Vectors.sparse(12, places, values)))
    made.append(("dense", 1.0, 2.0, Vectors.dense([0, 3, 0, 1, 0, 0, 0, 0, 2, 2, 0, 0])))
    made.append(("empty", 2.0, 1.0, Vectors.sparse(12, [], [])))
    return spark.createDataFrame(made, ["Id", "label", "classWeight", "features"]).cache()


def raw(model, rows, column="rawPrediction"):
    from pyspark.ml.functions import vector_to_array

    return {r[0]: r[1] for r in model.transform(rows).select("Id", vector_to_array(column)).collect()}


def by_table(frame, column="margins"):
    return {r["Id"]: r[column] for r in frame.collect()}


def close(a, b, by=1e-9):
    assert a.keys() == b.keys()
    for k in a:
        assert a[k] == pytest.approx(b[k], abs=by), k


def test_logistic_regression(spark, rows):
    model = models.train_lr(rows)
    found = model_tables.margins(model_tables.entries(rows), model_tables.linear_table(spark, model))
    close(by_table(found), raw(model, rows))
    close(by_table(model_tables.probabilities(found), "probability"), raw(model, rows, "probability"))
    said = {r["Id"]: r["prediction"] for r in model.transform(rows).collect()}
    assert by_table(model_tables.decided(found), "prediction") == said


def test_linear_svm(spark, rows):
    model = models.train_svc(rows, maxIter=20)
    found = model_tables.margins(model_tables.entries(rows), model_tables.linear_table(spark, model))
    said = {r["Id"]: r["prediction"] for r in model.transform(rows).collect()}
    assert by_table(model_tables.decided(found), "prediction") == said


def test_naive_bayes_is_one_aggregate(spark, rows):
    model = models.train_nb(rows)
    each = model_tables.entries(rows, keep=["label"])
    table = model_tables.naive_bayes_table(each, features=12)
    want = {r["feature"]: r["weights"] for r in model_tables.linear_table(spark, model).collect()}
    got = {r["feature"]: r["weights"] for r in table.collect()}
    assert set(got) == {-1, *range(10)} and set(want) == {-1, *range(12)}
    for feature, weights in got.items():
        assert weights == pytest.approx(want[feature], abs=1e-12)
    close(by_table(model_tables.margins(each, table)), raw(model, rows))


def test_words_unknown_to_the_fit_weigh_nothing(spark):
    train = spark.createDataFrame([("a", 0, ["x", "x", "y"]), ("b", 1, ["y", "z"]), ("c", 1, [])], "Id string, label int, w array<string>")
    table = model_tables.naive_bayes_table(
        model_tables.word_entries(train, "w", keep=["label"]), classes=2, bias=model_tables.BIAS_WORD)
    new = spark.createDataFrame([("n", ["x", "new", ""]), ("none", None), ("empty", [])], "Id string, w array<string>")
    got = by_table(model_tables.margins(model_tables.word_entries(new, "w"), table, classes=2))
    from math import log

    prior = [log(2 / 5), log(3 / 5)]
    assert got["none"] == pytest.approx(prior) and got["empty"] == pytest.approx(prior)
    assert got["n"] == pytest.approx([prior[0] + log(3 / 6), prior[1] + log(1 / 5)])


def test_certificate_notices_a_wrong_table(spark, rows):
    table = model_tables.linear_table(spark, models.train_lr(rows, tol=1e-10, maxIter=500))
    right = model_tables.lr_certificate(rows, table, models.BEST["regParam"], weight="classWeight").collect()
    assert [r["rows"] for r in right] == [80, 81, 81]
    for r in right:
        assert r["gradient"] < 1e-4 and r["share"] == pytest.approx(r["predicted"], abs=1e-4)
    moved = table.withColumn("weights", F.when(F.col("feature") == 1, F.transform("weights", lambda w: w * 1.5)).otherwise(F.col("weights")))
    wrong = model_tables.lr_certificate(rows, moved, models.BEST["regParam"], weight="classWeight").collect()
    assert max(r["gradient"] for r in wrong) > 1e-3
    unweighted = model_tables.lr_certificate(rows, table, models.BEST["regParam"]).collect()
    assert max(abs(r["share"] - r["predicted"]) for r in unweighted) > 1e-3


@pytest.mark.parametrize("to_all", [1 << 18, 0])
def test_forest(spark, rows, to_all, monkeypatch):
    monkeypatch.setattr(model_tables, "NODES_TO_ALL", to_all)
    model = models.train_rf(rows, numTrees=5, maxDepth=4)
    nodes = model_tables.forest_table(spark, model)
    assert nodes.count() == model.totalNumNodes
    assert nodes.filter("feature IS NULL").filter("low IS NOT NULL OR high IS NOT NULL").count() == 0
    close(by_table(model_tables.forest_votes(rows, nodes, 5, 4)), raw(model, rows))


def test_no_rows(spark, rows):
    none = rows.filter("false")
    model = models.train_rf(rows, numTrees=2, maxDepth=2)
    table = model_tables.linear_table(spark, models.train_nb(rows))
    assert model_tables.margins(model_tables.entries(none), table).count() == 0
    assert model_tables.forest_votes(none, model_tables.forest_table(spark, model), 2, 2).count() == 0


def test_null_vector_has_the_bias_only(spark, rows):
    gone = rows.withColumn("features", F.when(F.col("Id") != "5", F.col("features"))).filter("Id in ('5', '6')")
    table = model_tables.linear_table(spark, models.train_nb(rows))
    bias = table.filter("feature = -1").first()["weights"]
    assert by_table(model_tables.margins(model_tables.entries(gone), table))["5"] == pytest.approx(bias)


def test_clusters(spark, rows):
    model, placed, quality = models.cluster(rows, k=3)
    each = model_tables.entries(rows)
    found = model_tables.decided(model_tables.margins(each, model_tables.cluster_table(spark, model)))
    assert by_table(found, "prediction") == {r["Id"]: r["cluster"] for r in placed.collect()}
    squares = each.filter("feature >= 0").groupBy("Id").agg(F.sum(F.col("value") * F.col("value")).alias("xx"))
    distance = F.coalesce("xx", F.lit(0.0)) - 2 * F.array_max("margins")
    cost = found.join(squares, "Id", "left").agg(F.sum(distance)).first()[0]
    assert cost == pytest.approx(quality.first()["cost"], rel=1e-9)
