"""The forest fitted on non-zero entries: the same trees from any layout, right counts and gains, and no dense rows."""

import math

import numpy as np
import pytest
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from tonegauge.operators import forest, model_tables, models

SIZE = 30


def made(n=300):
    """Sparse and dense rows with values on both sides of zero, of many values (place 0) and few."""
    rng = np.random.default_rng(7)
    rows = []
    for i in range(n):
        label = int(rng.integers(0, 3))
        x = np.where(rng.random(SIZE) < 0.3, rng.integers(-2, 5, SIZE), 0).astype(float)
        x[0], x[1 + label] = rng.normal(), x[1 + label] + (rng.random() < 0.7)
        places = np.flatnonzero(x)
        vector = Vectors.dense(x) if i % 5 == 0 else Vectors.sparse(SIZE, places.tolist(), x[places].tolist())
        rows.append((str(i), float(label), vector))
    return rows


@pytest.fixture(scope="module")
def rows(spark):
    return spark.createDataFrame(made(), ["Id", "label", "features"]).cache()


@pytest.fixture(autouse=True)
def never_dense(monkeypatch):
    monkeypatch.setattr(forest, "DENSE", -1)


def nodes(spark, model):
    return sorted(model_tables.forest_table(spark, model).collect(), key=lambda r: r["at"])


def test_layout_does_not_matter(spark, rows):
    first = models.train_rf(rows.coalesce(1), numTrees=3, maxDepth=3)
    second = models.train_rf(rows.repartition(7, "Id"), numTrees=3, maxDepth=3)
    assert nodes(spark, first) == nodes(spark, second)


def test_no_row_goes_to_the_dense_trainer(spark, rows, monkeypatch):
    seen, fit = [], RandomForestClassifier.fit
    monkeypatch.setattr(RandomForestClassifier, "fit", lambda self, df, *a: seen.append(df) or fit(self, df, *a))
    models.train_rf(rows, numTrees=2, maxDepth=2)
    assert all(r["features"].numNonzeros() == 0 for df in seen for r in df.collect())


def test_few_numbers_go_to_the_dense_trainer(spark, rows, monkeypatch):
    monkeypatch.setattr(forest, "DENSE", 300 * SIZE * 4)
    settings = {"numTrees": 3, "maxDepth": 3}
    assert nodes(spark, models.train_rf(rows, **settings)) == nodes(spark, models.random_forest(**settings).fit(rows))
    monkeypatch.setattr(forest, "DENSE", 300 * SIZE * 4 - 1)
    assert nodes(spark, models.train_rf(rows, **settings)) != nodes(spark, models.random_forest(**settings).fit(rows))


def gini(counts):
    n = counts.sum()
    return 1 - ((counts / n) ** 2).sum()


def test_counts_and_gains(spark, rows):
    trees, depth, seed = 4, 5, 42
    model = models.train_rf(rows, numTrees=trees, maxDepth=depth)
    path = str(model_tables.storage.shared_dir(spark, "test"))
    model.write().save(path)
    saved = {(r["treeID"], r["nodeData"]["id"]): r["nodeData"] for r in spark.read.parquet(f"{path}/data").collect()}
    own = rows.select("Id", F.xxhash64(F.lit(seed), "Id", "label", "features").alias("h")).collect()
    hashes = {r["Id"]: r["h"] for r in own}
    x = np.array([r[2].toArray() for r in made()])
    label = np.array([int(r[1]) for r in made()])
    draws = forest._drawn(np.array([hashes[r[0]] for r in made()]), trees)
    assert draws.mean() == pytest.approx(1, abs=0.1) and draws.var() == pytest.approx(1, abs=0.15)
    deepest = 0

    def counted(mask, t):
        return np.bincount(label[mask], draws[mask, t], 3)

    def walk(t, node, mask, level):
        nonlocal deepest
        deepest = max(deepest, level)
        data = saved[t, node]
        assert list(data["impurityStats"]) == counted(mask, t).tolist()
        assert data["rawCount"] == draws[mask, t].sum()
        assert data["impurity"] == pytest.approx(gini(counted(mask, t)))
        if data["leftChild"] < 0:
            return 1
        low = x[:, data["split"]["featureIndex"]] <= data["split"]["leftCategoriesOrThreshold"][0]
        sides = [counted(mask & low, t), counted(mask & ~low, t)]
        n = sum(s.sum() for s in sides)
        assert data["gain"] == pytest.approx(gini(counted(mask, t)) - sum(s.sum() / n * gini(s) for s in sides))
        return 1 + walk(t, data["leftChild"], mask & low, level + 1) + walk(t, data["rightChild"], mask & ~low, level + 1)

    assert sum(walk(t, 0, draws[:, t] > 0, 0) for t in range(trees)) == len(saved) == model.totalNumNodes
    assert 2 < deepest <= depth
    # the root's split is the best of all that its features have
    for t in range(trees):
        best, mask = 0, draws[:, t] > 0
        for f in np.random.default_rng([seed, t]).choice(SIZE, math.ceil(math.sqrt(SIZE)), replace=False):
            for cut in cuts_by_rule(x[:, f], 32):
                sides = [counted(mask & (x[:, f] <= cut), t), counted(mask & (x[:, f] > cut), t)]
                if min(s.sum() for s in sides):
                    n = sum(s.sum() for s in sides)
                    best = max(best, gini(counted(mask, t)) - sum(s.sum() / n * gini(s) for s in sides))
        assert saved[t, 0]["gain"] == pytest.approx(best)


def cuts_by_rule(values, bins):
    distinct, n = np.unique(values, return_counts=True)
    middles = (distinct[1:] + distinct[:-1]) / 2
    if len(distinct) <= bins:
        return middles.tolist()
    goal, found, sums = len(values) / bins, [], np.cumsum(n)
    for k, middle in enumerate(middles):
        if abs(sums[k] - goal) < abs(sums[k + 1] - goal):
            found.append(middle)
            goal += len(values) / bins
    return found


def test_cuts(spark, rows):
    x = np.array([r[2].toArray() for r in made()])
    given = rows.select(F.xxhash64("Id").alias("_hash"), F.col("features").alias("_v"))
    got = {r["feature"]: r["cuts"] for r in forest._thresholds(given, 1.0, 32).collect()}
    assert {f: c for f, c in got.items() if c} == {f: pytest.approx(cuts_by_rule(x[:, f], 32)) for f in range(SIZE)}
    assert 20 < len(got[0]) < 32


def test_told_apart_as_by_the_dense_trainer(spark, rows):
    given = rows.withColumn("label", (F.col("Id").cast("int") % 3).cast("double")).select(
        "Id", "label", F.udf(lambda i, v: Vectors.sparse(SIZE, {int(i): 1.0, 9: 2.0}), rows.schema["features"].dataType)(
            F.col("label"), "features").alias("features"))
    for fit in (models.train_rf, lambda df: models.random_forest().fit(df)):
        said = fit(given).transform(given)
        assert said.filter("label <> prediction").count() == 0


def test_rows_that_cannot_be_learned_from(spark, rows):
    one = rows.limit(1)
    for bad in (rows.filter("false"), rows.union(one.withColumn("label", F.lit(None).cast("double"))),
                rows.union(one.withColumn("label", F.lit(0.5)))):
        with pytest.raises(ValueError):
            models.train_rf(bad, numTrees=2, maxDepth=2)
    broken = spark.createDataFrame([("n", 1.0, Vectors.sparse(SIZE, [3], [math.nan]))], rows.schema)
    with pytest.raises(Exception, match="no finite number"):
        models.train_rf(rows.union(broken), numTrees=2, maxDepth=2)


def test_one_value_only(spark, rows):
    """Nothing to split: every tree is a leaf."""
    same = rows.select("Id", "label", F.first("features").over(forest.W.partitionBy(F.lit(1))).alias("features"))
    assert models.train_rf(same, numTrees=2, maxDepth=2).totalNumNodes == 2
