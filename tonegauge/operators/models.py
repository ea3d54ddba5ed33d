"""Classifiers, hyper-parameter search, benchmark and clustering on Spark ML."""

import time
from collections.abc import Mapping

from pyspark.ml.classification import (
    LinearSVC,
    LogisticRegression,
    NaiveBayes,
    OneVsRest,
    RandomForestClassifier,
)
from pyspark.ml.clustering import KMeans
from pyspark.ml.evaluation import ClusteringEvaluator, MulticlassClassificationEvaluator
from pyspark.ml.tuning import ParamGridBuilder, TrainValidationSplit
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tonegauge.operators import calibration, forest, metrics

# The tuned settings, the first baseline, and the searched grid.
BEST = {"regParam": 0.001, "elasticNetParam": 0.0, "maxIter": 200}
BASELINE = {"regParam": 0.01, "elasticNetParam": 0.0, "maxIter": 100}
SEARCH = {"regParam": [0.0001, 0.001, 0.01], "elasticNetParam": [0.0, 0.2], "maxIter": [100, 200]}
MODEL_NAME, MODEL_VERSION = "LogisticRegression", "v1.0.0"

# In each iteration a block of rows pays for an array of classes times features, 2.4 MB for 100 000 features: blocks of 1 MB,
# which is what the trainer makes by itself, cost more in arrays than in rows. The fit does not depend on it but for rounding.
BLOCK_MB = 16.0


def _weighted(df: DataFrame) -> dict:
    return {"weightCol": "classWeight"} if "classWeight" in df.columns else {}


def logistic_regression(df: DataFrame, **settings) -> LogisticRegression:
    return LogisticRegression(family="multinomial", maxBlockSizeInMB=BLOCK_MB, **{**BEST, **_weighted(df), **settings})


def train_lr(features: DataFrame, **settings):
    """Multinomial logistic regression, weighted when ``classWeight`` is there."""
    return logistic_regression(features, **settings).fit(features)


def linear_svc(df: DataFrame, **settings) -> OneVsRest:
    one = LinearSVC(**{"regParam": 0.01, "maxIter": 100, **settings})
    return OneVsRest(classifier=one, **_weighted(df))


def train_svc(features: DataFrame, **settings):
    """Linear SVM, one class against the rest; weights apply at the outer level."""
    return linear_svc(features, **settings).fit(features)


def naive_bayes(**settings) -> NaiveBayes:
    return NaiveBayes(**{"modelType": "multinomial", "smoothing": 1.0, **settings})


def train_nb(features: DataFrame, **settings):
    return naive_bayes(**settings).fit(features)


def random_forest(**settings) -> RandomForestClassifier:
    return RandomForestClassifier(**{"numTrees": 20, "maxDepth": 10, "seed": 42, **settings})


def train_rf(features: DataFrame, **settings):
    """A random forest, beyond a few hundred MB from non-zero entries alone; a single tree, or settings that ``forest`` lacks,
    is Spark's own fit."""
    estimator = random_forest(**settings)
    if estimator.getNumTrees() == 1 or not forest.SETTINGS.issuperset(settings):
        return estimator.fit(features)
    return forest.fit(features, estimator)


def score(model, features: DataFrame) -> DataFrame:
    return model.transform(features)


def training_metadata(model, num_features: int, now) -> dict:
    return {
        "trained_at": now.strftime("%Y-%m-%dT%H:%M:%SZ"),
        "model_name": MODEL_NAME,
        "model_version": MODEL_VERSION,
        "hyperparameters": {
            "regParam": model.getRegParam(),
            "elasticNetParam": model.getElasticNetParam(),
            "maxIter": model.getMaxIter(),
            "numFeatures": num_features,
        },
    }


def training_history(spark, model) -> DataFrame:
    """Objective per iteration, with the size of the model."""
    rows = [(i, float(v)) for i, v in enumerate(model.summary.objectiveHistory)]
    history = spark.createDataFrame(rows, "iteration int, objective double")
    return history.withColumn("classes", F.lit(model.numClasses)).withColumn("features", F.lit(model.numFeatures))


def ranked(results: DataFrame) -> DataFrame:
    """Adds the mixed score and the ranks by F1, by the mix and by neutral F1. ``results`` has one row per model."""
    from pyspark.sql import Window as W

    mixed = results.withColumn(
        "combined",
        calibration.F1_SHARE * F.col("f1_weighted") + calibration.NEUTRAL_SHARE * F.col("f1_neutral"),
    )
    for name, column in {"f1": "f1_weighted", "combined": "combined", "neutral": "f1_neutral"}.items():
        order = W.partitionBy(F.lit(0)).orderBy(F.desc(column), "model")
        mixed = mixed.withColumn(f"rank_{name}", F.row_number().over(order))
    return mixed


def benchmark(estimators: Mapping[str, object], train: DataFrame, val: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Fits every estimator; gives (ranked metrics with fit time, confusion matrices).

    The features are read once per fit, so both frames should be stored or persisted.
    """
    results, matrices = None, None
    for name, estimator in estimators.items():
        start = time.monotonic()
        model = estimator.fit(train)
        seconds = time.monotonic() - start
        pred = model.transform(val)
        row = metrics.metrics(pred, digits=None).select(
            F.lit(name).alias("model"), "*", F.lit(seconds).alias("train_seconds")
        )
        matrix = metrics.confusion(pred).select(F.lit(name).alias("model"), "*")
        results = row if results is None else results.unionByName(row)
        matrices = matrix if matrices is None else matrices.unionByName(matrix)
    return ranked(results), matrices


def tune_lr(features: DataFrame, grid: Mapping[str, list] = SEARCH, seed: int = 42, parallelism: int = 2):
    """Search by weighted F1 on a held-out fifth; gives (fitted search, table of all scores with the best marked)."""
    estimator = LogisticRegression(family="multinomial", maxBlockSizeInMB=BLOCK_MB, **_weighted(features))
    builder = ParamGridBuilder()
    for name, values in grid.items():
        builder = builder.addGrid(getattr(estimator, name), values)
    maps = builder.build()
    search = TrainValidationSplit(
        estimator=estimator, estimatorParamMaps=maps, trainRatio=0.8, seed=seed, parallelism=parallelism,
        evaluator=MulticlassClassificationEvaluator(metricName="f1"),
    ).fit(features)
    # of tied combinations the search fits the first
    best = search.validationMetrics.index(max(search.validationMetrics))
    rows = [
        (*[float(m[getattr(estimator, name)]) for name in grid], float(f1), place == best)
        for place, (m, f1) in enumerate(zip(maps, search.validationMetrics))
    ]
    columns = ", ".join(f"{name} double" for name in grid)
    table = features.sparkSession.createDataFrame(rows, f"{columns}, f1 double, best boolean")
    return search, table


def cluster(features: DataFrame, k: int = 3, seed: int = 42, iterations: int = 15):
    """K-means; gives (model, rows with their cluster, one row with silhouette and cost)."""
    model = KMeans(featuresCol="features", predictionCol="cluster", k=k, seed=seed, maxIter=iterations).fit(features)
    placed = model.transform(features)
    silhouette = ClusteringEvaluator(predictionCol="cluster", metricName="silhouette").evaluate(placed)
    quality = features.sparkSession.createDataFrame(
        [(k, float(silhouette), float(model.summary.trainingCost))], "k int, silhouette double, cost double"
    )
    return model, placed, quality


def cluster_classifier(placed: DataFrame, seed: int = 42, iterations: int = 15, key: str = "Id"):
    """A classifier that predicts the cluster; gives (model, one row with its accuracy on a held-out fifth)."""
    from tonegauge.operators import splits

    parts = splits.random_split(placed, (("train", 0.8), ("test", 0.2)), seed=seed, key=key)
    estimator = LogisticRegression(
        labelCol="cluster", predictionCol="predicted_cluster", rawPredictionCol="raw_lr",
        probabilityCol="probability_lr", maxIter=iterations, maxBlockSizeInMB=BLOCK_MB,
    )
    model = estimator.fit(parts.filter(F.col("split") == "train"))
    tested = model.transform(parts.filter(F.col("split") == "test"))
    right = F.avg((F.col("cluster") == F.col("predicted_cluster")).cast("double"))
    return model, tested.agg(right.alias("accuracy"), F.count(F.lit(1)).alias("rows"))
