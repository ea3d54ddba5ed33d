"""Fitted models as tables, scored by joins, with the conditions that a fit must meet.

Rows of features are sparse entries (key, feature, value). A linear model is one row per feature with a weight for each
class; the intercepts are the row of the feature ``bias``. A forest is one row per node. The same tables serve features
that are numbers (places of a vector) and features that are words.
"""

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tonegauge.operators.text import salted_lookup
from tonegauge.sources import storage

#: The place of the intercepts among numbered features, and among words.
BIAS, BIAS_WORD = -1, ""


def _parts(vector: str) -> Column:
    """A vector column as its stored form: places and values; a dense vector has values only."""
    return F.unwrap_udt(F.col(vector))


def entries(df: DataFrame, key: str = "Id", vector: str = "features", keep: Sequence[str] = ()) -> DataFrame:
    """Non-zero entries of ML vectors, and one bias entry per row, as key, kept columns, feature, value.

    ``key`` must tell rows apart; a null vector gives the bias only.
    """
    rows = df.select(key, *keep, _parts(vector).alias("_v"))
    values = F.coalesce(F.col("_v.values"), F.array().cast("array<double>"))
    dense = F.transform(values, lambda _, i: i)
    places = F.when(F.col("_v.type") == 0, F.col("_v.indices")).otherwise(dense)
    pairs = F.filter(F.arrays_zip(places.alias("feature"), values.alias("value")), lambda e: e["value"] != 0)
    bias = F.array(F.struct(F.lit(BIAS).alias("feature"), F.lit(1.0).alias("value")))
    return rows.select(key, *keep, F.inline(F.concat(bias, F.coalesce(pairs, F.slice(bias, 1, 0)))))


def word_entries(df: DataFrame, tokens: str, key: str = "Id", keep: Sequence[str] = ()) -> DataFrame:
    """Token counts of rows and one bias entry per row, as key, kept columns, feature, value. ``key`` must tell rows apart."""
    found = F.filter(F.coalesce(F.col(tokens), F.array().cast("array<string>")), lambda t: t != BIAS_WORD)
    each = df.select(key, *keep, F.explode(F.concat(F.array(F.lit(BIAS_WORD)), found)).alias("feature"))
    return each.groupBy(key, *keep, "feature").agg(F.count(F.lit(1)).cast("double").alias("value"))


def linear_table(spark: SparkSession, model) -> DataFrame:
    """feature, weights of a logistic regression, of a linear SVM per class or of a naive Bayes model.

    A fitted model of this kind is held by the driver; the table has one row per feature with a weight that is not 0.
    """
    if hasattr(model, "models"):
        matrix = np.array([one.coefficients.toArray() for one in model.models])
        bias = np.array([one.intercept for one in model.models])
    elif hasattr(model, "theta"):
        matrix, bias = model.theta.toArray(), model.pi.toArray()
    else:
        matrix, bias = model.coefficientMatrix.toArray(), model.interceptVector.toArray()
    used = np.flatnonzero(matrix.any(axis=0))
    weights = [bias.tolist(), *matrix[:, used].T.tolist()]
    table = pd.DataFrame({"feature": np.concatenate([[BIAS], used]).astype("int32"), "weights": weights})
    return spark.createDataFrame(table, "feature int, weights array<double>")


def cluster_table(spark: SparkSession, model) -> DataFrame:
    """feature, weights of a k-means model: a place of all centres; the bias has minus half their squared lengths.

    The margins are then largest for the nearest centre, and ``|x|^2 - 2 * margin`` is the squared distance to it.
    """
    centres = np.array(model.clusterCenters())
    used = np.flatnonzero(centres.any(axis=0))
    weights = [(-0.5 * (centres ** 2).sum(axis=1)).tolist(), *centres[:, used].T.tolist()]
    table = pd.DataFrame({"feature": np.concatenate([[BIAS], used]).astype("int32"), "weights": weights})
    return spark.createDataFrame(table, "feature int, weights array<double>")


def naive_bayes_table(
    rows: DataFrame, classes: int = 3, label: str = "label", smoothing: float = 1.0, features: int | None = None,
    bias: int | str = BIAS,
) -> DataFrame:
    """A multinomial naive Bayes fit as one aggregate: feature, weights (log likelihoods; the bias row has log priors).

    ``rows`` are entries with their label. A feature that no training row has is not in the table. ``features`` is the
    size of the feature space; by default the number of features seen.
    """
    sums = [F.sum(F.when(F.col(label) == c, F.col("value")).otherwise(0.0)).alias(f"_{c}") for c in range(classes)]
    counts = rows.filter(F.col(label).between(0, classes - 1)).groupBy("feature").agg(*sums)
    is_bias = F.col("feature") == F.lit(bias)
    totals = counts.agg(
        F.count_if(~is_bias).cast("double").alias("_features"),
        F.sum(F.when(is_bias, sum((F.col(f"_{c}") for c in range(classes)), F.lit(0.0)))).alias("_rows"),
        *[F.sum(F.when(~is_bias, F.col(f"_{c}")).otherwise(0.0)).alias(f"_total{c}") for c in range(classes)],
    )
    size = F.col("_t._features") if features is None else F.lit(float(features))
    joined = counts.withColumn("_t", totals.select(F.struct("*")).scalar())

    def weight(c: int) -> Column:
        prior = F.log(F.col(f"_{c}") + smoothing) - F.log(F.col("_t._rows") + classes * smoothing)
        likelihood = F.log(F.col(f"_{c}") + smoothing) - F.log(F.col(f"_t._total{c}") + size * smoothing)
        return F.when(is_bias, prior).otherwise(likelihood)

    return joined.select("feature", F.array(*[weight(c) for c in range(classes)]).alias("weights"))


def margins(rows: DataFrame, table: DataFrame, classes: int = 3, key: str = "Id") -> DataFrame:
    """key, margins: the sum of value times weight per class. Features that the table lacks have weight 0.

    A sparse join: a feature that every row has is spread by the row's key, and products are summed before the shuffle.
    """
    joined = salted_lookup(rows.select(key, "feature", "value"), table, "feature", key)
    sums = [F.sum(F.col("value") * F.get("weights", F.lit(c))).alias(f"_{c}") for c in range(classes)]
    return joined.groupBy(key).agg(*sums).select(key, F.array(*[F.col(f"_{c}") for c in range(classes)]).alias("margins"))


def decided(df: DataFrame, column: str = "margins") -> DataFrame:
    """Adds ``prediction``, the class with the largest value; of equal ones the first."""
    return df.withColumn("prediction", (F.array_position(column, F.array_max(column)) - 1).cast("double"))


def probabilities(df: DataFrame, column: str = "margins") -> DataFrame:
    """Adds ``probability``, the soft maximum of the margins."""
    shifted = df.withColumn("_e", F.transform(column, lambda m: F.exp(m - F.array_max(column))))
    total = F.aggregate("_e", F.lit(0.0), lambda a, x: a + x)
    return shifted.withColumn("_sum", total).withColumn(
        "probability", F.transform("_e", lambda e: e / F.col("_sum"))
    ).drop("_e", "_sum")


def lr_certificate(
    train: DataFrame, table: DataFrame, reg: float, classes: int = 3, key: str = "Id", vector: str = "features",
    label: str = "label", weight: str | None = None,
) -> DataFrame:
    """How far a logistic regression with an L2 penalty on standardised features is from its only optimum.

    One row per class: ``rows``; ``share`` (weighted share of the class by label) and ``predicted`` (by mean probability;
    equal at the optimum, as intercepts are not penalised); ``gradient``, the largest absolute derivative of the loss by a
    standardised coefficient. The gradient is worked out from rows and table alone, with no use of the trainer.
    """
    w = F.lit(1.0) if weight is None else F.col(weight)
    kept = train.select(key, vector, F.col(label).cast("int").alias("_label"), w.cast("double").alias("_w"))
    each = entries(kept, key, vector, ["_label", "_w"])
    scored = probabilities(margins(each, table, classes, key)).select(key, "probability")
    seen = storage.stored(each.join(scored, key), "certificate")

    def residual(c: int) -> Column:
        return F.get("probability", F.lit(c)) - F.when(F.col("_label") == c, 1.0).otherwise(0.0)

    per_feature = seen.groupBy("feature").agg(
        F.sum(F.col("_w") * F.col("value")).alias("_x"),
        F.sum(F.col("_w") * F.col("value") * F.col("value")).alias("_xx"),
        *[F.sum(F.col("_w") * F.col("value") * residual(c)).alias(f"_g{c}") for c in range(classes)],
    )
    rows = seen.filter(F.col("feature") == BIAS)
    totals = rows.agg(
        F.sum("_w").alias("_total"), F.sum(F.col("_w") * F.col("_w")).alias("_squares"),
        *[F.count_if(F.col("_label") == c).alias(f"_n{c}") for c in range(classes)],
        *[F.sum(F.when(F.col("_label") == c, F.col("_w")).otherwise(0.0)).alias(f"_y{c}") for c in range(classes)],
        *[F.sum(F.col("_w") * F.get("probability", F.lit(c))).alias(f"_p{c}") for c in range(classes)],
    )
    total = F.col("_t._total")
    variance = (F.col("_xx") - F.col("_x") * F.col("_x") / total) / (total - F.col("_t._squares") / total)
    spread = (
        per_feature.filter(F.col("feature") != BIAS).join(table, "feature", "left")
        .withColumn("_t", totals.select(F.struct("*")).scalar()).withColumn("_sd", F.sqrt(variance)).filter(F.col("_sd") > 0)
    )

    def derivative(c: int) -> Column:
        beta = F.coalesce(F.get("weights", F.lit(c)), F.lit(0.0))
        return F.abs(F.col(f"_g{c}") / total / F.col("_sd") + reg * beta * F.col("_sd"))

    steep = spread.agg(*[F.max(derivative(c)).alias(f"_d{c}") for c in range(classes)])
    per_class = F.array(*[
        F.struct(
            F.lit(c).alias("class"), F.col(f"_n{c}").alias("rows"), (F.col(f"_y{c}") / F.col("_total")).alias("share"),
            (F.col(f"_p{c}") / F.col("_total")).alias("predicted"), F.col(f"_s._d{c}").alias("gradient"),
        ) for c in range(classes)
    ])
    return totals.withColumn("_s", steep.select(F.struct("*")).scalar()).select(F.inline(per_class))


#: Nodes up to which a forest's table goes to every task (some 200 bytes each); a larger one is joined by shuffles.
NODES_TO_ALL = 1 << 18


def forest_table(spark: SparkSession, model) -> DataFrame:
    """at (tree, node), feature (null for a leaf), threshold, low, high (children) and shares (class shares of the node).

    The model is written to the shared folder and read back as rows: its nodes never pass through the driver. Splits
    are by threshold: the features of texts are numbers.
    """
    path = storage.shared_dir(spark, "forest")
    model.write().save(path)
    nodes = spark.read.parquet(f"{path}/data").select("treeID", "nodeData.*")
    total = F.aggregate("impurityStats", F.lit(0.0), lambda a, x: a + x)
    inner = F.col("leftChild") >= 0
    return nodes.select(
        F.struct(F.col("treeID").alias("tree"), F.col("id").alias("node")).alias("at"),
        F.when(inner, F.col("split.featureIndex")).alias("feature"),
        F.when(inner, F.get("split.leftCategoriesOrThreshold", F.lit(0))).alias("threshold"),
        F.when(inner, F.col("leftChild")).alias("low"),
        F.when(inner, F.col("rightChild")).alias("high"),
        F.transform("impurityStats", lambda s: s / total).alias("shares"),
    )


def forest_votes(
    df: DataFrame, nodes: DataFrame, trees: int, depth: int, classes: int = 3, key: str = "Id", vector: str = "features"
) -> DataFrame:
    """key, margins: class shares of the leaves that a row reaches, summed over the trees.

    All rows start at the root of every tree and go down one level with each join, so a tree of any shape is done
    after ``depth`` joins. A place that a sparse vector does not have is 0.
    """
    walk = nodes.drop("shares")
    few = nodes.limit(NODES_TO_ALL + 1).count() <= NODES_TO_ALL
    each = df.select(key, _parts(vector).alias("_v"), F.explode(F.sequence(F.lit(0), F.lit(trees - 1))).alias("_tree"))
    rows = each.select(key, "_v", F.struct(F.col("_tree").alias("tree"), F.lit(0).alias("node")).alias("at"))
    place = F.when(F.col("_v.type") == 0, F.array_position("_v.indices", F.col("feature")) - 1).otherwise(F.col("feature"))
    value = F.coalesce(F.get("_v.values", place.cast("int")), F.lit(0.0))
    following = F.when(F.col("feature").isNull(), F.col("at.node")).when(
        value <= F.col("threshold"), F.col("low")).otherwise(F.col("high"))

    def looked_up(rows: DataFrame, table: DataFrame) -> DataFrame:
        return rows.join(F.broadcast(table), "at") if few else salted_lookup(rows, table, "at", key)

    for _ in range(depth):
        step = looked_up(rows, walk)
        rows = step.select(key, "_v", F.struct(F.col("at.tree").alias("tree"), following.alias("node")).alias("at"))
    leaves = looked_up(rows.select(key, "at"), nodes.select("at", "shares"))
    sums = [F.sum(F.get("shares", F.lit(c))).alias(f"_{c}") for c in range(classes)]
    return leaves.groupBy(key).agg(*sums).select(key, F.array(*[F.col(f"_{c}") for c in range(classes)]).alias("margins"))
