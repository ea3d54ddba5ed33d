"""Evaluation of predictions. All figures come from one grouped count of (label, prediction) pairs."""

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tonegauge.functions import labels, numbers
from tonegauge.operators import ranking
from tonegauge.operators.cleaning import probability_array

CODES = range(len(labels.SENTIMENTS))


def pair_counts(pred: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Rows per label and prediction, pairs outside the known classes left out."""
    def code(name: str) -> Column:
        # a code outside the classes is null: at most sixteen pairs a group leave a task
        return F.get(F.array(*[F.lit(c) for c in CODES]), F.col(name).cast("int")).alias(name)

    coded = pred.select(*(by or []), code("label"), code("prediction"))
    known = F.col("label").isNotNull() & F.col("prediction").isNotNull()
    # pairs are left out after they are counted: a filter on rows would be pushed below the columns and work them out once more
    return coded.groupBy(*(by or []), "label", "prediction").agg(F.count_if(known).alias("n")).filter(F.col("n") > 0)


def _sum_if(condition: Column, value: str = "n") -> Column:
    return F.coalesce(F.sum(F.when(condition, F.col(value))), F.lit(0)).cast("double")


def metrics_of_counts(counts: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Accuracy, weighted precision, recall and F1, and the same per class, one row per group.

    A class that is never predicted or never true scores 0.
    """
    by = by or []
    label, guess = F.col("label"), F.col("prediction")
    cells = counts.groupBy(*by).agg(
        _sum_if(F.lit(True)).alias("all"),
        *[_sum_if((label == c) & (guess == c)).alias(f"hit{c}") for c in CODES],
        *[_sum_if(label == c).alias(f"true{c}") for c in CODES],
        *[_sum_if(guess == c).alias(f"said{c}") for c in CODES],
    )
    per_class = {}
    for c, name in enumerate(labels.SENTIMENTS):
        hit, true, said = F.col(f"hit{c}"), F.col(f"true{c}"), F.col(f"said{c}")
        per_class[f"precision_{name}"] = numbers.safe_divide(hit, said)
        per_class[f"recall_{name}"] = numbers.safe_divide(hit, true)
        per_class[f"f1_{name}"] = numbers.safe_divide(2 * hit, true + said)

    def weighted(kind: str) -> Column:
        parts = [F.col(f"true{c}") * per_class[f"{kind}_{name}"] for c, name in enumerate(labels.SENTIMENTS)]
        return numbers.safe_divide(parts[0] + parts[1] + parts[2], F.col("all"))

    hits = F.col("hit0") + F.col("hit1") + F.col("hit2")
    return cells.select(
        *by,
        numbers.safe_divide(hits, F.col("all")).alias("accuracy"),
        *[weighted(k).alias(f"{k}_weighted") for k in ["f1", "precision", "recall"]],
        *[value.alias(name) for name, value in per_class.items()],
    )


def metrics(pred: DataFrame, digits: int | None = 4) -> DataFrame:
    """One row of metrics, rounded to ``digits`` decimals (None keeps them whole)."""
    out = metrics_of_counts(pair_counts(pred))
    return out if digits is None else out.select(*[F.round(c, digits).alias(c) for c in out.columns])


def confusion(pred: DataFrame, normalise: bool = False) -> DataFrame:
    """One row per true label with a column per prediction, 0-filled; rows can be scaled to shares, 2 decimals."""
    counts = pair_counts(pred).agg(*[
        F.array(*[_sum_if((F.col("label") == r) & (F.col("prediction") == c)).cast("bigint") for c in CODES])
        .alias(f"r{r}")
        for r in CODES
    ])
    rows = F.array(*[
        F.struct(F.lit(r).alias("label"), *[F.get(f"r{r}", F.lit(c)).alias(f"predicted_{c}") for c in CODES])
        for r in CODES
    ])
    table = counts.select(F.inline(rows))
    if not normalise:
        return table
    total = F.col("predicted_0") + F.col("predicted_1") + F.col("predicted_2")
    return table.select(
        "label", *[numbers.percent(F.col(f"predicted_{c}"), total, 0) / 100 for c in CODES]
    ).toDF("label", *[f"predicted_{c}" for c in CODES])


def hits(pred: DataFrame, by: str = "Sentiment") -> DataFrame:
    """Rows per class and whether the prediction was right."""
    right = (F.col("label") == F.col("prediction")).alias("correct")
    return pred.groupBy(by, right).agg(F.count(F.lit(1)).alias("count"))


def confidence(pred: DataFrame) -> DataFrame:
    """Adds the highest class probability and whether the prediction was right."""
    return pred.withColumn("max_prob", F.array_max(probability_array(pred))).withColumn(
        "correct", F.col("label") == F.col("prediction")
    )


def confidence_histogram(pred: DataFrame, bins: int = 50) -> DataFrame:
    from tonegauge.operators import profile

    return profile.histogram(confidence(pred), F.col("max_prob"), ["correct"], bins=bins, clip=None)


def _score_totals(pred: DataFrame, classes: Sequence[int], buckets: int) -> DataFrame:
    """Per class and distinct score: positives and negatives at it and above it, and of the class. One scan for all classes."""
    p = probability_array(pred)
    # a new array: for a column Spark adds a filter on its size, which is pushed below the column and works it out once more
    scores = F.inline(F.array(*[F.struct(F.lit(c).alias("class"), F.get(p, F.lit(c)).alias("score")) for c in classes]))
    rows = pred.select("label", scores).filter(F.col("score").isNotNull() & ~F.isnan("score"))
    # values rise while scores fall
    counts = rows.groupBy("class", (-F.col("score")).alias("value")).agg(
        F.count_if(F.col("label") == F.col("class")).alias("pos"),
        F.count_if(F.col("label") != F.col("class")).alias("neg"),
    )
    spread = ranking.in_ranges(counts, ["class"], buckets, ["pos", "neg"])
    return ranking.running_totals(spread, ["class"], "_bucket", [F.col("value")], ["pos", "neg"])


def roc_curves(pred: DataFrame, classes: Sequence[int] = CODES, buckets: int = 256) -> DataFrame:
    """Points of the one-vs-rest ROC curves: class, threshold, fpr, tpr. Every distinct score is a threshold, and the origin
    has an infinite one."""
    totals = _score_totals(pred, classes, buckets)
    rate = lambda part, total: numbers.safe_divide(part.cast("double"), F.col(total).cast("double"))
    points = totals.select(
        "class", (-F.col("value")).alias("threshold"),
        rate(F.col("neg_before") + F.col("neg"), "_neg_total").alias("fpr"),
        rate(F.col("pos_before") + F.col("pos"), "_pos_total").alias("tpr"),
    )
    origin = pred.sparkSession.createDataFrame([(c,) for c in classes], "class int").select(
        "class", F.lit(float("inf")).alias("threshold"), F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr")
    )
    return points.unionByName(origin)


def roc(pred: DataFrame, cls: int, buckets: int = 256) -> DataFrame:
    """The curve of one class."""
    return roc_curves(pred, [cls], buckets).drop("class")


def aucs(pred: DataFrame, classes: Sequence[int] = CODES, buckets: int = 256) -> DataFrame:
    """Area under each of those curves: per negative the positives above it, ties count half."""
    totals = _score_totals(pred, classes, buckets)
    area = F.sum(F.col("neg").cast("double") * (F.col("pos_before") + F.col("pos") / 2))
    sums = totals.groupBy("class").agg(area.alias("area"), F.sum("pos").alias("p"), F.sum("neg").alias("q"))
    return sums.select("class", numbers.safe_divide(F.col("area"), (F.col("p") * F.col("q")).cast("double")).alias("auc"))


def auc(pred: DataFrame, cls: int, buckets: int = 256) -> DataFrame:
    return aucs(pred, [cls], buckets)


def insight(pred: DataFrame, meta: dict, now: datetime) -> DataFrame:
    """The evaluation as one document row: metrics, confusion matrix and where they come from. ``{rows}`` in the notes becomes
    the number of evaluated rows."""
    counts = pair_counts(pred)
    rows = counts.agg(F.coalesce(F.sum("n"), F.lit(0)).cast("bigint")).scalar()
    out = metrics_of_counts(counts)

    def rounded(name: str) -> Column:
        return F.round(name, 4)

    per_class = F.create_map(*[
        part for name in labels.SENTIMENTS for part in (
            F.lit(name),
            F.struct(*[rounded(f"{k}_{name}").alias(k) for k in ["precision", "recall", "f1"]]),
        )
    ])
    overall = ["accuracy", "f1_weighted", "precision_weighted", "recall_weighted"]
    matrix = counts.agg(F.array(*[
        F.array(*[_sum_if((F.col("label") == r) & (F.col("prediction") == c)).cast("bigint") for c in CODES])
        for r in CODES
    ]).alias("matrix")).scalar()
    parameters = meta.get("hyperparameters") or {}
    pairs = [F.lit(str(x)) for item in parameters.items() for x in item]
    return out.select(
        F.lit(now.strftime("%Y-%m-%dT%H:%M:%SZ")).alias("evaluated_at"),
        *[F.lit(meta.get(k)).cast("string").alias(k) for k in ["model_name", "model_version"]],
        F.lit(meta.get("trained_at", "Unknown")).alias("trained_at"),
        F.lit(meta.get("dataset")).cast("string").alias("dataset"),
        F.struct(*[rounded(c).alias(c) for c in overall], per_class.alias("per_class")).alias("metrics"),
        F.struct(
            F.array(*[F.lit(s) for s in labels.SENTIMENTS]).alias("labels"), matrix.alias("matrix")
        ).alias("confusion_matrix"),
        (F.create_map(*pairs) if pairs else F.create_map().cast("map<string,string>")).alias("parameters"),
        F.replace(F.lit(meta.get("notes")).cast("string"), F.lit("{rows}"), rows.cast("string")).alias("notes"),
    )
