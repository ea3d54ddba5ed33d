"""Metrics work out the columns of predictions once a row, whatever these are made of."""

import pytest
from pyspark.sql import functions as F

from tonegauge.operators import calibration, metrics, ranking
from tonegauge.plans import models as plans


@pytest.mark.parametrize("name", ["m7c_compare", "m11_confidence_histogram", "m12_auc", "m12_roc", "m12_auc_confident", "m12_roc_confident"])
def test_no_filter_repeats_the_columns(name, spark, folder):
    query = getattr(plans, name)(spark, folder)
    plan = query._jdf.queryExecution().optimizedPlan().toString()
    assert "md5" in plan
    assert not [line for line in plan.splitlines() if "Filter" in line and line.count("md5(") > 1]


def _pred(spark):
    rows = [(0, 0.0, [0.5, 0.3, 0.2]), (0, 1.0, [0.2, None, 0.8]), (3, 1.0, None), (None, 2.0, [float("nan"), 0.1]),
            (1, 7.0, []), (2, None, [0.1, 0.2, 0.7, 0.9])]
    return spark.createDataFrame(rows, "label int, prediction double, probability array<double>")


def test_pairs_outside_the_classes_are_left_out(spark):
    found = metrics.pair_counts(_pred(spark)).collect()
    assert sorted((r.label, r.prediction, r.n) for r in found) == [(0, 0, 1), (0, 1, 1)]


def test_values_that_are_missing_are_left_out(spark):
    pred = _pred(spark)
    found = ranking.value_counts(pred, F.get("probability", F.lit(0)), ["label"]).collect()
    assert sorted((r.label, r.value, r.n) for r in found) == [(0, 0.2, 1), (0, 0.5, 1), (2, 0.1, 1)]
    assert calibration.apply_thresholds(pred).filter("prediction is null").count() == 4


def test_curves_take_the_scores_that_are_there(spark):
    points = metrics.roc_curves(_pred(spark)).filter(F.col("threshold") < float("inf")).collect()
    assert sorted((r["class"], r.threshold) for r in points) == [(0, 0.1), (0, 0.2), (0, 0.5), (1, 0.1), (1, 0.2), (1, 0.3), (2, 0.2), (2, 0.7), (2, 0.8)]
