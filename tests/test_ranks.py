"""Ranks from sketched ranges: outliers and crowded values neither change a rank nor fill one task."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tonegauge.operators import metrics, profile, ranking

SHARES = [0.0, 0.1, 0.25, 0.5, 0.75, 0.99, 1.0]


def frame(spark, groups):
    rows = [(g, float(x)) for g, values in groups.items() for x in values]
    return spark.createDataFrame(rows, "g string, x double")


def test_quantiles_like_numpy(spark):
    rng = np.random.default_rng(2)
    groups = {
        "outlier": [*rng.normal(size=3000), 1e12, -1e300], "crowded": 1 - rng.random(3000) * 1e-5, "ties": rng.integers(0, 3, 2000),
        "one": [7.0], "two": [1.0, 2.0], "same": [4.0] * 50, None: rng.random(100), "few": rng.random(300) * 100,
    }
    got = ranking.exact_quantiles(frame(spark, groups), F.col("x"), SHARES, ["g"])
    found = {(r.g, r.p): r.q for r in got.collect()}
    assert len(found) == len(groups) * len(SHARES)
    for g, values in groups.items():
        assert [found[g, p] for p in SHARES] == pytest.approx(np.quantile(np.array(values, float), SHARES).tolist(), rel=1e-12)
    whole = ranking.exact_quantiles(frame(spark, groups), F.col("x"), SHARES).collect()
    every = np.concatenate([np.array(v, float) for v in groups.values()])
    assert [r.q for r in sorted(whole)] == pytest.approx(np.quantile(every, SHARES).tolist(), rel=1e-12)
    assert ranking.exact_quantiles(frame(spark, {}), F.col("x"), SHARES, ["g"]).count() == 0


@pytest.mark.parametrize("values", ["outlier", "crowded", "even"])
def test_no_range_holds_much_more_than_the_mean(spark, values):
    rng = np.random.default_rng(5)
    x = {"outlier": [*rng.random(20000), 1e12], "crowded": 1 - rng.random(20000) * 1e-5, "even": np.arange(20000)}[values]
    counts = ranking.with_one_group(ranking.value_counts(frame(spark, {"a": x}), F.col("x")))
    sizes = [r["count"] for r in ranking.in_ranges(counts, ["_all"], 64).groupBy("_bucket").count().collect()]
    assert len(sizes) >= 60 and max(sizes) < 4 * sum(sizes) / len(sizes)


def test_ranges_rise_with_the_value(spark):
    counts = ranking.with_one_group(ranking.value_counts(frame(spark, {"a": np.random.default_rng(1).normal(size=5000)}), F.col("x")))
    rows = sorted((r.value, r._bucket) for r in ranking.in_ranges(counts, ["_all"], 128).collect())
    buckets = [b for _, b in rows]
    assert buckets == sorted(buckets) and 0 <= buckets[0] and buckets[-1] < 128


def plain_curve(scores, is_class):
    order = sorted(set(scores), reverse=True)
    p, q = sum(is_class), len(is_class) - sum(is_class)
    points = {(None, 0.0, 0.0)}
    for t in order:
        tp = sum(1 for s, y in zip(scores, is_class, strict=True) if s >= t and y)
        fp = sum(1 for s, y in zip(scores, is_class, strict=True) if s >= t and not y)
        points.add((t, fp / q if q else 0.0, tp / p if p else 0.0))
    return points


def test_curves_of_all_classes(spark):
    rng = np.random.default_rng(9)
    rows = []
    for _ in range(400):
        w = rng.integers(1, 9, 3) / 1e6
        rows.append((int(rng.integers(0, 3)), (1 - w).tolist()))
    frame = spark.createDataFrame(rows, "label int, probability array<double>")
    got = metrics.roc_curves(frame, buckets=16)
    for c in range(3):
        points = {(None if r.threshold == float("inf") else r.threshold, round(r.fpr, 9), round(r.tpr, 9)) for r in got.filter(F.col("class") == c).collect()}
        want = plain_curve([p[c] for _, p in rows], [y == c for y, _ in rows])
        assert points == {(t, round(a, 9), round(b, 9)) for t, a, b in want}
    assert {r["class"] for r in metrics.aucs(frame).collect()} == {0, 1, 2}


def test_histogram_keeps_an_outlier(spark):
    found = profile.histogram(frame(spark, {"a": [*range(1000), 1e12]}), F.col("x"), ["g"], bins=10, clip=None).collect()
    assert sum(r["count"] for r in found) == 1001 and {r.bin for r in found} == {0, 9}
