"""The trainer's blocks outweigh the arrays that each of them costs."""

from tonegauge.operators import models


def test_blocks_are_larger_than_the_arrays_they_cost(spark):
    df = spark.createDataFrame([(0.0,)], ["label"])
    assert models.logistic_regression(df).getMaxBlockSizeInMB() * 1e6 > 5 * 3 * 100_000 * 8
