"""Jobs for spark-submit: each is a thin main over the operators.

    spark-submit --py-files tonegauge.zip tonegauge/jobs/preprocess.py --input REVIEWS_CSV --output FOLDER
"""

from pyspark.sql import SparkSession


def session(name: str) -> SparkSession:
    """A session with the settings of the submit command and nothing else."""
    return SparkSession.builder.appName(name).getOrCreate()
