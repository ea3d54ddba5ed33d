"""Explicit schemas; nothing in the library infers types from data."""

from pyspark.sql import types as T

REVIEW_COLUMNS = [
    "Id", "ProductId", "UserId", "ProfileName", "HelpfulnessNumerator",
    "HelpfulnessDenominator", "Score", "Time", "Summary", "Text",
]

# Text form of a review: CSV files and topic messages carry strings only.
MESSAGE = T.StructType([T.StructField(c, T.StringType()) for c in REVIEW_COLUMNS])

# A stored prediction: message fields are kept as they came.
PREDICTION = (
    "Id string, ProductId string, UserId string, ProfileName string, Score string, Time string, ProcessingTime string, "
    "Summary string, Text string, prediction double, PredictedSentiment string, max_prob double"
)

MONTHLY = "year int, month int, sentiment string, count bigint"

REVIEW_TYPES = {
    "Id": "string",
    "ProductId": "string",
    "UserId": "string",
    "ProfileName": "string",
    "HelpfulnessNumerator": "int",
    "HelpfulnessDenominator": "int",
    "Score": "double",
    "Time": "bigint",
    "Summary": "string",
    "Text": "string",
}

INSIGHT = """
    evaluated_at string,
    model_name string,
    model_version string,
    trained_at string,
    dataset string,
    notes string,
    parameters map<string,string>,
    metadata struct<model_name:string, model_version:string, trained_at:string,
                    dataset:string, notes:string, parameters:map<string,string>>,
    metrics struct<accuracy:double, f1_weighted:double, precision_weighted:double,
                   recall_weighted:double,
                   per_class:map<string, struct<precision:double, recall:double, f1:double>>>,
    confusion_matrix struct<labels:array<string>, matrix:array<array<bigint>>>
"""
