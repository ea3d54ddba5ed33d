"""Reviews to splits, features and a fitted feature model."""

import argparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tonegauge.jobs import session
from tonegauge.operators import cleaning, features, splits
from tonegauge.sources import reviews, storage

KEPT = ["Id", "ProductId", "UserId", "Score", "Time", "Sentiment", "label", "classWeight", "split", "features"]


def run(
    spark: SparkSession, source: str, output: str, settings: features.FeatureSettings | None = None,
    lexicon: DataFrame | None = None, balanced: bool = False, cleaned: bool = True, seed: int = 42,
) -> None:
    rows = reviews.read_reviews(spark, source)
    rows = cleaning.clean(rows) if cleaned else cleaning.fill_summary(cleaning.drop_empty_text(rows))
    # the split is written once; fitting and featurising read it back
    storage.save_features(splits.stratified_split(cleaning.labelled(rows), seed=seed), f"{output}/rows")
    rows = storage.load_features(spark, f"{output}/rows")
    storage.save_splits(rows, f"{output}/splits")
    train = rows.filter(F.col("split") == "train")
    weighted = cleaning.balanced_weights(rows, by=train) if balanced else cleaning.fixed_weights(rows)
    model, wide = features.fit_and_transform(weighted, settings, lexicon)
    model.save(spark, f"{output}/model/features")
    wide.select(*KEPT).write.mode("overwrite").partitionBy("split").parquet(f"{output}/features")


def main(argv=None) -> None:
    args = argparse.ArgumentParser(description=__doc__)
    args.add_argument("--input", required=True)
    args.add_argument("--output", required=True)
    args.add_argument("--num-features", type=int, default=features.FeatureSettings.num_features)
    args.add_argument("--lexicon", help="Parquet folder with form, pos, lemma")
    args.add_argument("--balanced", action="store_true", help="inverse-frequency weights in place of the fixed ones")
    found = args.parse_args(argv)
    spark = session("preprocess reviews")
    lexicon = spark.read.parquet(found.lexicon) if found.lexicon else None
    settings = features.FeatureSettings(num_features=found.num_features)
    run(spark, found.input, found.output, settings, lexicon, found.balanced)


if __name__ == "__main__":
    main()
