"""The text feature model: tokens, lemmas, bigrams, hashed term frequencies and document frequencies.

One object holds every fitted part and its settings, so training and scoring cannot drift apart.
"""

from dataclasses import asdict, dataclass

from pyspark.ml.feature import IDF, HashingTF, IDFModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tonegauge.functions import text as words
from tonegauge.operators import lemma
from tonegauge.sources import storage


@dataclass
class FeatureSettings:
    # Size of the hash space and smallest document frequency.
    num_features: int = 100_000
    min_doc_freq: int = 3
    summary_times: int = 2
    lemmas: bool = True
    bigrams: bool = True
    unicode: bool = False


@dataclass
class FeatureModel:
    """Fitted features. ``lexicon`` is None when lemmas are off; ``weights`` is None for plain term counts."""

    settings: FeatureSettings
    lexicon: DataFrame | None
    hashing: HashingTF
    weights: IDFModel | None

    def tokens(self, df: DataFrame, key: str = "Id") -> DataFrame:
        return _tokens(df, self.settings, self.lexicon, key)

    def transform(self, df: DataFrame, key: str = "Id") -> DataFrame:
        """Adds ``features``."""
        counted = self.hashing.transform(self.tokens(df, key))
        if self.weights is None:
            return counted.withColumnRenamed("raw_features", "features").drop("tokens")
        return self.weights.transform(counted).drop("tokens", "raw_features")

    def save(self, spark: SparkSession, path: str) -> None:
        storage.save_json(spark, asdict(self.settings), f"{path}/settings")
        if self.lexicon is not None:
            self.lexicon.write.mode("overwrite").parquet(f"{path}/lexicon")
        self.hashing.write().overwrite().save(f"{path}/hashing")
        if self.weights is not None:
            self.weights.write().overwrite().save(f"{path}/weights")

    @classmethod
    def load(cls, spark: SparkSession, path: str, with_weights: bool = True) -> "FeatureModel":
        settings = FeatureSettings(**storage.load_json(spark, f"{path}/settings"))
        return cls(
            settings,
            spark.read.parquet(f"{path}/lexicon") if settings.lemmas else None,
            HashingTF.load(f"{path}/hashing"),
            IDFModel.load(f"{path}/weights") if with_weights else None,
        )


def _words(df: DataFrame, settings: FeatureSettings) -> Column:
    """Filtered words of the summary, repeated, and the text."""
    parts = [F.col("Text")]
    if "Summary" in df.columns:
        parts = [F.coalesce(F.col("Summary").cast("string"), F.lit(""))] * settings.summary_times + parts
    found = words.word_tokens(F.concat_ws(" ", *parts), unicode=settings.unicode)
    return words.without_words(found, words.english_stop_words())


def _tokens(df: DataFrame, settings: FeatureSettings, lexicon: DataFrame | None, key: str) -> DataFrame:
    """Adds ``tokens`` and takes nothing away. Rows may share a key or have none."""
    rows = df.withColumn("_words", _words(df, settings))
    if lexicon is None:
        rows = rows.withColumnRenamed("_words", "_lemmas")
    else:
        lemmas = lemma.lemmas_of(rows, lexicon, "_words")
        rows = lemma.lemmatise(rows, lemmas, "_words", "_lemmas").drop("_words")
    tokens = F.col("_lemmas")
    if settings.bigrams:
        rows = rows.withColumn("_pairs", words.bigrams(tokens))
        return rows.withColumn("tokens", words.combined(tokens, F.col("_pairs"))).drop("_lemmas", "_pairs")
    return rows.withColumnRenamed("_lemmas", "tokens")


def _unweighted(train: DataFrame, settings: FeatureSettings | None, lexicon: DataFrame | None) -> FeatureModel:
    settings = settings or FeatureSettings()
    if settings.lemmas and lexicon is None:
        own = lemma.corpus_lexicon(train.select(_words(train, settings).alias("words")), "words")
        lexicon = storage.stored(own, "lexicon")
    hashing = HashingTF(inputCol="tokens", outputCol="raw_features", numFeatures=settings.num_features)
    return FeatureModel(settings, lexicon if settings.lemmas else None, hashing, None)


def _fit_weights(model: FeatureModel, counted: DataFrame) -> None:
    stage = IDF(inputCol="raw_features", outputCol="features", minDocFreq=model.settings.min_doc_freq)
    model.weights = stage.fit(counted.select("raw_features"))


def fit_features(
    train: DataFrame, settings: FeatureSettings | None = None, lexicon: DataFrame | None = None, key: str = "Id",
    idf: bool = True,
) -> FeatureModel:
    """Fits on the training rows only. Without a lexicon the words of the training rows are one."""
    model = _unweighted(train, settings, lexicon)
    if idf:
        _fit_weights(model, model.hashing.transform(model.tokens(train, key)))
    return model


def fit_and_transform(
    rows: DataFrame, settings: FeatureSettings | None = None, lexicon: DataFrame | None = None, key: str = "Id",
    train: Column | None = None,
) -> tuple[FeatureModel, DataFrame]:
    """Fits on the rows of ``train``, by default those whose ``split`` is train, and gives the features of all rows.

    The tokens of every row are counted once and the counts written; the fit and the features both read them.
    """
    train = F.col("split") == "train" if train is None else train
    model = _unweighted(rows.filter(train), settings, lexicon)
    counted = storage.stored(model.hashing.transform(model.tokens(rows, key)).drop("tokens"), "counts")
    _fit_weights(model, counted.filter(train))
    return model, model.weights.transform(counted).drop("raw_features")


def nonzero_summary(features: DataFrame) -> DataFrame:
    """Smallest, mean and largest number of non-zero features."""
    # the stored form of a sparse vector has its values only: no row grows to the whole hash space
    n = F.size(F.filter(F.unwrap_udt("features")["values"], lambda x: x != 0))
    return features.agg(F.min(n).alias("min"), F.avg(n).alias("mean"), F.max(n).alias("max"))
