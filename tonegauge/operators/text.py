"""Token columns, word counts and TF-IDF keyed by the token itself."""

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tonegauge.functions import text as words
from tonegauge.sources import storage

# Copies of a small token table in a join with token occurrences. A token that fills a third of the
# occurrences is spread over this many tasks.
SALTS = 16

# A token with more than this part of all occurrences is frequent; there are fewer such tokens than this number.
FREQUENT = 10_000


def tokenise(df: DataFrame, column: str = "Text", out: str = "words", unicode: bool = False) -> DataFrame:
    return df.withColumn(out, words.word_tokens(F.col(column), unicode=unicode))


def remove_stopwords(
    df: DataFrame, column: str = "words", out: str = "filtered", keep: Iterable[str] = words.NEGATIONS
) -> DataFrame:
    """English stop words removed, except the kept ones (by default the negations)."""
    return df.withColumn(out, words.without_words(F.col(column), words.english_stop_words(keep)))


def add_bigrams(df: DataFrame, column: str = "lemmatized", out: str = "bigrams") -> DataFrame:
    return df.withColumn(out, words.bigrams(F.col(column)))


def combine(df: DataFrame, first: str = "lemmatized", second: str = "bigrams", out: str = "tokens") -> DataFrame:
    return df.withColumn(out, words.combined(F.col(first), F.col(second)))


def occurrences(df: DataFrame, tokens: str, key: str = "Id") -> DataFrame:
    """Distinct tokens of each row with their number, as key, token, tf. Rows are counted apart, whatever their keys.

    All tokens of a row are sorted inside the row, and a run of equal ones is one token: nothing is shuffled.
    """
    ranked = df.select(key, F.sort_array(F.coalesce(F.col(tokens), F.array().cast("array<string>"))).alias("_sorted"))
    n = F.size("_sorted")
    every = F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))
    fresh = lambda i: (i == 0) | (F.get("_sorted", i) != F.get("_sorted", F.greatest(i - 1, F.lit(0))))
    starts = ranked.withColumn("_starts", F.filter(every, fresh))
    counted = F.transform("_starts", lambda i, k: F.struct(
        F.get("_sorted", i).alias("token"), (F.coalesce(F.get("_starts", k + 1), n) - i).cast("bigint").alias("tf")
    ))
    return starts.select(key, F.inline(counted))


def salted_lookup(rows: DataFrame, small: DataFrame, on: str, salt_by: str, how: str = "inner") -> DataFrame:
    """Join with a table that has one row per ``on``, its rows copied so that a hot value is spread out.

    Nothing is broadcast by hand: the engine does it at run time when the small side really is small.
    """
    salted = rows.withColumn("_salt", F.pmod(F.xxhash64(salt_by), F.lit(SALTS)))
    copies = small.withColumn("_salt", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(SALTS - 1).cast("bigint"))))
    return salted.join(copies, [on, "_salt"], how).drop("_salt")


def counted_lookup(rows: DataFrame, small: DataFrame, on: str, count: str, frequent: int = FREQUENT) -> DataFrame:
    """Inner join with a table that has one row per ``on`` and the number of its rows in ``rows``, so both should be stored.

    Values with more than 1/``frequent`` of all rows are fewer than ``frequent``, whatever the table's size: they go to
    every task and their rows stay where they are. The other rows are shuffled, and none of their values fills a task.
    """
    totalled = small.withColumn("_total", small.agg(F.sum(count)).scalar())
    heavy = F.col(count) * frequent > F.col("_total")
    many = F.broadcast(totalled.filter(heavy).drop("_total"))
    few = totalled.filter(~heavy).drop("_total")
    rest = rows.join(F.broadcast(many.select(on)), on, "left_anti")
    return rows.join(many, on).unionByName(rest.join(few, on))


def document_frequency(counts: DataFrame) -> DataFrame:
    """Rows per token."""
    return counts.groupBy("token").agg(F.count(F.lit(1)).alias("df"))


def _weighted(seen: DataFrame, df: DataFrame, minimum: int) -> DataFrame:
    documents = df.agg(F.count(F.lit(1)).cast("double")).scalar()
    weight = F.log((documents + 1) / (F.col("df") + 1))
    return seen.select("token", "df", F.when(F.col("df") >= minimum, weight).otherwise(F.lit(0.0)).alias("idf"))


def idf(df: DataFrame, tokens: str, key: str = "Id", minimum: int = 3) -> DataFrame:
    """Inverse document frequency ``ln((m + 1) / (df + 1))`` per token, 0 below ``minimum`` documents."""
    each = df.select(F.explode(F.array_distinct(F.col(tokens))).alias("token"))
    return _weighted(document_frequency(each), df, minimum)


def tf_idf(df: DataFrame, tokens: str, key: str = "Id", minimum: int = 3) -> DataFrame:
    """key, token, tf, tfidf for every distinct token of every row.

    The tokens are worked out once and written as occurrences; document frequencies and weights both read them.
    """
    counted = storage.stored(occurrences(df, tokens, key), "occurrences")
    weights = storage.stored(_weighted(document_frequency(counted), df, minimum), "frequencies")
    joined = counted_lookup(counted, weights, "token", "df")
    return joined.select(key, "token", "tf", (F.col("tf") * F.col("idf")).alias("tfidf"))


def sparsity(df: DataFrame, tokens: str) -> DataFrame:
    """Smallest, mean and largest number of distinct tokens per row."""
    n = F.size(F.array_distinct(F.col(tokens)))
    return df.agg(F.min(n).alias("min"), F.avg(n).alias("mean"), F.max(n).alias("max"))


def top_words(df: DataFrame, n: int = 15, by: str = "Sentiment", stop_words=words.REPORT_STOP_WORDS) -> DataFrame:
    """The most frequent words per class over the whole table, ties in alphabetical order."""
    from pyspark.sql import Window as W

    kept = words.without_words(words.letter_words(F.col("Text")), stop_words)
    each = df.select(by, F.explode(kept).alias("word"))
    counts = each.groupBy(by, "word").agg(F.count(F.lit(1)).alias("count"))
    # the rank filter is pushed below the shuffle, so each task sends at most n words per class
    order = W.partitionBy(by).orderBy(F.desc("count"), F.asc("word"))
    return counts.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= n)


def word_frequencies(df: DataFrame, score: int, n: int = 100, stop_words=words.REPORT_STOP_WORDS) -> DataFrame:
    """The ``n`` most frequent words of the reviews with one score."""
    kept = words.without_words(words.letter_words(F.col("Text")), stop_words)
    each = df.filter(F.col("Score") == score).select(F.explode(kept).alias("word"))
    counts = each.groupBy("word").agg(F.count(F.lit(1)).alias("count"))
    return counts.orderBy(F.desc("count"), F.asc("word")).limit(n)


def token_reduction(df: DataFrame, column: str = "Text", key: str = "Id") -> DataFrame:
    """Tokens of the normalised text before and after the plain English stop words."""
    found = words.split_tokens(words.normalise(F.col(column)))
    kept = words.without_words(found, words.english_stop_words(keep=()))
    return df.select(key, F.size(found).alias("token_count"), F.size(kept).alias("filtered_count"))
