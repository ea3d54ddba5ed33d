"""A corpus pipeline from five operators. Every stage reads what the stage before it wrote."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tonegauge.llm import packing, quality, secret_scan, simhash, suffix_dedup
from tonegauge.llm.queries import table, tokenizer
from tonegauge.llm.store import stored


def on_other_names(docs: DataFrame, step: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """The columns of ``docs`` after a step that sees all but the text under names of no operator's own."""
    names = {c: c if c == "text" else f"c{k}_" for k, c in enumerate(docs.columns)}
    done = step(docs.select(*[F.col(c).alias(n) for c, n in names.items()]))
    return done.select(*[F.col(n).alias(c) for c, n in names.items()])


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no quality rule rejects."""
    return on_other_names(docs, quality.passing)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near copies: the one with the group's smallest id (rows without an id come last)."""
    # ids can repeat or be missing, so groups and removal go by row; the numbers are written, as no second reading need give them again
    row = max(docs.columns, key=len) + "_"
    rows = stored(docs.withColumn(row, F.monotonically_increasing_id()))
    groups = simhash.near_duplicates(rows.select(row, "doc_id", "text"), id=row)
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", F.col(row).alias("row")))
    kept = groups.groupBy("component_id").agg(first.alias("first")).select(F.col("first.row").alias(row))
    return rows.join(kept, row, "left_semi").select(*docs.columns)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the bytes that repeated strings cover, of 400 bytes or of over 50 words. What a cut leaves of a split
    character goes too."""

    def cut(rows: DataFrame) -> DataFrame:
        return suffix_dedup.remove_repeats(rows, words=51).withColumn("text", suffix_dedup.readable("rest"))

    return measured(on_other_names(docs, cut))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with a mark in place of each secret."""
    return measured(on_other_names(docs, lambda rows: secret_scan.scan(rows).withColumnRenamed("redacted", "text")))


def measured(docs: DataFrame) -> DataFrame:
    """``docs`` with a length that fits the text."""
    return docs.withColumn("n_chars", F.char_length("text").cast("bigint")) if "n_chars" in docs.columns else docs


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents and their places in sequences."""
    return packing.pack(docs.select("doc_id", "text"), tokenizer("byte_bpe_50k.json"), with_ids=False)


STAGES = [
    ("quality rules", quality_rules),
    ("SimHash near-dedup", near_copies),
    ("suffix-array dedup", repeated_passages),
    ("secret scans", secrets),
    ("best-fit packing", packed),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``; each stage's rows are written and read again."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)


#: Fingerprints, suffix repeats, secrets with checksums and token ids are beyond SQL; tests compare with brute force.
ORACLE_SQL = None
