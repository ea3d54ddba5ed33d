"""Tokens are worked out once for a fit, and vectors are counted by their stored values."""

import shutil

from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from tonegauge.operators import features, lemma
from tonegauge.plans import streams
from tonegauge.sources import views


def test_saved_model_works_out_tokens_once_a_fit_and_once_a_scoring(spark, folder, monkeypatch):
    seen, real = [], features._tokens
    monkeypatch.setattr(features, "_tokens", lambda *args: seen.append(1) or real(*args))
    row = streams.s12_saved_model(spark, folder).first()
    assert row.scored == row.same > 0 and len(seen) == 3


def test_fit_on_all_rows_without_a_split(spark):
    rows = spark.createDataFrame([(str(k % 3), "cats and dogs ran" if k % 2 else "dogs sleep") for k in range(8)], "Id string, Text string")
    _, wide = features.fit_and_transform(rows, features.FeatureSettings(num_features=64), train=F.lit(True))
    apart = features.fit_features(rows, features.FeatureSettings(num_features=64)).transform(rows)
    assert sorted(map(str, wide.select("Id", "features").collect())) == sorted(map(str, apart.select("Id", "features").collect()))


def test_nonzero_values_of_sparse_and_dense_vectors(spark):
    rows = [(Vectors.sparse(9, [1, 4], [2.0, 0.0]),), (Vectors.dense([0.0, 1.0, 2.0]),), (Vectors.sparse(9, [], []),)]
    frame = features.nonzero_summary(spark.createDataFrame(rows, ["features"]))
    assert tuple(frame.first()) == (0, 1.0, 2)
    plan = frame._jdf.queryExecution().optimizedPlan().toString()
    assert "UDF" not in plan


def test_token_counts_are_written_and_not_tokens(spark, monkeypatch):
    written, real = [], features.storage.stored
    monkeypatch.setattr(features.storage, "stored", lambda df, purpose: written.append(df.columns) or real(df, purpose))
    rows = spark.createDataFrame([("1", "cats ran", "train"), ("2", "dogs", "test")], "Id string, Text string, split string")
    _, wide = features.fit_and_transform(rows, features.FeatureSettings(num_features=64, min_doc_freq=1))
    assert wide.columns == ["Id", "Text", "split", "features"] and wide.count() == 2
    assert ["Id", "Text", "split", "raw_features"] in written and not any("tokens" in columns for columns in written)


def test_stream_of_a_table_that_is_a_folder_of_files(spark, tmp_path):
    rows = spark.range(20).selectExpr("id AS doc_id", "concat('text ', id) AS text")
    rows.repartition(3).write.parquet(str(tmp_path / "many" / "documents.parquet"))
    rows.repartition(1).write.parquet(str(tmp_path / "parts"))
    (tmp_path / "one").mkdir()
    shutil.copy(next((tmp_path / "parts").glob("part-*.parquet")), tmp_path / "one" / "documents.parquet")
    for folder in ("many", "one"):
        stream = streams._finished(views.table_stream(spark, str(tmp_path / folder), "documents"), "streamed")
        assert sorted(r.doc_id for r in stream.collect()) == list(range(20))


def test_vocabulary_for_lemmas_has_only_tokens_that_a_rule_can_change(spark, monkeypatch):
    seen, real = [], lemma.lemma_table
    monkeypatch.setattr(lemma, "lemma_table", lambda vocab, *args: seen.append(vocab) or real(vocab, *args))
    df = spark.createDataFrame([(["cats", "cat", "walked", "walk", "ran"],), ([],), (None,)], "filtered array<string>")
    found = lemma.lemmas_of(df, lemma.corpus_lexicon(df, "filtered"))
    assert sorted(map(tuple, found.collect())) == [("cats", "cat"), ("walked", "walk")]
    assert sorted(r.token for r in seen[0].collect()) == ["cats", "walked"]
    irregular = spark.createDataFrame([("ran", "v", "run"), ("cat", "n", "cat")], "form string, pos string, lemma string")
    assert sorted(map(tuple, lemma.lemmas_of(df, irregular).collect())) == [("cats", "cat"), ("ran", "run")]
