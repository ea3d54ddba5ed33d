"""Tokens that no rule can change stay with their row, unless a lexicon has irregular forms."""

from pyspark.sql import functions as F

from tonegauge.operators import lemma


def _looked_up(monkeypatch):
    seen, real = [], lemma.salted_lookup
    monkeypatch.setattr(lemma, "salted_lookup", lambda rows, *args: seen.append(rows) or real(rows, *args))
    return seen


def _rows(spark):
    rows = [("1", ["cats", "run", "cats", "walked"]), ("2", ["ran", "cat", "walk"]), ("2", []), (None, None)]
    return spark.createDataFrame(rows, "Id string, filtered array<string>")


def test_only_tokens_with_the_ending_of_a_rule_travel(spark, monkeypatch):
    seen, df = _looked_up(monkeypatch), _rows(spark)
    out = lemma.lemmatise(df, lemma.corpus_lemmas(df))
    assert sorted(map(str, out.select("Id", "lemmatized").collect())) == sorted(map(str, [
        spark.createDataFrame([r], "Id string, lemmatized array<string>").first()
        for r in [("1", ["cat", "run", "cat", "walk"]), ("2", ["ran", "cat", "walk"]), ("2", []), (None, [])]]))
    assert sorted(r.token for r in seen[0].collect()) == ["cats", "walked"]


def test_irregular_forms_are_looked_up_whatever_their_ending(spark, monkeypatch):
    seen, df = _looked_up(monkeypatch), _rows(spark)
    lexicon = spark.createDataFrame(
        [("ran", "v", "run"), ("run", "v", "run"), ("cat", "n", "cat"), ("walk", "v", "walk")], "form string, pos string, lemma string")
    out = lemma.lemmatise(df, lemma.lemmas_of(df, lexicon)).filter(F.size("lemmatized") > 0).orderBy("Id")
    assert [r.lemmatized for r in out.collect()] == [["cat", "run", "cat", "walk"], ["run", "cat", "walk"]]
    assert {r.token for r in seen[0].collect()} == {"cats", "run", "walked", "ran", "cat", "walk"}
