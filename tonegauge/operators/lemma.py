"""Lemmas of tokens, worked out once per distinct token.

A lexicon has one row per known word: ``form``, ``pos`` ("v" or "n") and ``lemma``. A base form has itself as
lemma, an irregular form has another word. A token's candidates come from the public suffix rules below; a
candidate counts when the lexicon knows it, and the shortest one wins. The verb reading goes first, then the
noun, then the token itself.
"""

import functools

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tonegauge.functions import text as words
from tonegauge.operators.text import salted_lookup
from tonegauge.sources import storage

# Public detachment rules, suffix and replacement per part of speech.
RULES = {
    "v": [("s", ""), ("ies", "y"), ("es", "e"), ("es", ""), ("ed", "e"), ("ed", ""), ("ing", "e"), ("ing", "")],
    "n": [("s", ""), ("ses", "s"), ("ves", "f"), ("xes", "x"), ("zes", "z"), ("ches", "ch"), ("shes", "sh"),
          ("men", "man"), ("ies", "y")],
}

def vocabulary(df: DataFrame, tokens: str) -> DataFrame:
    """Distinct tokens."""
    return df.select(F.explode(F.array_distinct(F.col(tokens))).alias("token")).distinct()


def corpus_lexicon(df: DataFrame, tokens: str) -> DataFrame:
    """The tokens of a corpus as lexicon: every one is a base form in both readings."""
    return own_lexicon(vocabulary(df, tokens))


def own_lexicon(vocab: DataFrame) -> DataFrame:
    """Distinct tokens as lexicon."""
    forms = vocab.withColumn("pos", F.explode(F.array(*[F.lit(p) for p in RULES])))
    return forms.select(F.col("token").alias("form"), "pos", F.col("token").alias("lemma"))


def _rule_ending(token: str) -> Column:
    """Whether a token ends as some rule wants it; only such tokens and irregular forms can change."""
    endings = sorted({old for rules in RULES.values() for old, _ in rules})
    return functools.reduce(Column.__or__, [F.endswith(token, F.lit(e)) for e in endings])


def _detached(form: str, pos: str) -> str:
    """SQL: results of all rules that fit a form, in rule order."""
    rules = ", ".join(f"named_struct('old', '{old}', 'new', '{new}')" for old, new in RULES[pos])
    return (
        f"transform(filter(array({rules}), r -> endswith({form}, r.old) AND length({form}) > length(r.old)), "
        f"r -> concat(substr({form}, 1, length({form}) - length(r.old)), r.new))"
    )


def _first_tries(vocab: DataFrame) -> DataFrame:
    """(token, pos, path, form): the token itself and the results of all rules. ``path`` has the places of the rules used."""
    each = [
        f"transform(concat(array(token), {_detached('token', pos)}), "
        f"(form, i) -> named_struct('pos', '{pos}', 'path', array(i), 'form', form))"
        for pos in RULES
    ]
    return vocab.selectExpr("token", f"inline(concat({', '.join(each)}))")


def _next_tries(tries: DataFrame) -> DataFrame:
    """The rules applied to the forms that are there."""
    each = " ".join(f"WHEN '{pos}' THEN {_detached('form', pos)}" for pos in RULES)
    longer = f"inline(transform(CASE pos {each} END, (f, i) -> named_struct('path', concat(path, array(i)), 'form', f)))"
    return tries.selectExpr("token", "pos", longer).groupBy("token", "pos", "form").agg(F.min("path").alias("path"))


def lemma_table(vocab: DataFrame, lexicon: DataFrame, complete: bool = False) -> DataFrame:
    """token, lemma for the tokens whose lemma differs from the token.

    Rules are applied again to their own results while no candidate is known and any are left; every rule shortens a form,
    so that ends. ``complete``: the lexicon knows every token, so the first round decides them all.
    """
    forms = lexicon.select("form", "pos", "lemma")
    number, found, tries = 0, None, _first_tries(vocab)
    while True:
        # an irregular form replaces all rules: it is the token itself with another lemma
        itself = F.col("path") == F.array(F.lit(0)) if number == 0 else F.lit(False)
        irregular = itself & (F.col("lemma") != F.col("token"))
        hits = tries.join(forms, ["form", "pos"]).filter(irregular | (F.col("form") == F.col("lemma"))).select(
            "token", "pos", "lemma", F.when(irregular, -1).otherwise(number).alias("round"), "path"
        )
        if complete:
            found = hits
            break
        hits = storage.stored(hits, "lemma-hits")
        found = hits if found is None else found.unionByName(hits)
        left = tries.join(hits.select("token", "pos").distinct(), ["token", "pos"], "left_anti")
        # the token itself has been tried with its own rules
        tries = storage.stored(_next_tries(left.filter(~itself)), "lemma-tries")
        number += 1
        if tries.isEmpty():
            break
    rank = F.struct("round", F.length("lemma").alias("length"), "path", "lemma")
    best = found.groupBy("token").agg(*[F.min(F.when(F.col("pos") == pos, rank)).alias(pos) for pos in RULES])
    changed = [F.when(F.col(f"{pos}.lemma") != F.col("token"), F.col(f"{pos}.lemma")) for pos in RULES]
    lemma = F.coalesce(*changed)
    return best.select("token", lemma.alias("lemma")).filter(F.col("lemma").isNotNull())


def lemmatise(df: DataFrame, lemmas: DataFrame, tokens: str = "filtered", out: str = "lemmatized") -> DataFrame:
    """Replaces tokens by their lemma, order and repeats kept; a null array gives an empty one.

    Only distinct tokens that may change travel: they are looked up, gathered per row (a set, at most as many as the row has
    tokens) and put in place inside the row. Where no lemma is irregular, these are the tokens with the ending of a rule, a
    tenth of all. Rows go by a digest of their tokens, so only rows with the same tokens meet.
    """
    rows = df.withColumn("_digest", F.unhex(F.md5(F.array_join(F.col(tokens), "\x01").cast("binary"))))
    distinct = rows.select("_digest", F.explode(F.array_distinct(F.col(tokens))).alias("token"))
    if lemmas.filter(~_rule_ending("token")).isEmpty():
        distinct = distinct.filter(_rule_ending("token"))
    changed = salted_lookup(distinct, lemmas, "token", "_digest")
    per_row = changed.groupBy("_digest").agg(
        F.collect_set(F.struct("token", "lemma")).alias("_changed")
    )
    replaced = f"CASE WHEN _changed IS NULL THEN {tokens} ELSE {_replaced(tokens, '_changed')} END"
    joined = rows.join(per_row, "_digest", "left")
    return joined.withColumn(out, F.expr(f"coalesce({replaced}, array())")).drop("_changed", "_digest")


def _replaced(tokens: str, changed: str) -> str:
    """SQL: tokens with those listed in ``changed`` replaced.

    A map is searched from its start, so the changes are spread over about sqrt(n) small maps.
    """
    parts = f"CAST(ceil(sqrt(size({changed}))) AS INT)"
    maps = (
        f"transform(sequence(0, {parts} - 1), part -> "
        f"map_from_entries(filter({changed}, e -> pmod(xxhash64(e.token), {parts}) = part)))"
    )
    lookup = "try_element_at(get(maps, CAST(pmod(xxhash64(t), size(maps)) AS INT)), t)"
    # transform over one element binds the maps to a name, so they are built once per row and not per token
    return f"get(transform(array({maps}), maps -> transform({tokens}, t -> coalesce({lookup}, t))), 0)"


def lemmatised_tokens(df: DataFrame, lexicon: DataFrame | None = None, text: str = "Text") -> DataFrame:
    """Adds words, filtered and lemmatized. Without a lexicon the corpus itself is one."""
    found = df.withColumn("words", words.word_tokens(F.col(text))).withColumn(
        "filtered", words.without_words(F.col("words"), words.english_stop_words())
    )
    return lemmatise(found, corpus_lemmas(found) if lexicon is None else lemmas_of(found, lexicon))


def corpus_lemmas(df: DataFrame, tokens: str = "filtered") -> DataFrame:
    vocab = storage.stored(vocabulary(df, tokens), "vocabulary")
    return storage.stored(lemma_table(vocab, own_lexicon(vocab), complete=True), "lemmas")


def lemmas_of(df: DataFrame, lexicon: DataFrame, tokens: str = "filtered") -> DataFrame:
    """The lemmas of a frame's tokens. Where no form of the lexicon is irregular, a token can only change by a rule, so those
    without the ending of a rule, nine tenths of all, are left out before the vocabulary is made."""
    found = df.select(F.explode(F.array_distinct(F.col(tokens))).alias("token"))
    if lexicon.filter(F.col("form") != F.col("lemma")).isEmpty():
        found = found.filter(_rule_ending("token"))
    # every round of candidates reads the vocabulary
    return lemma_table(storage.stored(found.distinct(), "vocabulary"), lexicon)
