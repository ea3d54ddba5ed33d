"""Token and word queries over the documents."""

from pyspark.sql import functions as F

from tonegauge.functions import text as words
from tonegauge.operators import cleaning, lemma
from tonegauge.operators import text as ops
from tonegauge.plans import views_sql as v
from tonegauge.sources import views


def _joined(df, *columns):
    return df.select("Id", *[F.array_join(c, "|").alias(c) for c in columns])


def _filtered(spark, folder):
    return ops.remove_stopwords(ops.tokenise(views.doc_texts(spark, folder)))


def t1_tokens(spark, folder):
    return _joined(ops.tokenise(views.doc_texts(spark, folder)), "words")


def t1_split_tokens(spark, folder):
    texts = views.doc_texts(spark, folder)
    return _joined(texts.withColumn("words", words.split_tokens(F.col("Text"))), "words")


def t1_unicode_tokens(spark, folder):
    return _joined(ops.tokenise(views.doc_texts(spark, folder), unicode=True), "words")


def t2_stopwords(spark, folder):
    plain = ops.remove_stopwords(_filtered(spark, folder), out="plain", keep=())
    return _joined(plain, "filtered", "plain")


def t3_lemmas(spark, folder):
    return _joined(lemma.lemmatised_tokens(views.doc_texts(spark, folder)), "lemmatized")


def t3_lemma_table(spark, folder):
    return lemma.corpus_lemmas(_filtered(spark, folder))


def t4_bigrams(spark, folder):
    return _joined(ops.add_bigrams(_filtered(spark, folder), "filtered"), "bigrams")


def t5_combined(spark, folder):
    pairs = ops.add_bigrams(_filtered(spark, folder), "filtered")
    return _joined(ops.combine(pairs, "filtered"), "tokens")


def t7_idf(spark, folder):
    rows = ops.idf(_filtered(spark, folder), "filtered")
    return rows.select("token", "df", F.round("idf", 6).alias("idf"))


def t7_tf_idf(spark, folder):
    rows = ops.tf_idf(_filtered(spark, folder), "filtered")
    return rows.select("Id", "token", F.col("tf").cast("bigint").alias("tf"), F.round("tfidf", 6).alias("tfidf"))


def t9_sparsity(spark, folder):
    return ops.sparsity(_filtered(spark, folder), "filtered").select(
        "min", F.round("mean", 6).alias("mean"), "max"
    )


def t11_top_words(spark, folder):
    return ops.top_words(cleaning.with_sentiment(views.doc_reviews(spark, folder)))


def t12_word_frequencies(spark, folder):
    return ops.word_frequencies(views.doc_reviews(spark, folder), 5)


def t13_token_reduction(spark, folder):
    return ops.token_reduction(views.doc_texts(spark, folder))


QUERIES = {
    name: run for name, run in globals().items()
    if callable(run) and name[0] == "t" and name[1:2].isdigit()
}


def _quoted(names):
    return ", ".join("'" + w.replace("'", "''") + "'" for w in names)


# The English stop words of the tokeniser in use, without those with an apostrophe, which no
# token can contain.
STOP_WORDS = (
    "i me my myself we our ours ourselves you your yours yourself yourselves he him his himself she her hers "
    "herself it its itself they them their theirs themselves what which who whom this that these those am is are "
    "was were be been being have has had having do does did doing a an the and but if or because as until while of "
    "at by for with about against between into through during before after above below to from up down in out on "
    "off over under again further then once here there when where why how all any both each few more most other "
    "some such no nor not only own same so than too very s t can will just don should now cannot could ought would"
).split()
_KEPT = _quoted(w for w in STOP_WORDS if w not in words.NEGATIONS)


def tokens_of(rows, columns):
    """SQL: tables ``tokens`` and ``filtered`` of a table with a text."""
    return rf"""tokens AS (SELECT {columns}, text,
  [x FOR x IN regexp_extract_all(lower(text), '[0-9A-Za-z_]+') IF length(x) >= 2] AS words FROM {rows}),
filtered AS (SELECT *, [x FOR x IN words IF x NOT IN ({_KEPT})] AS filtered FROM tokens)"""


TOKENS = tokens_of("documents", "CAST(doc_id AS VARCHAR) AS Id")
_PAIRS = """[filtered[i] || ' ' || filtered[i + 1] FOR i IN range(1, len(filtered))]"""
_OCCURRENCES = """occ AS (SELECT Id, token, count(*) AS tf FROM (SELECT Id, unnest(filtered) AS token FROM filtered)
  GROUP BY ALL),
  idf AS (SELECT token, count(*) AS df, CASE WHEN count(*) >= 3
    THEN ln(((SELECT count(*) FROM documents) + 1.0) / (count(*) + 1)) ELSE 0.0 END AS idf FROM occ GROUP BY token)"""


def _rule_rows():
    return ", ".join(f"('{pos}', '{old}', '{new}')" for pos, rules in lemma.RULES.items() for old, new in rules)


# every token of the corpus is a base form, so one round of rules decides
VOCABULARY = "vocab AS (SELECT DISTINCT unnest(filtered) AS token FROM filtered)"
_LEMMAS = f"""{VOCABULARY},
rules(pos, old, new) AS (VALUES {_rule_rows()}),
tries AS (
  SELECT v.token, pos, substr(v.token, 1, length(v.token) - length(old)) || new AS form
  FROM vocab v JOIN rules ON ends_with(v.token, old) AND length(v.token) > length(old)),
best AS (
  SELECT t.token, pos, min_by(form, (length(form), form)) AS form
  FROM tries t JOIN vocab k ON k.token = t.form WHERE length(form) < length(t.token) GROUP BY 1, 2),
lemmas AS (
  SELECT token, coalesce(max(form) FILTER (pos = 'v'), max(form) FILTER (pos = 'n')) AS lemma
  FROM best GROUP BY token)"""


def lemma_rounds(vocab, lexicon):
    """SQL: table ``lemmas`` for the tokens of ``vocab``; ``lexicon`` has the known forms (both with a column token).

    The lexicon need not know every token: rules go on with their own results, and the earliest round that knows one decides.
    """
    rules = ", ".join(
        f"('{pos}', {i}, '{old}', '{new}')" for pos, listed in lemma.RULES.items() for i, (old, new) in enumerate(listed, 1))
    return f"""rules(pos, place, old, new) AS (VALUES {rules}),
tries AS (
  SELECT token, pos, token AS form, 0 AS round, [0] AS path FROM {vocab}, (VALUES ('v'), ('n')) AS p(pos)
  UNION ALL
  SELECT token, t.pos, substr(form, 1, length(form) - length(old)) || new, round + 1,
    CASE WHEN round = 0 THEN [place] ELSE list_concat(path, [place]) END
  FROM tries t JOIN rules r ON r.pos = t.pos AND ends_with(form, old) AND length(form) > length(old)),
best AS (
  SELECT t.token, pos, min_by(form, (greatest(round, 1), length(form), path)) AS form
  FROM tries t JOIN {lexicon} k ON k.token = t.form GROUP BY 1, 2),
lemmas AS (
  SELECT token, coalesce(max(form) FILTER (pos = 'v' AND form <> token), max(form) FILTER (pos = 'n' AND form <> token)) AS lemma
  FROM best GROUP BY token)"""


def hashed(tokens, buckets):
    """SQL: table ``places`` (token, feature), the bucket of every token by the 32-bit Murmur3 hash with seed 42.

    Tokens are plain ASCII, so a character is a byte.
    """
    m = "4294967296::UBIGINT"
    word = " + ".join(f"b[4 * i + {j + 1}] * {256 ** j}" for j in range(4))
    rest = " + ".join(f"coalesce(b[4 * (n // 4) + {j + 1}], 0) * {256 ** j}" for j in range(3))

    def times(x, factor):
        return f"(({x}) * {factor}::UBIGINT) % {m}"

    def turned(x, left):
        return f"(((({x}) << {left}) | (({x}) >> {32 - left})) % {m})"

    def mixed(x):
        return times(turned(times(x, 3432918353), 15), 461845907)

    return f"""bytes AS (SELECT token, length(token) AS n, [unicode(token[i])::UBIGINT FOR i IN range(1, length(token) + 1)] AS b
  FROM (SELECT DISTINCT token FROM {tokens})),
blocks AS (SELECT token, n, [{mixed('x')} FOR x IN [{word} FOR i IN range(0, n // 4)]] AS ks, {mixed(f'({rest})::UBIGINT')} AS k FROM bytes),
h0 AS (SELECT token, n, xor(list_reduce(ks, lambda h, x: ({turned('xor(h, x)', 13)} * 5 + 3864292196::UBIGINT) % {m}, 42::UBIGINT), k) AS h
  FROM blocks),
h1 AS (SELECT token, xor(h, n::UBIGINT) AS h FROM h0),
h2 AS (SELECT token, {times('xor(h, h >> 16)', 2246822507)} AS h FROM h1),
h3 AS (SELECT token, {times('xor(h, h >> 13)', 3266489909)} AS h FROM h2),
h4 AS (SELECT token, xor(h, h >> 16)::BIGINT AS h FROM h3),
places AS (SELECT token, CAST(((CASE WHEN h >= 2147483648 THEN h - 4294967296 ELSE h END) % {buckets} + {buckets}) % {buckets} AS INT)
  AS feature FROM h4)"""


def lemmatised(rows):
    """SQL: table ``lemma_rows`` with the lemmas of the tokens in ``filtered`` of ``rows`` and ``grams`` with those and their pairs."""
    return f"""each AS (SELECT Id, unnest(filtered) AS token, generate_subscripts(filtered, 1) AS pos FROM {rows}),
lemma_rows AS (SELECT Id, list(coalesce(lemma, token) ORDER BY pos) AS filtered FROM each LEFT JOIN lemmas USING (token) GROUP BY Id),
grams AS (SELECT Id, unnest(list_concat(filtered, {_PAIRS})) AS token FROM lemma_rows)"""


def _report_words(text):
    return (
        f"[x FOR x IN regexp_extract_all(lower({text}), '[a-z]{{3,}}') "
        f"IF x NOT IN ({_quoted(words.REPORT_STOP_WORDS)})]"
    )


SQL = {
    "t1_tokens": f"WITH {TOKENS} SELECT Id, array_to_string(words, '|') AS words FROM tokens",
    "t1_split_tokens": r"""SELECT CAST(doc_id AS VARCHAR) AS Id,
        array_to_string(regexp_extract_all(lower(text), '[0-9A-Za-z_]+'), '|') AS words FROM documents""",
    "t1_unicode_tokens": r"""SELECT CAST(doc_id AS VARCHAR) AS Id, array_to_string(
        [x FOR x IN regexp_extract_all(lower(text), '[\p{L}\p{M}\p{Nd}\p{Nl}\p{Pc}]+') IF length(x) >= 2], '|') AS words
        FROM documents""",
    "t2_stopwords": f"""WITH {TOKENS} SELECT Id, array_to_string(filtered, '|') AS filtered,
        array_to_string([x FOR x IN words IF x NOT IN ({_quoted(STOP_WORDS)})], '|') AS plain FROM filtered""",
    "t3_lemmas": f"""WITH {TOKENS}, {_LEMMAS},
        each AS (SELECT Id, unnest(filtered) AS token, generate_subscripts(filtered, 1) AS pos FROM filtered),
        replaced AS (SELECT Id, string_agg(coalesce(lemma, token), '|' ORDER BY pos) AS l
          FROM each LEFT JOIN lemmas USING (token) GROUP BY Id)
        SELECT Id, coalesce(l, '') AS lemmatized FROM filtered LEFT JOIN replaced USING (Id)""",
    "t3_lemma_table": f"WITH {TOKENS}, {_LEMMAS} SELECT token, lemma FROM lemmas",
    "t4_bigrams": f"WITH {TOKENS} SELECT Id, array_to_string({_PAIRS}, '|') AS bigrams FROM filtered",
    "t5_combined": f"""WITH {TOKENS} SELECT Id, array_to_string(list_concat(filtered, {_PAIRS}), '|') AS tokens
        FROM filtered""",
    "t7_idf": f"WITH {TOKENS}, {_OCCURRENCES} SELECT token, df, round(idf, 6) AS idf FROM idf",
    "t7_tf_idf": f"""WITH {TOKENS}, {_OCCURRENCES} SELECT Id, token, tf, round(tf * idf, 6) AS tfidf
        FROM occ JOIN idf USING (token)""",
    "t9_sparsity": f"""WITH {TOKENS}, sized AS (SELECT len(list_distinct(filtered)) AS n FROM filtered)
        SELECT CAST(min(n) AS INT) AS min, round(avg(n), 6) AS mean, CAST(max(n) AS INT) AS max FROM sized""",
    "t11_top_words": f"""WITH {v.DOC_REVIEWS}, each AS (
        SELECT CASE WHEN Score IS NULL THEN 'unknown' WHEN Score < 3 THEN 'negative' WHEN Score = 3 THEN 'neutral'
          ELSE 'positive' END AS Sentiment, unnest({_report_words('Text')}) AS word FROM doc_reviews)
        SELECT Sentiment, word, count(*) AS count,
          row_number() OVER (PARTITION BY Sentiment ORDER BY count(*) DESC, word) AS rank
        FROM each GROUP BY 1, 2 QUALIFY rank <= 15""",
    "t12_word_frequencies": f"""WITH {v.DOC_REVIEWS}, each AS (
        SELECT unnest({_report_words('Text')}) AS word FROM doc_reviews WHERE Score = 5)
        SELECT word, count(*) AS count FROM each GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 100""",
    "t13_token_reduction": rf"""WITH cleaned AS (SELECT CAST(doc_id AS VARCHAR) AS Id,
        regexp_extract_all(regexp_replace(lower(text), '[^a-z0-9\s]', ' ', 'g'), '[a-z0-9]+') AS w FROM documents)
        SELECT Id, CAST(len(w) AS INT) AS token_count,
          CAST(len([x FOR x IN w IF x NOT IN ({_quoted(STOP_WORDS)})]) AS INT) AS filtered_count FROM cleaned""",
}
