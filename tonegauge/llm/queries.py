"""The registered queries of this subpackage: each applies one operator to its whole table, and SQL where SQL can say it."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tonegauge.llm import (
    hmm, packing, periodic_runs, pieces, pivot_index, prefix_trie, quality, secret_scan, simhash, suffix_dedup, top_k, toxicity, warc,
)
from tonegauge.llm.store import stored


def tokenizer(name: str) -> str:
    """The file of a public tokenizer."""
    import public_tokenizers

    return public_tokenizers.path(name)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def fold(id: Column, count: int) -> Column:
    """The rest of an id's CRC-32, of its decimal text, by ``count``; no id counts as the empty text (0)."""
    return F.crc32(F.coalesce(id.cast("string"), F.lit("")).cast("binary")) % count


def op1_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """``text`` is what is left where repeated passages of over 50 words go too, however few bytes they have."""
    cut = suffix_dedup.remove_repeats(table(spark, folder, "documents").select("doc_id", "text"), words=51)
    rest = suffix_dedup.readable("rest").alias("text")
    return cut.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"), rest)


def op2_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return packing.pack(docs, tokenizer("byte_bpe_50k.json"), with_ids=False)


def op3_sentencepiece(spark: SparkSession, folder: str) -> DataFrame:
    """Ids of every text, and whether decoding them gives the text back."""
    docs = table(spark, folder, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    model = tokenizer("piece_bpe_32k.model")
    coded = pieces.encode(docs, model, decoded=True)
    return coded.select(
        "doc_id", "n_words", "n_pieces", F.crc32("ids").alias("ids_crc32"), F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
        (F.col("decoded") == F.col("text")).alias("round_trip"),
    )


def op4_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    found = secret_scan.scan(table(spark, folder, "documents").select("doc_id", "text"), redact=False)
    return digest_spans(found)


def digest_spans(found: DataFrame) -> DataFrame:
    def spelled(spans: Column) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")
    base = F.filter("spans", lambda s: s["kind"].isin(secret_scan.BASE))
    return found.select(
        "doc_id", *map(count, secret_scan.BASE), F.sha2(spelled(base).cast("binary"), 256).alias("base_sha256"),
        spelled(F.col("spans")).alias("spans"),
    )


def op5_top_k(spark: SparkSession, folder: str) -> DataFrame:
    return top_k.search(table(spark, folder, "embeddings"), F.col("vec_id") % 50 == 0)


def op6_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text", (fold(F.col("doc_id"), 4) == 2).alias("held_out"))
    marks = table(spark, folder, "labels").select("doc_id", "toxic").filter(fold(F.col("doc_id"), 4) != 2)
    seen, toxic = marks.agg(F.count("toxic"), F.sum(F.coalesce("toxic", F.lit(0)))).first()
    prior = min(max((toxic or 0) / max(seen, 1), 1e-3), 0.5)
    model = toxicity.fit(docs.filter(~F.col("held_out")), marks.filter(F.col("toxic") == 1), prior)
    return toxicity.scored(docs, model)


def op7_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return quality.judged(table(spark, folder, "documents").select("doc_id", "text")).drop("text")


def op8_hidden_markov(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text", (fold(F.col("doc_id"), 10) == 0).alias("held_out"))
    return hmm.scored(docs, ~F.col("held_out"))


def op9_simhash(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, folder, "documents").select("doc_id", "text"))


def op10_warc(spark: SparkSession, folder: str) -> DataFrame:
    return warc.round_trip(table(spark, folder, "pages"))


def with_repeats(docs: DataFrame) -> DataFrame:
    """``docs`` with one text in ten replaced by its words, of which those from the a-th on repeat with period p."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = F.filter(F.split("text", "[\\x20\\x09-\\x0D]+"), lambda w: w != "")
    chosen = F.coalesce(h % 10 == 0, F.lit(False))
    rows = docs.withColumn("words", F.when(chosen, words)).withColumn("n", F.size("words").cast("bigint"))
    rows = rows.withColumn("a", F.when(F.col("n") > 0, F.floor(h / 10) % F.col("n")).cast("int"))
    p = 1 + F.floor((F.col("n") - F.col("a")) / (3 + F.floor(h / 10) % 8))
    rows = rows.withColumn("rest", (F.col("n") - F.col("a")).cast("int")).withColumn("p", p.cast("int"))
    turns = F.ceil(F.col("rest") / F.col("p")).cast("int")
    again = F.slice(F.flatten(F.array_repeat(F.slice("words", F.col("a") + 1, F.col("p")), turns)), F.lit(1), F.col("rest"))
    mended = F.array_join(F.concat(F.slice("words", F.lit(1), F.col("a")), again), " ")
    return rows.select("doc_id", F.when(F.col("n") > 0, mended).otherwise(F.col("text")).alias("text"))


def op11_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    found = periodic_runs.find_runs(with_repeats(table(spark, folder, "documents").select("doc_id", "text")))
    return digest_runs(found)


def digest_runs(found: DataFrame) -> DataFrame:
    longest = F.get(F.sort_array(F.transform("runs", lambda r: F.struct((-r["length"]).alias("less"), r["start"].alias("start"), r["period"].alias("period")))), F.lit(0))
    spelled = F.array_join(F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))), "")
    return found.withColumn("top", longest).select(
        "doc_id", F.size("runs").cast("bigint").alias("n_runs"), F.col("top.start").alias("start"), (-F.col("top.less")).alias("length"),
        F.col("top.period").alias("period"), F.floor(-1000 * F.col("top.less") / F.col("top.period")).alias("exponent_milli"),
        F.sha2(spelled.cast("binary"), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def op12_pivot_index(spark: SparkSession, folder: str) -> DataFrame:
    return pivot_index.near_duplicates(table(spark, folder, "embeddings").select("vec_id", "embedding"))


def rebuilt(convs: DataFrame) -> DataFrame:
    """Sequences (conv, turns) that begin with the first turns of an earlier conversation."""
    h = (F.crc32(F.col("conv").cast("string").cast("binary")) % 4).cast("int")
    heads = convs.select(F.col("conv").alias("base"), F.slice("turns", 1, 3).alias("head"))
    own = F.slice("turns", h + 1, F.size("turns"))
    joined = convs.withColumn("base", F.col("conv") - F.col("conv") % 20).join(heads, "base", "left")
    return joined.select("conv", F.when(F.col("head").isNull(), own).otherwise(F.concat(F.slice("head", F.lit(1), h), own)).alias("turns"))


def op13_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    return prefix_trie.trie(stored(rebuilt(stored(prefix_trie.sequences(table(spark, folder, "conversations"))))))


QUERIES = {f.__name__: f for f in [
    op1_suffix_dedup, op2_best_fit_packing, op3_sentencepiece, op4_secret_scan, op5_top_k, op6_toxicity, op7_quality_rules,
    op8_hidden_markov, op9_simhash, op10_warc, op11_periodic_runs, op12_pivot_index, op13_prefix_trie,
]}

SQL = {
    "op5_top_k": """
WITH good AS (
  SELECT vec_id, list_transform(embedding, lambda x: cast(floor(256 * cast(x AS double)) AS bigint)) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT q.vec_id AS query_id, r.vec_id AS vec_id,
    cast(list_sum(list_transform(range(1, 1 + least(len(q.v), len(r.v))), lambda i: q.v[i] * r.v[i])) AS bigint) AS score
  FROM good q JOIN good r ON q.vec_id % 50 = 0 AND q.vec_id <> r.vec_id),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored)
SELECT query_id, cast(rank AS int) AS rank, vec_id, score FROM ranked WHERE rank <= 5""",
    "op7_quality_rules": r"""
WITH w AS (
  SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
windows AS (
  SELECT *, list_transform(range(1, len(words) - 1), lambda i: words[i] || ' ' || words[i + 1] || ' ' || words[i + 2]) AS g,
    list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM w),
places AS (
  SELECT doc_id, unnest(g) AS g, generate_subscripts(g, 1) AS i FROM windows),
repeated AS (
  SELECT doc_id, i FROM places QUALIFY count(*) OVER (PARTITION BY doc_id, g) > 1),
covered AS (
  SELECT doc_id, count(DISTINCT i + k) AS n FROM repeated, (VALUES (0), (1), (2)) AS x(k) GROUP BY doc_id),
measured AS (
  SELECT doc_id, t, cast(len(words) AS bigint) AS n_words,
    cast(length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g')) AS bigint) AS word_chars,
    cast(length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS bigint) AS n_symbols,
    cast(len(lines) - len(list_distinct(lines)) AS bigint) AS n_dup_lines,
    cast(coalesce(covered.n, 0) AS bigint) AS n_repeat_words
  FROM windows LEFT JOIN covered USING (doc_id)),
judged AS (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM measured)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT (base_failed OR word_chars > 40 * n_words OR n_symbols > n_words
    OR 2 * n_dup_lines > len(string_split(t, chr(10)))
    OR 3 * length(regexp_replace(t, '[^0-9]', '', 'g')) > word_chars
    OR 10 * (1 + len(regexp_extract_all(t, '(?m)^[ \t]*[-*•] '))) > 9 * len(string_split(t, chr(10))) + 10) AS kept
FROM judged""",
    "op10_warc": """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS body FROM pages),
d AS (
  SELECT page_id, strlen(body) AS n, sha256(body) AS h FROM p),
f AS (
  SELECT h, min(page_id) AS first FROM d WHERE n >= 100 GROUP BY h)
SELECT page_id, cast(n AS bigint) AS payload_bytes, d.h AS payload_digest,
  CASE WHEN n >= 100 AND first < coalesce(page_id, first + 1) THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN n >= 100 AND first < coalesce(page_id, first + 1) THEN first END AS refers_to
FROM d LEFT JOIN f ON d.h = f.h""",
    "op12_pivot_index": """
WITH RECURSIVE v AS (
  SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: cast(x AS double)) AS e FROM embeddings),
good AS (
  SELECT * FROM v WHERE e IS NOT NULL AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(e, lambda x: x <> 0)) > 0),
links AS (
  SELECT a.r AS a, b.r AS b FROM good a JOIN good b ON a.r <> b.r AND len(a.e) = len(b.e)
  WHERE CASE WHEN len(a.e) = len(b.e) THEN list_cosine_similarity(a.e, b.e) END >= 0.95),
reach AS (SELECT r AS a, r AS b FROM v UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a),
least AS (SELECT reach.a, min(v.vec_id) AS component_id FROM reach JOIN v ON reach.b = v.r GROUP BY reach.a),
counted AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT v.vec_id, cast(coalesce(n, 0) AS bigint) AS n_links, component_id, coalesce(component_id = v.vec_id, false) AS kept
FROM v JOIN least ON v.r = least.a LEFT JOIN counted ON v.r = counted.a""",
    "op13_prefix_trie": r"""
WITH t AS (
  SELECT conv_id, turn, {'r': coalesce(role, ''), 't': coalesce(text, '')} AS said FROM conversations WHERE conv_id IS NOT NULL),
s AS (
  SELECT conv_id, list(said ORDER BY turn NULLS FIRST, said.r, sha256(said.t)) AS own, xor(list_reduce(list_concat([4294967295],
    flatten(list_transform(string_split(cast(conv_id AS varchar), ''), lambda c: [ascii(c), -1, -1, -1, -1, -1, -1, -1, -1]))),
    lambda crc, x: CASE WHEN x >= 0 THEN xor(crc, x) ELSE xor(crc >> 1, (crc & 1) * 3988292384) END), 4294967295) % 4 AS h
  FROM t GROUP BY conv_id),
c AS (
  SELECT s.conv_id, list_concat(coalesce(b.own, [])[1:s.h], s.own[s.h + 1:]) AS path
  FROM s LEFT JOIN s b ON b.conv_id = s.conv_id - s.conv_id % 20),
p AS (SELECT conv_id, path, unnest(range(0, len(path) + 1)) AS d FROM c),
nodes AS (
  SELECT path[1:d] AS path, d AS depth, min(conv_id) AS conv_id, count(*) AS n_convs,
    coalesce(string_agg(cast(conv_id AS varchar), ',' ORDER BY conv_id) FILTER (len(path) = d), '') AS ends
  FROM p GROUP BY path[1:d], d),
kids AS (SELECT path[1:depth - 1] AS path, count(*) AS n FROM nodes WHERE depth > 0 GROUP BY path[1:depth - 1]),
weighed AS (
  SELECT nodes.*, coalesce(kids.n, 0) AS n_children, (n_convs - 1) * CASE WHEN depth = 0 THEN 0
    ELSE len(regexp_extract_all(nodes.path[depth].t, '[^\x20\x09-\x0D]+')) END AS saved
  FROM nodes LEFT JOIN kids ON nodes.path = kids.path),
up AS (SELECT path, n_children, saved, unnest(range(0, depth + 1)) AS k FROM weighed),
sums AS (SELECT path[1:k] AS path, count(*) FILTER (n_children = 0) AS n_leaves, sum(saved) AS saved FROM up GROUP BY path[1:k])
SELECT n.conv_id, n.depth, parent.conv_id AS parent_conv_id, n.n_convs, cast(n.n_children AS bigint) AS n_children,
  cast(n_leaves AS bigint) AS n_leaves, cast(sums.saved AS bigint) AS saved_tokens, sha256(n.ends) AS ends_sha256
FROM weighed n JOIN sums ON n.path = sums.path LEFT JOIN nodes parent ON n.depth > 0 AND parent.path = n.path[1:n.depth - 1]""",
}
