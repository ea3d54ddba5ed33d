"""SQL text of the review views for the comparison engine."""

REVIEWS = """
reviews AS (
  SELECT concat(l_orderkey, '-', l_linenumber, '-', l_partkey, '-', l_suppkey) AS Id,
    concat('P', l_partkey) AS ProductId,
    1 + CAST(l_quantity AS INT) % 5 AS Score,
    CAST(epoch(l_shipdate) AS BIGINT) AS Time,
    CAST(round(l_discount * 100) AS INT) % 4 AS HelpfulnessNumerator,
    l_linenumber % 4 AS HelpfulnessDenominator,
    concat(l_returnflag, ' ', l_linestatus) AS Summary,
    concat('U', o_custkey) AS UserId,
    concat('Reader ', o_custkey) AS ProfileName,
    DATE '1970-01-01' + CAST(floor(epoch(l_shipdate) / 86400) AS INT) AS day
  FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey)
"""

LABELLED = REVIEWS + """,
labelled AS (
  SELECT *, CASE WHEN Score < 3 THEN 'negative' WHEN Score = 3 THEN 'neutral' ELSE 'positive' END AS Sentiment,
    CASE WHEN Score < 3 THEN 0 WHEN Score = 3 THEN 1 ELSE 2 END AS label, md5(Id) AS h
  FROM reviews)
"""

PREDICTIONS = LABELLED + """,
predicted AS (
  SELECT *, CASE WHEN substr(h, 1, 1) < 'c' THEN label ELSE (label + 1) % 3 END AS prediction FROM labelled),
weighted AS (
  SELECT *,
    1 + instr('0123456789abcdef', substr(h, 2, 1)) + CASE WHEN prediction = 0 THEN 16 ELSE 0 END AS w0,
    1 + instr('0123456789abcdef', substr(h, 3, 1)) + CASE WHEN prediction = 1 THEN 16 ELSE 0 END AS w1,
    1 + instr('0123456789abcdef', substr(h, 4, 1)) + CASE WHEN prediction = 2 THEN 16 ELSE 0 END AS w2
  FROM predicted),
predictions AS (
  SELECT *, w0 / (w0 + w1 + w2) AS p0, w1 / (w0 + w1 + w2) AS p1, w2 / (w0 + w1 + w2) AS p2,
    CASE prediction WHEN 0 THEN 'negative' WHEN 1 THEN 'neutral' ELSE 'positive' END AS PredictedSentiment,
    strftime(TIMESTAMP '1970-01-01' + to_seconds(Time), '%Y-%m-%d %H:%M:%S') AS ProcessingTime,
    CAST(floor(Time / 86400) AS BIGINT) AS batch_id
  FROM weighted)
"""

DOC_REVIEWS = """
doc_reviews AS (
  SELECT CAST(doc_id AS VARCHAR) AS Id, source AS ProductId, lang AS UserId,
    CAST(CASE WHEN toxic = 1 THEN 1 WHEN quality = 0 THEN 3 WHEN quality = 1 THEN 5 END AS DOUBLE) AS Score,
    1325376000 + 3600 * doc_id AS Time, string_split(text, chr(10))[1] AS Summary, text AS Text
  FROM documents LEFT JOIN labels USING (doc_id))
"""


def percent(part: str, total: str, digits: int = 1) -> str:
    step = 10 ** digits
    return (
        f"CASE WHEN {total} > 0 THEN ({200 * step} * CAST({part} AS BIGINT) + CAST({total} AS BIGINT)) "
        f"// (2 * CAST({total} AS BIGINT)) / {float(step)} ELSE 0.0 END"
    )


def share(part: str, total: str) -> str:
    return f"CASE WHEN {total} > 0 THEN CAST({part} AS DOUBLE) / {total} ELSE 0.0 END"


def counts(name: str, weight: str = "1") -> str:
    """Three summed class columns."""
    return ", ".join(
        f"CAST(coalesce(sum(CASE WHEN lower({name}) = '{s}' THEN {weight} END), 0) AS BIGINT) AS {s}"
        for s in ["positive", "neutral", "negative"]
    )
