"""Quality rules as a short-circuit cascade, in DataFrame functions alone.

Each rule is a condition on a text that rejects it. One aggregation over a hashed sample of the rows gives the share that each
rule rejects and its cost, and rules are ordered by rejections per cost. A cost is an estimate from what a rule reads: so much
a character and so much a word of the sample's texts. It depends on the rows alone, so one table has one order.

``passing`` is the cascade: each rule in turn sees the texts that no rule before it has rejected, and nothing of the others, so
a costly measure is not worked out for them. ``judged`` gives every measure of every row, and a verdict in the same order. The
order changes the time and not the outcome: a text is rejected if any rule rejects it.

Words are ``[^\\x20\\x09-\\x0D]+``. Defined results: null text has no words; copies, ties and repeated rows are judged alike;
an empty table gives no row; ``judged`` keeps input columns, result columns replace those of the same name; ``passing`` keeps
all columns as they are. Memory is one row.
"""

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

SPACE = "[ \\x09-\\x0D]+"
SYMBOLS = "#*$%&|<>"
SAMPLE_ROWS = 2000


def with_words(df: DataFrame, text: Column, into: str) -> DataFrame:
    """``into``: the words of a text. Only white space at its ends makes empty strings, and few texts have that."""
    first, last = F.get("_split", F.lit(0)) == "", F.get("_split", F.size("_split") - 1) == ""
    inner = F.slice("_split", F.when(first, 2).otherwise(1), F.greatest(F.size("_split") - F.when(first, 1).otherwise(0) - F.when(last, 1).otherwise(0), F.lit(0)))
    split = df.withColumn("_split", F.split(F.coalesce(text, F.lit("")), SPACE))
    return split.withColumn(into, F.when(first | last, inner).otherwise(F.col("_split"))).drop("_split")


def occurrences(text: Column, characters: str) -> Column:
    """How many characters of the text are in a class of single characters."""
    return (F.size(F.split(F.coalesce(text, F.lit("")), characters, -1)) - 1).cast("bigint")


def word_chars(text: Column) -> Column:
    return F.coalesce(F.char_length(text), F.lit(0)) - occurrences(text, "[ \\x09-\\x0D]")


def n_symbols(text: Column) -> Column:
    return occurrences(text, f"[{SYMBOLS}]")


def n_dup_lines(text: Column) -> Column:
    """Lines with a word that equal an earlier line."""
    lines = F.filter(F.split(F.coalesce(text, F.lit("")), "\n"), lambda x: F.btrim(x, F.lit(" \t\n\x0b\x0c\r")) != "")
    return (F.size(lines) - F.size(F.array_distinct(lines))).cast("bigint")


def with_repeat_words(df: DataFrame, word: str, into: str) -> DataFrame:
    """``into``: words inside 3-word windows that the array ``word`` has twice or more.

    Arrays that a later step reads per element are columns of their own, so that they are worked out once per row. Windows are
    only sorted where some window repeats.
    """
    n = F.size(word)
    hashes = F.transform(
        F.when(n >= 3, F.sequence(F.lit(0), n - 3)).otherwise(F.array().cast("array<int>")),
        lambda i: F.xxhash64(F.get(word, i), F.get(word, i + 1), F.get(word, i + 2)),
    )
    ranked = F.when(
        F.size(F.array_distinct("_hashes")) < F.size("_hashes"),
        F.sort_array(F.transform("_hashes", lambda h, i: F.struct(h.alias("h"), i.alias("i")))),
    )
    same = lambda x, k: F.get("_ranked", k)["h"] == x["h"]
    before = lambda x, k: (k > 0) & same(x, F.greatest(k - 1, F.lit(0)))
    places = F.sort_array(F.transform(F.filter("_ranked", lambda x, k: before(x, k) | F.coalesce(same(x, k + 1), F.lit(False))), lambda x: x["i"]))
    # each such window adds the words that the one before it does not have
    total = F.aggregate(
        places,
        F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(0).alias("end")),
        lambda s, p: F.struct((s["n"] + (p + 3 - F.greatest(s["end"], p))).cast("bigint").alias("n"), (p + 3).alias("end")),
        lambda s: s["n"],
    )
    return (
        df.withColumn("_hashes", hashes).withColumn("_ranked", ranked)
        .withColumn(into, F.coalesce(total, F.lit(0)).cast("bigint")).drop("_hashes", "_ranked")
    )


def measured(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words and base_failed."""
    own = {c: f"c{k}_" for k, c in enumerate(docs.columns)}
    body = F.col(own[text])
    df = with_words(docs.select(*[F.col(c).alias(n) for c, n in own.items()]), body, "all_words")
    df = with_repeat_words(df, "all_words", "n_repeat_words")
    n = F.size("all_words").cast("bigint")
    return df.select(
        *[F.col(x).alias(c) for c, x in own.items() if c not in MEASURES],
        n.alias("n_words"),
        word_chars(body).alias("word_chars"),
        n_symbols(body).alias("n_symbols"),
        n_dup_lines(body).alias("n_dup_lines"),
        "n_repeat_words",
        ((n < 50) | (100 * F.col("n_repeat_words") > 50 * n)).alias("base_failed"),
    )


MEASURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
#: Measures of a text that need no other column.
MEASURED = {"word_chars": word_chars, "n_symbols": n_symbols, "n_dup_lines": n_dup_lines}


@dataclass
class Rule:
    """``rejects``: a condition on a row of ``measured`` that still has its text, given as a column. ``a_char`` and ``a_word``:
    the estimated cost of a character and of a word. ``needs``: the measure among ``MEASURES`` that the condition reads."""

    name: str
    rejects: Callable[[Column], Column]
    a_char: float
    a_word: float = 0.0
    needs: str = "n_words"


def n_lines(text: Column) -> Column:
    return F.size(F.split(text, "\n"))


#: Costs are nanoseconds of a core, measured once rule by rule over 74 million characters (12 million words) of documents; the
#: words themselves are there for all rules.
RULES = [
    Rule("few_words", lambda text: F.col("n_words") < 50, 0.01),
    Rule("repeats", lambda text: 100 * F.col("n_repeat_words") > 50 * F.col("n_words"), 0.0, 571.0, "n_repeat_words"),
    # the rules beyond the base ones are far from what prose in any language does
    Rule("long_words", lambda text: F.col("word_chars") > 40 * F.col("n_words"), 0.0, 130.0, "word_chars"),
    Rule("symbols", lambda text: F.col("n_symbols") > F.col("n_words"), 2.4, 0.0, "n_symbols"),
    Rule("dup_lines", lambda text: 2 * F.col("n_dup_lines") > n_lines(text), 7.2, 0.0, "n_dup_lines"),
    Rule("digits", lambda text: 3 * occurrences(text, "[0-9]") > F.col("word_chars"), 1.7, 130.0, "word_chars"),
    Rule("bullets", lambda text: 10 * F.size(F.split(text, "(?m)^[ \t]*[-*\u2022] ")) > 9 * n_lines(text) + 10, 0.5),
]


def sampled(docs: DataFrame, text: str, most: int = SAMPLE_ROWS) -> DataFrame:
    """About ``most`` rows, or all if there are fewer, by a hash of the row's plain columns."""
    plain = [f.name for f in docs.schema.fields if isinstance(f.dataType, (T.NumericType, T.StringType, T.BinaryType, T.DateType, T.TimestampType))]
    share = docs.count() // most
    return docs.filter(F.pmod(F.xxhash64(*(plain or [text])), F.lit(share)) == 0) if share > 1 else docs


def order(docs: DataFrame, rules: list[Rule], text: str = "text", sample_rows: int = SAMPLE_ROWS) -> list[Rule]:
    """The rules by rejections per cost on a sample; ties by their place in the list. One row of sums reaches the driver."""
    filled = F.coalesce(F.col(text), F.lit(""))
    rows = measured(sampled(docs.select(text, *[c for c in docs.columns if c not in {text, *MEASURES}]), text, sample_rows), text)
    sums = rows.agg(
        F.count("*").alias("n"), F.sum(F.char_length(filled)).alias("chars"), F.sum("n_words").alias("words"),
        *[F.count_if(F.coalesce(r.rejects(filled), F.lit(False))).alias(f"hits{k}") for k, r in enumerate(rules)],
    ).first()
    chars, words = (sums["chars"] or 0) + 1, (sums["words"] or 0) + 1
    rate = [(sums[f"hits{k}"] + 0.5) / (sums["n"] + 1) / (r.a_char * chars + r.a_word * words) for k, r in enumerate(rules)]
    return [rules[k] for k in sorted(range(len(rules)), key=lambda k: (-rate[k], k))]


def judged(docs: DataFrame, text: str = "text", rules: list[Rule] | None = None) -> DataFrame:
    """``docs`` with the measures and ``kept``."""
    rules = RULES if rules is None else rules
    rows = measured(docs, text)
    filled = F.coalesce(F.col(text), F.lit(""))
    cascade = None
    for rule in order(docs, rules, text):
        condition = F.coalesce(rule.rejects(filled), F.lit(False))
        cascade = F.when(condition, False) if cascade is None else cascade.when(condition, False)
    verdict = cascade.otherwise(True) if cascade is not None else F.lit(True)
    # a row number keeps filters on the verdict above this step: pushed below it, they would repeat every measure for each use
    return rows.withColumn("kept", verdict & (F.monotonically_increasing_id() >= 0))


def passing(docs: DataFrame, text: str = "text", rules: list[Rule] | None = None) -> DataFrame:
    """The rows of ``docs`` that no rule rejects, with their own columns."""
    rules = RULES if rules is None else rules
    own = {c: f"c{k}_" for k, c in enumerate(docs.columns)}
    body = own[text]
    rows = with_words(docs.select(*[F.col(c).alias(n) for c, n in own.items()]), F.col(body), "all_words")
    rows = rows.withColumn("n_words", F.size("all_words").cast("bigint")).withColumn("out", F.lit(False))
    known = {"n_words"}
    for rule in order(docs, rules, text):
        # what a row that is rejected has to show is the empty text
        left = F.when(~F.col("out"), F.coalesce(F.col(body), F.lit(""))).otherwise(F.lit(""))
        rows = rows.withColumn("left", left)
        if rule.needs not in known:
            if rule.needs == "n_repeat_words":
                words = F.when(~F.col("out"), F.col("all_words")).otherwise(F.array().cast("array<string>"))
                rows = with_repeat_words(rows.withColumn("left_words", words), "left_words", "n_repeat_words").drop("left_words")
            else:
                rows = rows.withColumn(rule.needs, MEASURED[rule.needs](F.col("left")))
            # a measure taken of the empty text of a rejected row serves only rules behind, which that row passes by
            known.add(rule.needs)
        rejected = F.when(~F.col("out"), F.coalesce(rule.rejects(F.col("left")), F.lit(False))).otherwise(F.lit(True))
        rows = rows.withColumn("out", rejected)
    kept = rows.withColumn("out", F.col("out") | (F.monotonically_increasing_id() < 0)).filter(~F.col("out"))
    return kept.select(*[F.col(n).alias(c) for c, n in own.items()])
