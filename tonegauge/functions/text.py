"""Token expressions on text and on token arrays."""

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Negations that stay in the text, and the stop words of the top-word report.
NEGATIONS = [
    "not", "no", "nor", "never", "neither", "none", "nobody",
    "nowhere", "hardly", "barely", "scarcely",
]
REPORT_STOP_WORDS = (
    "a an the and or but in on at to for of is it this that was are with as i my we our have "
    "be by not so if me us its they them their from very just even also can would could more when than "
    "has all been had what like get one do did no will only about up out other some there which am"
).split()


def english_stop_words(keep: Iterable[str] = NEGATIONS) -> list[str]:
    """Spark's English stop words without the kept ones."""
    from pyspark.ml.feature import StopWordsRemover

    kept = set(keep)
    return [w for w in StopWordsRemover.loadDefaultStopWords("english") if w not in kept]


def normalise(text: Column) -> Column:
    """Lower case, every character outside a-z 0-9 becomes a space, runs of white space become one."""
    spaced = F.regexp_replace(F.lower(text), r"[^a-z0-9\s]", " ")
    return F.regexp_replace(spaced, r"\s+", " ")


def letters_only(text: Column) -> Column:
    """Everything but ASCII letters and white space is deleted, then lower case."""
    return F.lower(F.regexp_replace(text, r"[^a-zA-Z\s]", ""))


def word_tokens(text: Column, min_length: int = 2, unicode: bool = False) -> Column:
    r"""Lower-cased ``\w+`` matches of at least ``min_length`` characters."""
    pattern = r"(?U)\w+" if unicode else r"\w+"
    found = F.regexp_extract_all(F.lower(text), F.lit(pattern), F.lit(0))
    return F.filter(found, lambda t: F.length(t) >= min_length)


def split_tokens(text: Column, gap: str = r"\W+") -> Column:
    """Lower-cased pieces between gaps, empty pieces left out."""
    return F.filter(F.split(F.lower(text), gap), lambda t: F.length(t) >= 1)


def letter_words(text: Column) -> Column:
    """Lower-cased runs of three or more ASCII letters."""
    return F.regexp_extract_all(F.lower(text), F.lit("[a-z]{3,}"), F.lit(0))


def without_words(tokens: Column, stop_words: Iterable[str]) -> Column:
    """Lower-case tokens that are not stop words, order and repeats kept."""
    # a literal IN list becomes a hash set, so each token costs one lookup
    words = sorted(set(stop_words))
    return F.filter(tokens, lambda t: ~t.isin(words))


def bigrams(tokens: Column) -> Column:
    """Neighbouring pairs joined by a space; fewer than two tokens give an empty array."""
    heads = F.slice(tokens, F.lit(1), F.greatest(F.size(tokens) - 1, F.lit(0)))
    tails = F.slice(tokens, F.lit(2), F.greatest(F.size(tokens) - 1, F.lit(0)))
    pairs = F.zip_with(heads, tails, lambda a, b: F.concat_ws(" ", a, b))
    return F.when(F.size(tokens) < 2, F.array().cast("array<string>")).otherwise(pairs)


def combined(unigrams: Column, pairs: Column) -> Column:
    """Unigrams followed by bigrams, repeats kept, null counts as empty."""
    empty = F.array().cast("array<string>")
    return F.concat(F.coalesce(unigrams, empty), F.coalesce(pairs, empty))


def word_count(text: Column) -> Column:
    """Number of pieces between white space."""
    return F.size(F.filter(F.split(F.trim(text), r"\s+"), lambda w: w != ""))
