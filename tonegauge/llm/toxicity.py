"""Toxicity scores from non-negative positive-unlabelled learning.

Learning sees confirmed toxic texts (positive) and texts without regard to their label (unlabelled). The risk is
prior * R(positive as 1) + max(0, R(unlabelled as 0) - prior * R(positive as 0)); where the second part falls below zero the
step goes against it, so the classifier cannot explain the unlabelled texts away. ``prior`` is the share of toxic texts.

A text is the set of its words: bytes, A-Z lower-cased, marks at the ends taken off, hashed to 32 bits. The learning rows are a
bounded sample by a hash of the id (``positives`` and ``unlabelled`` rows at most, documented parameters), dealt to ``folds``
folds. One task per fold trains a linear classifier in numpy on the other folds, and sets its bias on its own; the
classifiers are averaged. Only words that occur in several positive texts get a weight, so the model is bounded by the
sample. All rows are scored.

Defined results: null and empty texts have no word and get the score of the bias; rows are independent and copies score
alike; without a positive row every score is 0; an empty table gives no row; input columns (without the text) are kept, result
columns replace those of the same name.
"""

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tonegauge.llm import blocks
from tonegauge.llm.store import stored

POSITIVES, UNLABELLED, FOLDS = 8_000, 16_000, 5
MARKS = b".,;:!?\"'()*#$%&|<>-"
#: Positive learning texts that a word must occur in.
LEAST = 3
EPOCHS, RATE, BIAS_RATE, DECAY = 150, 20.0, 0.5, 1e-4
#: Score from which a text counts as toxic.
CUT = 0.3
#: Natural log of how much more often positive texts must have a word.
LIFT = 0.7


def word_keys(text: bytes) -> set[int]:
    return {xxhash.xxh32_intdigest(w) for w in {x.strip(MARKS) for x in text.lower().split()} if w}


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


class Features:
    """Rows of word sets as flat index arrays over the words that get a weight."""

    def __init__(self, sets: list, keys: np.ndarray):
        flat = np.concatenate([np.asarray(s, np.int64) for s in sets]) if sets else np.zeros(0, np.int64)
        row = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
        at = np.minimum(np.searchsorted(keys, flat), max(len(keys) - 1, 0))
        hit = keys[at] == flat if len(keys) else np.zeros(len(flat), bool)
        self.rows, self.cols, self.n, self.width = row[hit], at[hit], len(sets), len(keys)

    def times(self, weights: np.ndarray) -> np.ndarray:
        return np.bincount(self.rows, weights[self.cols], self.n)

    def back(self, per_row: np.ndarray) -> np.ndarray:
        return np.bincount(self.cols, per_row[self.rows], self.width)


def train(positive: list, unlabelled: list, held: list, prior: float) -> tuple[np.ndarray, np.ndarray, float]:
    """Word keys, their weights and the bias. The bias is moved so that of ``held``, unlabelled texts that the classifier has
    not seen, a share of ``prior`` at most gets a score of CUT or more."""
    keys, weights, bias = descend(positive, unlabelled, prior)
    if held:
        margins = Features(held, keys).times(weights) + bias
        # the lowest margin that no larger share reaches: texts that tie below it stay out together
        reached, n = np.unique(margins, return_counts=True)
        share = np.cumsum(n[::-1])[::-1] / len(margins)
        lowest = reached[min(int(np.searchsorted(-share, -prior)), len(reached) - 1)]
        bias += math.log(CUT / (1 - CUT)) - float(lowest)
    return keys, weights, bias


def descend(positive: list, unlabelled: list, prior: float) -> tuple[np.ndarray, np.ndarray, float]:
    counted = np.concatenate([np.asarray(s, np.int64) for s in positive])
    keys, found = np.unique(counted, return_counts=True)
    keys, found = keys[found >= LEAST], found[found >= LEAST]
    share = np.bincount(Features(unlabelled, keys).cols, minlength=len(keys))
    # how much more often positive texts have a word; only words that point to toxic texts get a weight
    lift = np.log((found + 0.5) / (len(positive) + 1)) - np.log((share + 0.5) / (len(unlabelled) + 1))
    keys, lift = keys[lift > LIFT], lift[lift > LIFT]
    p, u = Features(positive, keys), Features(unlabelled, keys)
    weights, bias = np.zeros(len(keys)), math.log(prior / (1 - prior))
    for _ in range(EPOCHS):
        # sigmoid loss: as 1 it is 1 - s, as 0 it is s
        sp, su = sigmoid(p.times(weights * lift) + bias), sigmoid(u.times(weights * lift) + bias)
        slope_p, slope_u = sp * (1 - sp) / p.n, su * (1 - su) / u.n
        if su.mean() - prior * sp.mean() >= 0:
            on_p, on_u = -2 * prior * slope_p, slope_u
        else:
            on_p, on_u = prior * slope_p, -slope_u
        weights -= RATE * ((p.back(on_p) + u.back(on_u)) * lift + DECAY * weights)
        bias -= BIAS_RATE * (on_p.sum() + on_u.sum())
    return keys, weights * lift, bias


def examples(docs: DataFrame, confirmed: DataFrame, id: str, text: str, positives: int, unlabelled: int, folds: int) -> DataFrame:
    """(fold, own, positive, words) of the learning rows: the first by a hash of the id. Every fold gets all of them; its own
    share is marked. Only ids are sorted; the chosen ones, ``positives`` and ``unlabelled`` at most, are broadcast to the texts,
    and of rows that share an id the one with the smallest text is taken."""
    ids = docs.select(F.col(id).alias("_id")).filter(F.col("_id").isNotNull()).distinct()
    ids = ids.withColumn("_order", F.xxhash64(F.lit(6), F.col("_id").cast("string")))
    toxic = ids.join(confirmed.select(F.col(id).alias("_id")).distinct(), "_id", "left_semi")
    chosen = toxic.orderBy("_order", "_id").limit(positives).withColumn("positive", F.lit(True)).unionAll(
        ids.orderBy("_order", "_id").limit(unlabelled).withColumn("positive", F.lit(False))
    )
    chosen = stored(chosen.withColumn("home", F.pmod("_order", F.lit(folds)).cast("int")))
    found = docs.select(F.col(id).alias("_id"), F.coalesce(F.col(text).cast("binary"), F.lit(b"")).alias("_text")).join(F.broadcast(chosen), "_id")
    rows = found.groupBy("_id", "positive", "home").agg(F.min("_text").alias("_text")).select("positive", "home", "_text")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = [np.fromiter(word_keys(x.as_py()), np.uint32).tobytes() for x in batch.column("_text")]
            yield pa.RecordBatch.from_arrays([batch.column("home"), batch.column("positive"), pa.array(words, pa.binary())], ["home", "positive", "words"])

    words = rows.mapInArrow(work, "home int, positive boolean, words binary")
    return words.select(
        F.explode(F.sequence(F.lit(0), F.lit(folds - 1))).alias("fold"), "home", "positive", "words"
    ).select("fold", (F.col("fold") == F.col("home")).alias("own"), "positive", "words")


class Model:
    """The mean of the folds' classifiers."""

    def __init__(self, fitted: list):
        self.weights: dict[int, float] = {}
        self.bias = sum(r.bias for r in fitted) / len(fitted) if fitted else -math.inf
        for r in fitted:
            for key, weight in zip(np.frombuffer(r.keys, np.int64).tolist(), np.frombuffer(r.weights).tolist(), strict=True):
                self.weights[key] = self.weights.get(key, 0.0) + weight / len(fitted)

    def score(self, text: bytes) -> float:
        if self.bias == -math.inf:
            return 0.0
        get = self.weights.get
        margin = self.bias + sum(get(k, 0.0) for k in sorted(word_keys(text)))
        return 1 / (1 + math.exp(-max(min(margin, 700.0), -700.0)))


def fit(
    docs: DataFrame, confirmed: DataFrame, prior: float, id: str = "doc_id", text: str = "text",
    positives: int = POSITIVES, unlabelled: int = UNLABELLED, folds: int = FOLDS,
) -> Model:
    """``docs``: the rows to learn from; ``confirmed``: the ids of the toxic ones. Texts are unlabelled whatever their label."""

    def learn(table: pa.Table) -> pa.Table:
        words = [np.frombuffer(x, np.uint32).astype(np.int64) for x in table.column("words").to_pylist()]
        kinds = list(zip(words, table.column("positive").to_pylist(), table.column("own").to_pylist(), strict=True))
        toxic = [w for w, y, own in kinds if y and not own]
        others = [w for w, y, own in kinds if not y and not own]
        held = [w for w, y, own in kinds if not y and own]
        if not toxic or not others:
            return pa.table({"keys": pa.array([], pa.binary()), "weights": pa.array([], pa.binary()), "bias": pa.array([], pa.float64())})
        keys, weights, bias = train(toxic, others, held, prior)
        return pa.table({"keys": pa.array([keys.tobytes()], pa.binary()), "weights": pa.array([weights.tobytes()], pa.binary()), "bias": [bias]})

    rows = examples(docs, confirmed, id, text, positives, unlabelled, folds)
    fitted = rows.groupBy("fold").applyInArrow(learn, "keys binary, weights binary, bias double")
    return Model(sorted(fitted.collect(), key=lambda r: r.bias))


def scored(docs: DataFrame, model: Model, text: str = "text", least: float = CUT) -> DataFrame:
    """``docs`` without ``text`` and with score and predicted (1 from ``least`` on)."""
    others = [c for c in docs.columns if c not in {text, "score", "predicted"}]
    body = blocks.unused(docs.columns)
    rows = docs.select(*others, F.col(text).cast("binary").alias(body))
    schema = T.StructType([*[rows.schema[c] for c in others], *T.StructType.fromDDL("score double, predicted int").fields])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for b in batches for part in blocks.slices(b, blocks.byte_lengths(b.column(body)))):
            scores = np.array([model.score(x.as_py() or b"") for x in batch.column(body)], np.float64)
            yield pa.RecordBatch.from_arrays(
                [*batch.select(others).columns, pa.array(scores), pa.array((scores >= least).astype(np.int32))], schema.names
            )

    return rows.mapInArrow(work, schema)
