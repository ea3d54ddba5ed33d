"""A random forest fitted on sparse vectors, level by level, from counts over their non-zero entries.

Spark's own trainer holds a number for every place of the vector in every row: 400 kB a row for 100 000 features, nearly
all of them zeros. Here a row costs its non-zero entries. The method is the same: rows drawn with Poisson counts, features
cut into bins by a sample of rows, in every node the best Gini gain among the square root of all features, equal leaves
merged. Draws come from hashes, so a forest does not depend on how its rows are laid out; rows equal in every column share them.
"""

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.linalg import Vectors
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tonegauge.operators import model_tables
from tonegauge.sources import storage

#: Settings that a fit here follows.
SETTINGS = {"numTrees", "maxDepth", "maxBins", "seed", "minInstancesPerNode", "minInfoGain", "labelCol", "featuresCol"}

#: Bytes of numbers, over all rows, up to which Spark's own trainer makes the forest, of every setting.
DENSE = 1 << 28

#: Rows of a block; a task works on one block at a time.
BLOCK = 4096

#: Rows from which bins are worked out, as many as Spark's trainer takes.
SAMPLE = 10_000


@dataclass
class Trees:
    """Nodes of all trees by number: the roots first, children after their parents. ``cut`` is the last bin that goes low."""

    classes: int
    tree: list[int] = field(default_factory=list)
    counts: list[list[int]] = field(default_factory=list)
    feature: list[int] = field(default_factory=list)
    cut: list[int] = field(default_factory=list)
    low: list[int] = field(default_factory=list)
    threshold: list[float] = field(default_factory=list)
    gain: list[float] = field(default_factory=list)

    def add(self, tree: int, counts: list[int]) -> int:
        for values, value in [(self.tree, tree), (self.counts, counts), (self.feature, -1), (self.cut, -1), (self.low, -1),
                              (self.threshold, 0.0), (self.gain, -1.0)]:
            values.append(value)
        return len(self.tree) - 1

    def mixed(self, node: int) -> bool:
        return sum(n > 0 for n in self.counts[node]) > 1

    def split(self, node: int, feature: int, cut: int, threshold: float, gain: float, low: list[int]) -> list[int]:
        """The two children; the high one has the number after the low one's."""
        high = [n - m for n, m in zip(self.counts[node], low)]
        children = [self.add(self.tree[node], counts) for counts in (low, high)]
        self.feature[node], self.cut[node], self.threshold[node] = feature, cut, threshold
        self.gain[node], self.low[node] = gain, children[0]
        return children

    def prediction(self, node: int) -> int:
        return self.counts[node].index(max(self.counts[node]))

    def merge(self) -> None:
        """A node whose children are leaves of one prediction becomes a leaf."""
        for node in reversed(range(len(self.tree))):
            low = self.low[node]
            if low >= 0 and self.low[low] < 0 and self.low[low + 1] < 0 and self.prediction(low) == self.prediction(low + 1):
                self.low[node], self.gain[node] = -1, -1.0

    def rows(self) -> list[tuple]:
        """treeID and nodeData as Spark saves them; a tree's nodes are numbered in its order."""
        kept, places, sizes = [], {}, {}
        reached = {node for node, tree in enumerate(self.tree) if node == self.tree[node]}
        for node, low in enumerate(self.low):
            if node in reached:
                reached.update({low, low + 1} if low >= 0 else ())
                places[node] = sizes.get(self.tree[node], 0)
                sizes[self.tree[node]] = places[node] + 1
                kept.append(node)
        made = []
        for node in kept:
            low, counts, n = self.low[node], self.counts[node], sum(self.counts[node])
            impurity = 1.0 - sum((c / n) ** 2 for c in counts) if n else 0.0
            children = (places[low], places[low + 1]) if low >= 0 else (-1, -1)
            split = (self.feature[node], [self.threshold[node]], -1) if low >= 0 else (-1, [], -1)
            made.append((self.tree[node], (
                places[node], float(self.prediction(node)), impurity, [float(c) for c in counts], n, self.gain[node], *children, split)))
        return made


def _thresholds(rows: DataFrame, share: float, bins: int) -> DataFrame:
    """feature, cuts: where the values of a feature are divided, zeros counted too; features of one value have none.

    All middles between values, if they are few, else those nearest to equal numbers of rows.
    """
    sample = storage.stored(rows.filter(F.pmod("_hash", F.lit(1 << 30)) < round(share * (1 << 30))), "forest-sample")
    size = sample.count()
    each = model_tables.entries(sample, "_hash", "_v").filter(F.col("feature") != model_tables.BIAS)
    counted = each.groupBy("feature", "value").agg(F.count(F.lit(1)).alias("n"))
    values = counted.groupBy("feature").agg(
        F.collect_list(F.struct("value", "n")).alias("seen"), (F.lit(size) - F.sum("n")).alias("zeros"))
    zero = F.array(F.struct(F.lit(0.0).alias("value"), F.col("zeros").alias("n")))
    seen = F.array_sort(F.when(F.col("zeros") > 0, F.concat("seen", zero)).otherwise(F.col("seen")))
    few, stride = F.size("seen") <= bins, F.lit(size / bins)

    def step(a: Column, e: Column) -> Column:
        nearer = F.abs(a["n"] - a["goal"]) < F.abs(a["n"] + e["n"] - a["goal"])
        cut = a["last"].isNotNull() & (F.col("few") | nearer)
        middle = F.array((a["last"] + e["value"]) / 2)
        return F.struct(
            (a["n"] + e["n"]).alias("n"), F.when(cut, a["goal"] + stride).otherwise(a["goal"]).alias("goal"),
            e["value"].alias("last"), F.when(cut, F.concat(a["cuts"], middle)).otherwise(a["cuts"]).alias("cuts"))

    start = F.struct(
        F.lit(0).cast("bigint").alias("n"), stride.alias("goal"), F.lit(None).cast("double").alias("last"),
        F.array().cast("array<double>").alias("cuts"))
    found = values.withColumn("seen", seen).withColumn("few", few)
    return found.select("feature", F.aggregate("seen", start, step, lambda a: a["cuts"]).alias("cuts"))


def _table_of_cuts(found: DataFrame, size: int, bins: int) -> np.ndarray:
    """A row of cuts for each feature, filled up with infinity: at most features times bins numbers, whatever the rows."""
    rows = found.select("feature", F.posexplode("cuts").alias("k", "cut")).toArrow()
    table = np.full((size, bins - 1), np.inf)
    table[rows["feature"].to_numpy(), rows["k"].to_numpy()] = rows["cut"].to_numpy()
    return table[:, :max(1, int(np.isfinite(table).any(axis=0).sum()))]


def _drawn(hashes: np.ndarray, trees: int) -> np.ndarray:
    """How often each tree takes each row: Poisson counts of mean 1 from a hash of the row."""
    mixed = hashes.view(np.uint64)[:, None] + np.arange(1, trees + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    for shift, factor in [(30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)]:
        mixed = (mixed ^ (mixed >> np.uint64(shift))) * np.uint64(factor)
    chance = ((mixed ^ (mixed >> np.uint64(31))) >> np.uint64(11)) * 2.0 ** -53
    return np.searchsorted(np.cumsum([math.exp(-1) / math.factorial(k) for k in range(18)]), chance, side="right").astype(np.uint8)


BLOCKS = "features binary, rows binary, bins binary, labels binary, draws binary"


def _blocks(cuts, trees: int) -> Callable:
    """Rows as blocks: entries by feature with their bin, without those in the bin of zero, and the rows' labels and draws."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = cuts.value
        zero = (table < 0).sum(axis=1)
        for batch in batches:
            for start in range(0, batch.num_rows, BLOCK):
                part = batch.slice(start, BLOCK)
                hashes, labels = (part.column(c).to_numpy() for c in ("_hash", "_label"))
                lists, values = part.column("places"), part.column("values").flatten().to_numpy()
                feature = lists.flatten().to_numpy()
                row = np.repeat(np.arange(len(lists)), lists.value_lengths().to_numpy()).astype(np.int16)
                if not np.isfinite(values).all():
                    raise ValueError("features hold a value that is no finite number")
                bins, above, k = np.zeros(len(values), np.int64), np.arange(len(values)), 0
                while len(above) and k < table.shape[1]:
                    above = above[values[above] > table[feature[above], k]]
                    bins[above] += 1
                    k += 1
                told = np.flatnonzero(bins != zero[feature])
                told = told[np.argsort(feature[told], kind="stable")]
                yield pa.RecordBatch.from_pydict({
                    "features": [feature[told].astype(np.int32).tobytes()], "rows": [row[told].tobytes()],
                    "bins": [bins[told].astype(np.int32).tobytes()], "labels": [labels.astype(np.int32).tobytes()],
                    "draws": [_drawn(hashes, trees).tobytes()],
                })

    return run


def _each(batches: Iterator[pa.RecordBatch]) -> Iterator[dict[str, pa.Buffer]]:
    """One block after another, not copied."""
    for batch in batches:
        for k in range(batch.num_rows):
            yield {name: batch.column(name)[k].as_buffer() for name in batch.schema.names}


def _tally(size: int, classes: int, seed: int, zero: np.ndarray, trees: Trees, active: list[int]) -> Callable:
    """Counts by node, feature and bin over the rows of a block, for the features drawn in each active node."""
    wanted = math.ceil(math.sqrt(size))
    tree, feature_of, cut_of, low_of = (np.array(x) for x in (trees.tree, trees.feature, trees.cut, trees.low))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        drawn = {}
        for node in active:
            own = np.random.default_rng([seed, node]).choice(size, wanted, replace=False)
            drawn.setdefault(int(tree[node]), []).append((own, np.full(wanted, node)))
        pairs = {t: [np.concatenate(x) for x in zip(*lists)] for t, lists in drawn.items()}
        for block in _each(batches):
            feature, bins, label = (np.frombuffer(block[c], np.int32) for c in ("features", "bins", "labels"))
            row = np.frombuffer(block["rows"], np.int16)
            draws = np.frombuffer(block["draws"], np.uint8).reshape(len(label), -1)
            key = feature.astype(np.int64) * BLOCK + row
            first = np.searchsorted(feature, np.arange(size + 1))
            for t, (features, nodes) in pairs.items():
                place = _places(t, draws[:, t], key, bins, zero, feature_of, cut_of, low_of)
                n = first[features + 1] - first[features]
                at = np.repeat(first[features] - np.cumsum(n) + n, n) + np.arange(n.sum())
                whose = np.repeat(nodes, n)
                hit = place[row[at]] == whose
                at, whose = at[hit], whose[hit]
                groups, index = np.unique((whose * size + feature[at]) * (1 << 16) + bins[at], return_inverse=True)
                counts = np.bincount(
                    index * classes + label[row[at]], draws[row[at], t], len(groups) * classes).reshape(-1, classes)
                places = groups >> 16
                yield pa.RecordBatch.from_pydict({
                    "node": places // size, "feature": places % size, "bin": groups % (1 << 16), "zero": zero[places % size],
                } | {f"n{c}": counts[:, c].astype(np.int64) for c in range(classes)})

    return run


def _places(t, draws, key, bins, zero, feature_of, cut_of, low_of) -> np.ndarray:
    """The node that each row of a block has reached in a tree; -1 for rows that the tree does not take."""
    place = np.where(draws > 0, t, -1)
    moving = np.flatnonzero(place >= 0)
    while len(moving := moving[low_of[place[moving]] >= 0]):
        node = place[moving]
        wanted = feature_of[node].astype(np.int64) * BLOCK + moving
        at = np.minimum(np.searchsorted(key, wanted), max(len(key) - 1, 0))
        there = key[at] == wanted if len(key) else np.zeros(len(moving), bool)
        bin_ = np.where(there, bins[at] if len(key) else 0, zero[feature_of[node]])
        place[moving] = low_of[node] + (bin_ > cut_of[node])
    return place


def _best(tallied: DataFrame, totals: DataFrame, classes: int, least: int, gain: float) -> DataFrame:
    """node, best (gain, minus feature, minus cut, counts of the low side) for nodes with a split that gains.

    Rows that a feature's counts lack are in its bin of zero. A split lies behind each bin in use: behind a bin below zero's,
    and in front of one above it.
    """
    names = [f"n{c}" for c in range(classes)]
    summed = tallied.groupBy("node", "feature", "zero", "bin").agg(*[F.sum(n).alias(n) for n in names])
    whole = W.partitionBy("node", "feature")
    upto = whole.orderBy("bin")
    above = F.col("bin") > F.col("zero")
    cut = F.when(above, F.greatest(F.lag("bin").over(upto), F.col("zero"))).otherwise(F.col("bin"))
    sides = summed.join(F.broadcast(totals), "node").select(
        "node", "feature", "t", cut.alias("cut"), above.alias("above"), *names,
        *[F.sum(n).over(upto).alias(f"upto_{n}") for n in names], *[F.sum(n).over(whole).alias(f"all_{n}") for n in names])
    low = F.array(*[
        F.col(f"upto_{n}") + F.when(F.col("above"), F.get("t", F.lit(c)) - F.col(f"all_{n}") - F.col(n)).otherwise(0)
        for c, n in enumerate(names)])
    high = F.zip_with("t", "low", lambda a, b: a - b)

    def total(column: str) -> Column:
        return F.aggregate(column, F.lit(0).cast("bigint"), lambda a, x: a + x)

    def impurity(column: str, n: Column) -> Column:
        return 1 - F.aggregate(column, F.lit(0.0), lambda a, x: a + F.pow(F.try_divide(x, n), F.lit(2)))

    scored = sides.select("node", "feature", "cut", "t", low.alias("low")).withColumn("high", high)
    scored = scored.select("*", total("low").alias("nl"), total("high").alias("nh"), total("t").alias("n"))
    gained = impurity("t", F.col("n")) - F.col("nl") / F.col("n") * impurity("low", F.col("nl")) - (
        F.col("nh") / F.col("n") * impurity("high", F.col("nh")))
    enough = (F.col("nl") >= least) & (F.col("nh") >= least)
    candidate = F.struct(F.when(enough, gained).alias("gain"), -F.col("feature"), -F.col("cut"), F.col("low"))
    best = scored.groupBy("node").agg(F.max(candidate).alias("best"))
    return best.filter((F.col("best.gain") > 0) & (F.col("best.gain") >= gain))


def _model(spark: SparkSession, estimator: RandomForestClassifier, size: int, trees: Trees) -> RandomForestClassificationModel:
    """The trees as Spark's model: saved in its form beside the settings of a fit on empty rows, and loaded."""
    label, vector = estimator.getLabelCol(), estimator.getFeaturesCol()
    # so many rows that no tree is without one
    empty = [(float(c), Vectors.sparse(size, [], [])) for c in range(trees.classes)] * 8
    path = storage.shared_dir(spark, "forest-model")
    estimator.fit(spark.createDataFrame(empty, [label, vector]).coalesce(1)).write().save(path)
    schema = spark.read.parquet(f"{path}/data").schema
    spark.createDataFrame(trees.rows(), schema).coalesce(1).write.mode("overwrite").parquet(f"{path}/data")
    return RandomForestClassificationModel.load(path)


def fit(df: DataFrame, estimator: RandomForestClassifier) -> RandomForestClassificationModel:
    """The forest of the estimator's numbers of trees, levels and bins, its seed, least rows and least gain; other settings
    keep their defaults. The driver holds the nodes and the cuts of features, as it does for Spark's trainer, which makes the
    forest itself where its numbers are few."""
    spark, seed, count = df.sparkSession, estimator.getSeed() % (1 << 63), estimator.getNumTrees()
    named = [F.col(c) for c in df.columns if "map<" not in df.schema[c].dataType.simpleString()]
    vector = model_tables._parts(estimator.getFeaturesCol())
    rows = df.select(
        F.xxhash64(F.lit(seed), *named).alias("_hash"), F.col(estimator.getLabelCol()).cast("double").alias("_label"),
        F.col(estimator.getFeaturesCol()).alias("_v"), vector.alias("_p"))
    length = F.when(F.col("_p.type") == 0, F.col("_p.size")).otherwise(F.size("_p.values"))
    usable = F.col("_label").between(0, 1e6) & (F.col("_label") == F.floor("_label")) & F.col("_p").isNotNull()
    n, good, classes, size, largest = rows.agg(
        F.count(F.lit(1)), F.count_if(usable), F.max("_label"), F.min(length), F.max(length)).first()
    if n * (largest or 0) * 4 <= DENSE:
        return estimator.fit(df)
    if not n or good < n or size < largest:
        raise ValueError(f"{n} rows, {good} of them with a label and features, {size} to {largest} features")
    classes, bins = int(classes) + 1, max(2, min(estimator.getMaxBins(), n))
    share = min(1.0, max(bins ** 2, SAMPLE) / n)
    table = _table_of_cuts(_thresholds(rows, share, bins), size, bins)
    zero = (table < 0).sum(axis=1)
    shared = spark.sparkContext.broadcast(table)
    places = F.when(F.col("_p.type") == 0, F.col("_p.indices")).otherwise(F.transform("_p.values", lambda _, i: i))
    listed = rows.select("_hash", "_label", places.alias("places"), F.col("_p.values").alias("values"))
    blocks = storage.stored(listed.mapInArrow(_blocks(shared, count), BLOCKS), "forest-blocks")
    shared.unpersist()

    def roots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in _each(batches):
            label = np.frombuffer(block["labels"], np.int32)
            drawn = np.frombuffer(block["draws"], np.uint8).reshape(len(label), count)
            sums = [drawn[label == c].sum(axis=0, dtype=np.int64) for c in range(classes)]
            yield pa.RecordBatch.from_pydict({"tree": np.arange(count)} | {f"n{c}": s for c, s in enumerate(sums)})

    per_class = ", ".join(f"n{c} bigint" for c in range(classes))
    first = blocks.select("labels", "draws").mapInArrow(roots, f"tree bigint, {per_class}")
    trees = Trees(classes)
    for tree, *counts in first.groupBy("tree").sum(*[f"n{c}" for c in range(classes)]).orderBy("tree").collect():
        trees.add(tree, counts)
    active = [node for node in range(count) if trees.mixed(node)]
    for _ in range(estimator.getMaxDepth()):
        if not active:
            break
        tally = _tally(size, classes, seed, zero, trees, active)
        tallied = blocks.mapInArrow(tally, f"node bigint, feature bigint, bin bigint, zero bigint, {per_class}")
        totals = spark.createDataFrame([(node, trees.counts[node]) for node in active], "node bigint, t array<bigint>")
        least, gain = estimator.getMinInstancesPerNode(), estimator.getMinInfoGain()
        best = _best(tallied, totals, classes, least, gain).orderBy("node").collect()
        active = []
        for node, (gained, minus_feature, minus_cut, low) in best:
            cut = table[-minus_feature, -minus_cut]
            active += trees.split(node, -minus_feature, -minus_cut, float(cut), gained, list(low))
        active = [node for node in active if trees.mixed(node)]
    trees.merge()
    return _model(spark, estimator, size, trees)
