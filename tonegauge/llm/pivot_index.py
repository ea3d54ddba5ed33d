"""Near-duplicate vectors by a pivot-permutation index.

1. Equal vectors are folded: the index holds each distinct vector once, with the number of its rows.
2. Reference points (pivots) come from a bounded sample of the distinct vectors, in hash order. A sample vector within a
   cosine of ``APART`` of a pivot is none itself: were a dense group full of pivots, the order of the nearest would be noise.
3. Each vector is described by its ``nearest`` pivots in order of distance, and posted to their inverted lists. Vectors are
   candidates of each other if they share ``shared`` pivots or more. Two sets of m pivots that share t of them share one of
   the m - t + 1 rarest of each, so a vector is posted to the lists of these only; nothing is lost by that.
4. A list is dealt into blocks of bounded size, and every two blocks of a list meet in a cell. In a cell, the lists of all
   pivots add up the shared-pivot counts of its vectors; a pair is judged in the list of the rarest pivot that both were posted
   to. Candidates are verified by their cosine in double precision.
5. A cell gives, for each vector, its number of linked rows and one link to the smallest vector of its group in the cell:
   never pairs. Links are added up and components found by star rounds.

The pivots make this an approximate search: a pair above the threshold is missed if it shares too few pivots (``recall`` of the
tests: against brute force). Tables of no more distinct vectors than ``nearest`` are compared whole.

Defined results: vectors that are null, zero, or hold null or non-finite components link with nothing; vectors of different
length link with nothing; equal vectors (rows of one id too) are linked rows; a row without an id counts as a row and gets the
component of its vector, and ``kept`` is false for it; an empty table gives no row; other input columns stay, result columns
replace those of the same name. What grows in one place: nothing beyond the pivots (at most ``PIVOTS`` vectors, on the driver
and in every task) and a cell (two blocks of ``CELL`` vectors).
"""

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tonegauge.llm import blocks, simhash
from tonegauge.llm.store import stored
from tonegauge.llm.top_k import usable

#: Vectors from which pivots are chosen, and pivots, at most.
SAMPLE = 8192
PIVOTS = 2048
#: Cosine from which a sample vector is too close to a pivot to be one.
APART = 0.6
NEAREST = 12
SHARED = 4
CELL = 2048
#: Copies of a small table's rows that a join spreads a frequent key over.
SALTS = 16
#: Cosines this near to the threshold are worked out again with exact sums, so that no order of summing decides.
DOUBT = 1e-9


def unit(rows: np.ndarray) -> np.ndarray:
    return rows / np.sqrt((rows * rows).sum(axis=1))[:, None]


def choose_pivots(sample: np.ndarray, most: int, apart: float = APART) -> np.ndarray:
    """Up to ``most`` of the sample's vectors, in its order, no two within a cosine of ``apart``; all vectors, if only few are
    that far apart."""
    rows = unit(sample)
    open_ = np.ones(len(rows), bool)
    chosen = []
    for k in range(len(rows)):
        if len(chosen) == most:
            break
        if open_[k]:
            chosen.append(k)
            open_[k + 1 :] &= rows[k + 1 :] @ rows[k] < apart
    if len(chosen) < min(most, 4 * NEAREST):
        others = np.setdiff1d(np.arange(len(rows)), chosen)
        chosen = [*chosen, *others[: min(most, 4 * NEAREST) - len(chosen)].tolist()]
    return rows[chosen]


def signatures(rows: np.ndarray, pivots: np.ndarray, nearest: int) -> np.ndarray:
    """The numbers of each row's nearest pivots, the nearest first; equally near ones by number."""
    near = unit(rows) @ pivots.T
    return np.argsort(-near, axis=1, kind="stable")[:, :nearest].astype(np.int32)


def exact_cosine(a: np.ndarray, b: np.ndarray) -> float:
    dot = math.fsum((a * b).tolist())
    return dot / math.sqrt(math.fsum((a * a).tolist()) * math.fsum((b * b).tolist()))


def shared_counts(one: np.ndarray, two: np.ndarray) -> np.ndarray:
    """How many pivots each row of ``one`` shares with each of ``two``: every pivot's list adds one to all that it joins."""
    counts = np.zeros((len(one), len(two)), np.uint8)
    order = [np.argsort(side.ravel(), kind="stable") for side in (one, two)]
    names = [side.ravel()[o] for side, o in zip((one, two), order, strict=True)]
    rows = [o // max(side.shape[1], 1) for side, o in zip((one, two), order, strict=True)]
    for pivot in np.intersect1d(*names):
        if pivot < 0:
            continue
        a, b = (r[np.searchsorted(n, pivot) : np.searchsorted(n, pivot, "right")] for r, n in zip(rows, names, strict=True))
        counts[np.ix_(a, b)] += 1
    return counts


def cell_links(one: dict, two: dict, same: bool, rank: int, shared: int, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs of two blocks that link. ``rank``: place of this list's pivot in the order of rarity; signatures hold such
    places in ascending order, posted ones first."""
    candidates = shared_counts(one["signature"], two["signature"]) >= shared
    # pairs that meet in the list of a rarer pivot are judged there
    earlier = [np.where(side["posted"] < rank, side["posted"], -1) for side in (one, two)]
    candidates &= shared_counts(*earlier) == 0
    if same:
        candidates &= np.triu(np.ones(candidates.shape, bool), 1)
    if not candidates.any():
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    cosine = (one["vector"] @ two["vector"].T) / (one["norm"][:, None] * two["norm"][None, :])
    near = candidates & (cosine >= threshold)
    for a, b in np.argwhere(candidates & (np.abs(cosine - threshold) < DOUBT)).tolist():
        near[a, b] = exact_cosine(one["vector"][a], two["vector"][b]) >= threshold
    a, b = np.nonzero(near)
    return a, b


def roots(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """The smallest index that links lead to, for each of ``n``."""
    root = np.arange(n)
    while True:
        least = root.copy()
        np.minimum.at(least, a, root[b])
        np.minimum.at(least, b, root[a])
        least = least[least]
        if np.array_equal(least, root):
            return root
        root = least


def join_spread(rows: DataFrame, few: DataFrame, key: str | list[str], by: str, how: str = "inner", salts: int = SALTS) -> DataFrame:
    """``rows`` joined with a table that has a key once, whose rows are copied so that a frequent key meets several of them.
    Rows are spread by a hash of ``by``, so a task that runs again spreads them alike."""
    salted = rows.withColumn("_salt_", F.pmod(F.xxhash64(by, F.lit("salt")), F.lit(salts)).cast("int"))
    copies = few.withColumn("_salt_", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return salted.join(copies, [*([key] if isinstance(key, str) else key), "_salt_"], how).drop("_salt_")


def signed(distinct: DataFrame, pivots: np.ndarray, nearest: int) -> DataFrame:
    """``distinct`` and ``signature``: its nearest pivots in order. Vectors of another length than the pivots get none."""
    width = pivots.shape[1] if len(pivots) else 0

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = np.asarray(batch.column("vector").flatten().to_numpy(zero_copy_only=False), float).reshape(batch.num_rows, width)
            found = signatures(rows, pivots, nearest)
            column = pa.ListArray.from_arrays(pa.array(np.arange(len(rows) + 1) * found.shape[1], pa.int32()), pa.array(found.ravel()))
            yield pa.RecordBatch.from_arrays([*batch.columns, column], [*batch.schema.names, "signature"])

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in distinct.schema.fields)
    return distinct.mapInArrow(work, f"{schema}, signature array<int>")


def cells(postings: DataFrame, cell: int) -> DataFrame:
    """Postings dealt to the cells of their list: (rank, low, high) with low <= high, and ``block``, which of both a row is."""
    sizes = postings.groupBy("rank").agg(F.count("*").alias("size"))
    sized = join_spread(postings, sizes.withColumn("n_blocks", F.ceil(F.col("size") / cell).cast("int")), "rank", "node")
    dealt = sized.withColumn("block", F.pmod(F.xxhash64("node"), F.col("n_blocks")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("n_blocks") - 1))
    return dealt.withColumn("other", other).select(
        "rank", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"), "block",
        "node", "vector", "rows", "signature",
    )


def linked(dealt: DataFrame, posted: int, shared: int, threshold: float) -> DataFrame:
    """(node, n_rows, root): in each cell, the linked rows of a vector and the smallest vector of its group there."""

    def judge(table: pa.Table) -> pa.Table:
        rank, low, high = (table.column(c)[0].as_py() for c in ("rank", "low", "high"))
        node = table.column("node").to_numpy()
        order = np.argsort(node, kind="stable")
        node, block = node[order], table.column("block").to_numpy()[order]
        rows = table.column("rows").to_numpy()[order]
        lists = {c: table.column(c).combine_chunks() for c in ("vector", "signature")}
        vector = np.asarray(lists["vector"].flatten().to_numpy(zero_copy_only=False), float).reshape(len(node), -1)[order]
        signature = lists["signature"].flatten().to_numpy(zero_copy_only=False).reshape(len(node), -1)[order]
        sides = []
        for number in (low, high):
            at = np.flatnonzero(block == number)
            part = {"at": at, "vector": vector[at], "signature": signature[at], "posted": signature[at][:, :posted]}
            sides.append(part | {"norm": np.sqrt((part["vector"] ** 2).sum(axis=1))})
        a, b = cell_links(*sides, low == high, rank, shared, threshold)
        a, b = sides[0]["at"][a], sides[1]["at"][b]
        count = np.bincount(a, rows[b], len(node)) + np.bincount(b, rows[a], len(node))
        some = np.flatnonzero(count)
        return pa.table({
            "node": pa.array(node[some]), "n_rows": pa.array(count[some].astype(np.int64)), "root": pa.array(node[roots(a, b, len(node))[some]]),
        })

    return dealt.groupBy("rank", "low", "high").applyInArrow(judge, "node bigint, n_rows bigint, root bigint")


def direction(vector: Column) -> Column:
    """The vector in double precision, or null where it takes no part. Negative zeros become zeros."""
    wide = F.transform(vector, lambda x: x.cast("double") + F.lit(0.0))
    return F.when(usable(vector) & F.exists(vector, lambda x: x != 0), wide)


def names(vector: Column) -> list[Column]:
    """Two 64-bit hashes by which a row finds the labels of its vector; null without a vector. Vectors themselves are compared
    where they are folded."""
    return [F.when(vector.isNotNull(), F.xxhash64(F.lit(k), vector)).alias(f"_name{k}_") for k in (1, 2)]


def near_duplicates(
    rows: DataFrame, id: str = "vec_id", vector: str = "embedding", threshold: float = 0.95, nearest: int = NEAREST, shared: int = SHARED,
    cell: int = CELL,
) -> DataFrame:
    """``rows`` without ``vector``, and ``n_links`` (other rows linked directly), ``component_id`` (smallest id that links lead to,
    its own included) and ``kept`` (the row has that id)."""
    others = [c for c in rows.columns if c not in {vector, "n_links", "component_id", "kept"}]
    body = blocks.unused(rows.columns)
    whole = rows.select(*others, direction(F.col(vector)).alias(body))
    folded = whole.filter(F.col(body).isNotNull()).groupBy(F.col(body).alias("vector")).agg(
        F.count("*").alias("rows"), F.min(F.col(id).cast("bigint")).alias("first_id")
    )
    distinct = stored(folded.withColumn("node", F.monotonically_increasing_id()))

    found = []  # every length of vectors is a table of its own; there are few
    for width, n in sorted(distinct.groupBy(F.size("vector").alias("w")).count().collect()):
        part = distinct.filter(F.size("vector") == width).select("node", "vector", "rows")
        most = min(PIVOTS, max(4 * nearest, 4 * math.isqrt(n)))
        sample = part.select("vector").orderBy(F.xxhash64("vector"), "vector").limit(SAMPLE).toArrow().column("vector")
        sample = np.asarray(sample.combine_chunks().flatten().to_numpy(zero_copy_only=False), float).reshape(-1, width)
        found.append(links_of(part, choose_pivots(sample, most), min(nearest, n), shared, threshold, cell))
    distinct = distinct.select("node", "rows", "first_id", *names(F.col("vector")))
    if found:
        links = found[0]
        for more in found[1:]:
            links = links.unionAll(more)
        links = stored(links)
        counts = links.groupBy("node").agg(F.sum("n_rows").alias("n_rows"))
        rooted = stored(simhash.components(links.select(F.col("node").alias("a"), F.col("root").alias("b"))))
        grouped = distinct.join(rooted, "node", "left").withColumn("root", F.coalesce("root", "node"))
        first = grouped.groupBy("root").agg(F.min("first_id").alias("component_id"))
        labels = join_spread(grouped, first, "root", "node").join(counts, "node", "left").select(
            "_name1_", "_name2_", (F.col("rows") - 1 + F.coalesce("n_rows", F.lit(0))).alias("n_links"), "component_id"
        )
    else:
        labels = distinct.select("_name1_", "_name2_", F.lit(0).cast("bigint").alias("n_links"), F.col("first_id").alias("component_id"))
    own = F.col(id).cast("bigint")
    component = F.when(F.col("_name1_").isNull(), own).otherwise(F.col("component_id"))
    named = whole.select(*others, *names(F.col(body)))
    return join_spread(named, labels, ["_name1_", "_name2_"], id, "left").select(
        *others, F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"), component.alias("component_id"),
        F.coalesce(component == own, F.lit(False)).alias("kept"),
    )


def links_of(distinct: DataFrame, pivots: np.ndarray, nearest: int, shared: int, threshold: float, cell: int) -> DataFrame:
    """(node, n_rows, root) of the cells of all inverted lists of (node, vector, rows)."""
    nearest = min(nearest, len(pivots))
    shared = min(shared, nearest)
    posted = nearest - shared + 1
    marked = stored(signed(distinct, pivots, nearest))
    # pivots in order of rarity: as many rows as pivots, which are bounded
    counts = dict(marked.select(F.explode("signature").alias("pivot")).groupBy("pivot").count().collect())
    rank = np.zeros(max(len(pivots), 1), np.int32)
    rank[sorted(counts, key=lambda p: (counts[p], p))] = np.arange(len(counts))
    ranks = F.array(*[F.lit(int(r)) for r in rank]) if len(rank) <= 64 else F.from_json(F.lit(str(rank.tolist())), "array<int>")
    by_rarity = F.array_sort(F.transform("signature", lambda p: F.get(ranks, p)))
    ranked = marked.select("node", "vector", "rows", by_rarity.alias("signature"))
    postings = ranked.withColumn("rank", F.explode(F.slice("signature", 1, posted)))
    return linked(cells(postings, cell), posted, shared, threshold)
