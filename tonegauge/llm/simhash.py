"""Near copies by SimHash: fingerprints that differ in few bits are linked, and linked documents form components.

Deletion-variant signatures: with at most ``distance`` differing bits, a 64-bit fingerprint is cut into so few segments that
in one of them two linked fingerprints differ by one bit at most (``distance // 2 + 1`` segments). A segment's variants have
one bit each replaced by a wildcard; two segments that differ by at most one bit share a variant. Variants are joined by
equality, as one sort of (segment, wildcard, rest), and every pair that meets is verified on all 64 bits.

Copies are folded first: the index holds each distinct fingerprint once, with its smallest id. Where many distinct fingerprints
meet under one variant, each is looked up by its own remaining bits instead of being compared with all others, and a
bucket reports a spanning set of links (at most one less than its members), never all pairs. Components come from rounds of
large-star and small-star on the links, cut by written tables.

Defined results: null and empty texts have fingerprint zero and are linked like any other; fewer words than the shingle length
are one shingle; A-Z are lower-cased and nothing else; repeated shingles count; rows whose id is null keep their fingerprint,
take part through it, and get its component; repeated ids are one id; an empty table gives no row; input columns (without the
text) are kept, result columns replace those of the same name.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tonegauge.llm import blocks
from tonegauge.llm.store import stored

SEED = 42
#: Members of a variant up to which all are compared in one array; larger variants are looked up by neighbours.
SMALL = 256


def fingerprint(text: bytes, shingle: int = 3) -> int:
    words = text.lower().split()
    if not words:
        return 0
    if len(words) <= shingle:
        parts = [b" ".join(words)]
    else:
        parts = map(b" ".join, zip(*[words[k:] for k in range(shingle)], strict=False))
    hashes = np.array([xxhash.xxh64_intdigest(p, SEED) for p in parts], ">u8")
    total, ones = len(hashes), np.zeros(64, np.int64)
    for first in range(0, total, 1 << 16):
        part = hashes[first : first + (1 << 16)]
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > total).tobytes(), "big")


def fingerprints(docs: DataFrame, text: str = "text", shingle: int = 3) -> DataFrame:
    """``docs`` without ``text`` and with ``fp`` (the fingerprint as a signed 64-bit number)."""
    others = [c for c in docs.columns if c not in {text, "fp"}]
    body = blocks.unused(docs.columns)
    rows = docs.select(*others, F.col(text).cast("binary").alias(body))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for b in batches for part in blocks.slices(b, blocks.byte_lengths(b.column(body)))):
            found = [fingerprint(x.as_py() or b"", shingle) for x in batch.column(body)]
            signed = pa.array(np.array(found, np.uint64).view(np.int64))
            yield pa.RecordBatch.from_arrays([*batch.select(others).columns, signed], [*others, "fp"])

    return rows.mapInArrow(work, T.StructType([*[rows.schema[c] for c in others], T.StructField("fp", T.LongType())]))


def segments(distance: int) -> list[tuple[int, int]]:
    """(first bit, width) of so few segments that one of them has at most one of ``distance`` differing bits."""
    count = distance // 2 + 1
    edges = [64 * k // count for k in range(count + 1)]
    return [(a, b - a) for a, b in zip(edges, edges[1:], strict=False)]


def variants(distance: int) -> list[tuple[int, int]]:
    """(bits compared, tag) of every segment and wildcard."""
    return [(((1 << width) - 1) << first & ~(1 << (first + wild)), 64 * k + wild) for k, (first, width) in enumerate(segments(distance)) for wild in range(width)]


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.bitwise_count(a ^ b)


def links_of(members: np.ndarray, free: int, distance: int) -> list[tuple[int, int]]:
    """Index pairs that span the components of one variant's distinct fingerprints (uint64). They agree but in ``free`` bits."""
    n = len(members)
    parent = list(range(n))

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    links = []

    def link(a: int, b: int) -> None:
        x, y = root(a), root(b)
        if x != y:
            parent[max(x, y)] = min(x, y)
            links.append((a, b))

    if n <= SMALL:
        near = np.argwhere(np.triu(distances(members[:, None], members[None, :]) <= distance, 1))
        for a, b in near.tolist():
            link(a, b)
        return links
    order = np.argsort(members)
    ranked = members[order]
    flips = [np.uint64(1 << k) for k in range(64) if free >> k & 1]
    masks = set(flips)
    for _ in range(distance - 1):
        masks |= {m ^ f for m in masks for f in flips} - {np.uint64(0)}
    for mask in masks:
        other = ranked ^ mask
        at = np.minimum(np.searchsorted(ranked, other), n - 1)
        for a in np.flatnonzero((ranked[at] == other) & (ranked < other)).tolist():
            link(int(order[a]), int(order[at[a]]))
    return links


def meet(batches: Iterator[pa.RecordBatch], distance: int) -> Iterator[pa.RecordBatch]:
    """Links (a, b) between fingerprints from rows sorted by variant; a variant may go on in the next batch."""
    by_tag = {tag: mask for mask, tag in variants(distance)}
    rest_tags, rest_keys, rest_fps = np.zeros(0, np.int32), np.zeros(0, np.int64), np.zeros(0, np.uint64)

    def pairs(tags: np.ndarray, keys: np.ndarray, fps: np.ndarray) -> pa.RecordBatch:
        new = np.flatnonzero((np.diff(tags) != 0) | (np.diff(keys) != 0)) + 1
        starts = np.concatenate([[0], new]) if len(tags) else np.zeros(0, np.int64)
        sizes = np.diff(np.append(starts, len(tags)))
        a, b = [], []
        two = starts[sizes == 2]
        near = two[distances(fps[two], fps[two + 1]) <= distance]
        a += fps[near].tolist()
        b += fps[near + 1].tolist()
        for start, size in zip(starts[sizes > 2].tolist(), sizes[sizes > 2].tolist(), strict=True):
            members = fps[start : start + size]
            for x, y in links_of(members, ~by_tag[int(tags[start])] & (1 << 64) - 1, distance):
                a.append(int(members[x]))
                b.append(int(members[y]))
        return pa.RecordBatch.from_arrays([pa.array(np.array(x, np.uint64).view(np.int64)) for x in (a, b)], ["a", "b"])

    for batch in batches:
        tags = np.concatenate([rest_tags, batch.column("tag").to_numpy(zero_copy_only=False)])
        keys = np.concatenate([rest_keys, batch.column("key").to_numpy(zero_copy_only=False)])
        fps = np.concatenate([rest_fps, batch.column("fp").to_numpy(zero_copy_only=False).view(np.uint64)])
        if not len(tags):
            continue
        last = len(tags) - 1
        open_from = int(np.flatnonzero((tags != tags[last]) | (keys != keys[last]))[-1]) + 1 if (tags[0], keys[0]) != (tags[last], keys[last]) else 0
        yield pairs(tags[:open_from], keys[:open_from], fps[:open_from])
        rest_tags, rest_keys, rest_fps = tags[open_from:], keys[open_from:], fps[open_from:]
    yield pairs(rest_tags, rest_keys, rest_fps)


def near_links(distinct: DataFrame, distance: int) -> DataFrame:
    """Links (a, b) that connect the distinct ``fp`` values whose bits differ in ``distance`` places at most."""
    tagged = F.array(*[F.struct(F.lit(tag).alias("tag"), F.lit(mask - (1 << 64) if mask >> 63 else mask).alias("mask")) for mask, tag in variants(distance)])
    keyed = (
        distinct.select("fp", F.explode(tagged).alias("v"))
        .select("fp", F.col("v.tag").alias("tag"), F.col("fp").bitwiseAND(F.col("v.mask")).alias("key"))
    )
    parts = int(distinct.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = keyed.repartition(parts, "tag", "key").sortWithinPartitions("tag", "key")
    return dealt.mapInArrow(lambda batches: meet(batches, distance), "a bigint, b bigint").distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of the links (a, b), root being the smallest node of its component.

    Alternating large-star and small-star rounds: a node's larger neighbours, then its smaller ones, move to the smallest
    neighbour. Both are a grouped minimum and a join, so a node with very many neighbours is only a large group of partial
    minima; links are folded (distinct) after each step.
    """
    spark = links.sparkSession
    links = stored(links.filter(F.col("a") != F.col("b")).select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    while True:
        # large star: every neighbour above u goes to the smallest of u and its neighbours
        both = links.unionAll(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least("u", F.min("v")).alias("m"))
        large = both.join(least, "u").filter(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        # small star: every smaller neighbour of u, and u, go to the smallest
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct("u", F.col("m").alias("v")))).alias("x"))
        new = stored(small.select("x.u", "x.v").filter(F.col("u") != F.col("v")).distinct())
        # done when every node has one neighbour, and no neighbour has one itself
        state = new.groupBy("u").agg(F.count("*").alias("n")).agg(F.max("n")).first()[0]
        chained = new.join(new.select(F.col("u").alias("v")).distinct(), "v", "left_semi").limit(1).count()
        links = new
        if (state is None or state == 1) and not chained:
            break
    return links.select(F.col("u").alias("node"), F.col("v").alias("root")).unionAll(links.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())


def near_duplicates(docs: DataFrame, id: str = "doc_id", text: str = "text", shingle: int = 3, distance: int = 2) -> DataFrame:
    """``docs`` without ``text`` and with ``fingerprint`` (16 hexadecimal digits) and ``component_id``, the smallest id that
    links lead to, its own included."""
    docs = docs.drop("fingerprint", "component_id")
    # columns of the rows take other names in between, as some are called like those worked out here
    others = [c for c in docs.columns if c != text]
    plain = docs.select(*[F.col(c).alias(f"c{k}_") for k, c in enumerate(others)], F.col(text).alias("text"))
    id = f"c{others.index(id)}_"
    marked = stored(fingerprints(plain, "text", shingle))
    # the smallest id stands for each fingerprint; copies go no further
    distinct = stored(marked.groupBy("fp").agg(F.min(id).alias("first_id")))
    links = near_links(distinct.select("fp"), distance)
    # components over fingerprints, then the smallest id in each
    found = stored(components(links))
    rooted = distinct.join(found, distinct["fp"] == found["node"], "left").select("fp", "first_id", F.coalesce("root", "fp").alias("root"))
    least = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    labels = rooted.join(least, "root").select("fp", "component_id")
    hexed = F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint")
    return marked.join(labels, "fp").select(*[F.col(f"c{k}_").alias(c) for k, c in enumerate(others)], hexed, "component_id")


