"""Removal of byte strings that occur more than once, by a difference-cover suffix index built bucket by bucket.

Every byte covered by a ``length``-byte string that also starts at another place of the table is removed; both places may lie
in one document, but no string crosses from one document to the next.

1. Cover sample. D is a difference cover modulo v: for any two places i, j there is a d < v with (i + d) mod v and
   (j + d) mod v both in D. Places of D are the sample. Two equal strings of ``length`` bytes therefore share a pair of sample
   places whose next ``length - v + 1`` bytes agree. These windows are named by fingerprints, the names are sorted one bucket
   at a time, and a sample place whose rank no other shares is resolved: no tie runs through it.
2. Suffixes. Only places with a sample place of shared rank in their next v bytes can tie over the whole length; these long
   ties are what the ranks leave over. Their ``length``-byte prefixes are sorted, again one bucket at a time, and equal
   neighbours are repeats.

Order inside a bucket is that of 64-bit fingerprints, not of bytes: equality is all the removal needs, and no suffix text is
moved. A bucket task holds the keys of one bucket; a block sends each key once, so a passage that half the corpus shares is
one key per block.

Passages can also be given as a number of words (``words``): whatever a string of so many words covers that also starts at another
word is removed too, white space between words aside. Its windows run over words in place of bytes, with a cover of their own,
and their names and keys travel with those of the bytes.

The number of buckets follows from the bytes of the table (``BUCKET_BYTES`` each), so a bucket does not grow with the table.

Defined results: null text is empty; texts shorter than ``length`` are never cut; copies of one row (same id or not) are
repeats of each other; an empty table gives an empty result; result columns replace input columns of the same name, all
others are kept. Places are bytes, so a cut can fall inside a character; ``kept`` is therefore binary.
"""

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tonegauge.llm import blocks
from tonegauge.llm.store import stored

SEGMENT = 1 << 16
MASK = (1 << 64) - 1
#: Sample names need not be exact, as the second step decides; so many bits beyond those that number the sample places.
SPARE_BITS = 12
#: Text whose places share a bucket: at most so many keys are sorted at once, times the share of places that tie.
BUCKET_BYTES = 24 << 20


def cover(length: int) -> tuple[int, list[int]]:
    """The period v and the residues D of Colbourn and Ling's cover, v at most half the length; v = 1 for short lengths."""
    r = -1
    while 24 * (r + 1) ** 2 + 36 * (r + 1) + 13 <= length // 2:
        r += 1
    if r < 0:
        return 1, [0]
    steps = [1] * r + [r + 1] + [2 * r + 1] * r + [4 * r + 3] * (2 * r + 1) + [2 * r + 2] * (r + 1) + [1] * r
    return 24 * r * r + 36 * r + 13, [0, *np.cumsum(steps).tolist()]


class Windows:
    """Fingerprints of fixed-length windows: two polynomial hashes modulo 2^64 with random values for bytes, mixed."""

    def __init__(self, length: int):
        self.length = length
        rng = np.random.default_rng(400)
        self.sides = []
        for _ in range(2):
            values = rng.integers(0, MASK, 256, dtype=np.uint64, endpoint=True)
            base = int(rng.integers(0, MASK, dtype=np.uint64)) | 5
            back = pow(base, -1, 1 << 64)
            n = SEGMENT + length
            self.sides.append((values, self.powers(base, n), self.powers(back, n)))

    @staticmethod
    def powers(base: int, n: int) -> np.ndarray:
        out = np.full(n, base, np.uint64)
        out[0] = 1
        return np.multiply.accumulate(out)

    def weigh(self, values: np.ndarray, piece: np.ndarray) -> np.ndarray:
        return values[piece]

    def at(self, text: np.ndarray, places: np.ndarray) -> np.ndarray:
        """Keys of the windows that start at these ascending places; every window lies inside the text."""
        out = np.empty(len(places), np.uint64)
        edges = np.searchsorted(places, np.arange(0, len(text) + SEGMENT, SEGMENT))
        for k, (a, b) in enumerate(zip(edges, edges[1:], strict=False)):
            if a == b:
                continue
            first = k * SEGMENT
            piece, here = text[first : first + SEGMENT + self.length], places[a:b] - first
            mixed = np.zeros(b - a, np.uint64)
            for values, powers, back in self.sides:
                sums = np.zeros(len(piece) + 1, np.uint64)
                np.cumsum(self.weigh(values, piece) * powers[: len(piece)], out=sums[1:])
                key = (sums[here + self.length] - sums[here]) * back[here]
                key ^= key >> np.uint64(32)
                key *= np.uint64(0x9E3779B97F4A7C15)
                mixed = (mixed ^ key) * np.uint64(0xD6E8FEB86659FD93)
                mixed ^= mixed >> np.uint64(29)
            out[a:b] = mixed
        return out


class WordWindows(Windows):
    """The same for windows of words, each given as a 64-bit hash."""

    def weigh(self, values: np.ndarray, piece: np.ndarray) -> np.ndarray:
        mixed = (piece ^ values[0]) * (values[1] | np.uint64(1))
        return mixed ^ (mixed >> np.uint64(32))


def words_of(text: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and hash of every word, and where each document's words begin. A word ends with its document."""
    inside = (text != 32) & ((text < 9) | (text > 13))
    change = np.empty(len(text) + 1, bool)
    change[:-1] = inside
    change[-1] = False
    opens = inside.copy()
    opens[1:] &= ~inside[:-1]
    first = edges[:-1][edges[:-1] < len(text)]
    opens[first] = inside[first]
    starts = np.flatnonzero(opens)
    closes = inside & ~change[1:]
    last = edges[1:][edges[1:] > 0] - 1
    closes[last] |= inside[last]
    ends = np.flatnonzero(closes) + 1
    rng = np.random.default_rng(51)
    values = rng.integers(0, MASK, 256, dtype=np.uint64, endpoint=True)
    powers = Windows.powers(int(rng.integers(0, MASK, dtype=np.uint64)) | 5, 1 << 12)
    hashes = np.zeros(len(starts), np.uint64)
    for a in range(0, len(starts), SEGMENT):
        begin, stop = starts[a : a + SEGMENT], ends[a : a + SEGMENT]
        piece = text[begin[0] : stop[-1]]
        place = np.arange(len(piece)) - np.repeat(begin - begin[0], np.diff(np.append(begin, stop[-1])))
        weighed = np.where(inside[begin[0] : stop[-1]], values[piece] * powers[place & 4095] + (place >> 12).astype(np.uint64), np.uint64(0))
        part = np.add.reduceat(weighed, begin - begin[0])
        part ^= part >> np.uint64(29)
        hashes[a : a + SEGMENT] = part * np.uint64(0xBF58476D1CE4E5B9) + (stop - begin).astype(np.uint64)
    return starts, ends, hashes, np.searchsorted(starts, edges)


class Cover:
    """Windows of ``length`` items (bytes or words) of one kind: which are sampled, and which can tie."""

    def __init__(self, length: int, windows: type[Windows]):
        self.length = length
        self.period, residues = cover(length)
        self.share = len(residues) / self.period
        self.pattern = np.array(residues)
        self.short = windows(length - self.period + 1)
        self.full = windows(length)

    def sample(self, items: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sample places with a whole window in their document, and the fingerprints of these windows."""
        found = []
        for start, end in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
            last = end - start - self.short.length
            if last >= 0:
                places = (np.arange(0, last + 1, self.period)[:, None] + self.pattern).ravel()
                found.append(start + places[: np.searchsorted(places, last, "right")])
        places = np.concatenate(found) if found else np.zeros(0, np.int64)
        return places, self.short.at(items, places)

    def ties(self, items: np.ndarray, edges: np.ndarray, hits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places whose next ``period`` items hold one of the sample places ``hits``, and their keys."""
        near = np.zeros(len(items) + 1, np.int32)
        np.add.at(near, np.maximum(hits - self.period + 1, 0), 1)
        np.add.at(near, hits + 1, -1)
        tied = np.cumsum(near[:-1]) > 0
        # the last length - 1 items of a document start no window
        for start, end in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
            tied[max(start, end - self.length + 1) : end] = False
        tied = np.flatnonzero(tied)
        return tied, self.full.at(items, tied)


class Index:
    """What one block works out for itself; every pass over a block repeats it in the same order."""

    def __init__(self, length: int, words: int | None, buckets: int, bits: int):
        self.length, self.buckets, self.bits = length, buckets, bits
        self.covers = [Cover(length, Windows), *([Cover(words, WordWindows)] if words else [])]

    def load(self, text: np.ndarray, edges: np.ndarray) -> None:
        """The block whose questions follow, as items of each kind."""
        self.kinds = [(text, edges)]
        if len(self.covers) > 1:
            self.starts, self.ends, hashes, word_edges = words_of(text, edges)
            self.kinds.append((hashes, word_edges))

    def samples(self) -> list[tuple[np.ndarray, np.ndarray]]:
        found = [c.sample(*kind) for c, kind in zip(self.covers, self.kinds, strict=True)]
        return [(places, keys >> np.uint64(64 - self.bits)) for places, keys in found]

    def ties(self, replies: list[bytes]) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each kind, the places that a shared sample rank leaves open, and their keys."""
        found = self.samples()
        shared = self.answers([names for _, names in found], replies, self.bits)
        return [
            c.ties(*kind, places[hit]) for c, kind, (places, _), hit in zip(self.covers, self.kinds, found, shared, strict=True)
        ]

    def answers(self, keys: list[np.ndarray], replies: list[bytes], bits: int) -> list[np.ndarray]:
        distinct, back = np.unique(np.concatenate(keys), return_inverse=True)
        shared = blocks.bits_of(replies, distinct, self.buckets, bits)[back] if len(distinct) else np.zeros(0, bool)
        return np.split(shared, np.cumsum([len(k) for k in keys])[:-1])

    def ask(self, block: int, keys: list[np.ndarray], bits: int) -> pa.RecordBatch:
        distinct, counts = np.unique(np.concatenate(keys), return_counts=True)
        twice = counts > 1
        return blocks.questions(block, distinct, lambda a, b: np.packbits(twice[a:b]).tobytes(), self.buckets, bits)


def remove_repeats(docs: DataFrame, text: str = "text", length: int = 400, words: int | None = None) -> DataFrame:
    """``docs`` without ``text``, and ``n_bytes``, ``n_removed``, ``n_spans``, ``spans`` (array of start, end: maximal removed
    runs) and ``kept`` (binary, the remaining bytes); with ``words``, also ``rest``: the bytes that neither a repeated string of
    ``length`` bytes nor one of ``words`` words covers."""
    spark = docs.sparkSession
    added = ["n_bytes", "n_removed", "n_spans", "spans", "kept", *(["rest"] if words else [])]
    others = [c for c in docs.columns if c not in {text, *added}]
    body = blocks.unused(docs.columns)
    rows = docs.select(*others, F.col(text).cast("binary").alias(body))
    table = blocks.packed(rows, body)
    total = rows.agg(F.coalesce(F.sum(F.octet_length(body)), F.lit(0))).first()[0]
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // BUCKET_BYTES))
    period, residues = cover(length)
    places = max(total * len(residues) // period * (2 if words else 1), 2)
    index_of = length, words, buckets, min(64, math.ceil(math.log2(places)) + SPARE_BITS)

    def load(index: Index, payload: pa.Scalar) -> pa.Table:
        rows_here = blocks.from_stream(payload.as_buffer())
        index.load(*blocks.flat(rows_here.column(body)))
        return rows_here

    def name_samples(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = Index(*index_of)
        for batch in batches:
            for block, payload in zip(batch.column("block").to_pylist(), batch.column("payload"), strict=True):
                load(index, payload)
                yield index.ask(block, [names for _, names in index.samples()], index.bits)

    ranks = stored(blocks.repeated_keys(table.mapInArrow(name_samples, blocks.ASKED), buckets))

    def ask_ties(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = Index(*index_of)
        for batch in batches:
            for row in range(batch.num_rows):
                load(index, batch.column("payload")[row])
                tied = index.ties(batch.column("replies")[row].as_py() or [])
                yield index.ask(batch.column("block")[row].as_py(), [keys for _, keys in tied], 64)

    with_ranks = table.join(blocks.per_block(ranks), "block", "left")
    suffixes = blocks.repeated_keys(with_ranks.mapInArrow(ask_ties, blocks.ASKED), buckets)
    fields = [f for f in rows.schema.fields if f.name != body]
    result = "n_bytes bigint, n_removed bigint, n_spans bigint, spans array<struct<start: bigint, end: bigint>>, kept binary"

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = Index(*index_of)
        for batch in batches:
            for row in range(batch.num_rows):
                rows_here = load(index, batch.column("payload")[row])
                content, edges = index.kinds[0]
                ranks_here, ties_here = (batch.column(c)[row].as_py() or [] for c in ("replies", "tie_replies"))
                tied = index.ties(ranks_here)
                again = index.answers([keys for _, keys in tied], ties_here, 64)
                repeat = [places[hit] for (places, _), hit in zip(tied, again, strict=True)]
                gone = covered(len(content), repeat[0], repeat[0] + length)
                columns = {**{c: rows_here.column(c) for c in others}, **cut_columns(content, edges, gone)}
                if words:
                    gone |= covered(len(content), index.starts[repeat[1]], index.ends[repeat[1] + words - 1])
                    columns["rest"] = without(content, edges, gone)
                yield from pa.table(columns).to_batches()

    answered = with_ranks.join(blocks.per_block(suffixes).withColumnRenamed("replies", "tie_replies"), "block", "left")
    schema = T.StructType([*fields, *T.StructType.fromDDL(result + (", rest binary" if words else "")).fields])
    return answered.mapInArrow(cut, schema)


def readable(column: str) -> Column:
    """Bytes as text; what a cut leaves of a split character goes too."""
    whole = F.col(column).cast("string")
    return F.coalesce(F.try_validate_utf8(whole), F.regexp_replace(F.make_valid_utf8(whole), "\ufffd", ""))


def covered(n: int, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Which of ``n`` bytes these stretches cover."""
    change = np.zeros(n + 1, np.int32)
    np.add.at(change, starts, 1)
    np.add.at(change, ends, -1)
    return np.cumsum(change[:-1]) > 0


def without(content: np.ndarray, edges: np.ndarray, gone: np.ndarray) -> pa.Array:
    """Each document's bytes that stay."""
    kept = np.concatenate([[0], np.cumsum(~gone)])[edges].astype(np.int64)
    return pa.Array.from_buffers(
        pa.large_binary(), len(edges) - 1, [None, pa.py_buffer(kept.tobytes()), pa.py_buffer(content[~gone].tobytes())]
    ).cast(pa.binary())


def cut_columns(content: np.ndarray, edges: np.ndarray, gone: np.ndarray) -> dict:
    """The result columns of a block of which the bytes ``gone`` are removed."""
    n = len(content)
    kept = without(content, edges, gone)
    # a run begins where the byte before it stays or is another document's
    opens, closes = gone.copy(), gone.copy()
    opens[1:] &= ~gone[:-1]
    closes[:-1] &= ~gone[1:]
    inner = edges[1:-1]
    inner = inner[(inner > 0) & (inner < n)]
    opens[inner] = gone[inner]
    closes[inner - 1] = gone[inner - 1]
    opens, closes = np.flatnonzero(opens), np.flatnonzero(closes) + 1
    span_edges = np.searchsorted(opens, edges)
    owner = np.repeat(edges[:-1], np.diff(span_edges))
    spans = pa.ListArray.from_arrays(
        pa.array(span_edges, pa.int32()),
        pa.StructArray.from_arrays([pa.array(opens - owner, pa.int64()), pa.array(closes - owner, pa.int64())], ["start", "end"]),
    )
    sizes = np.diff(edges)
    return {
        "n_bytes": pa.array(sizes, pa.int64()),
        "n_removed": pa.array(np.diff(np.concatenate([[0], np.cumsum(gone)])[edges]), pa.int64()),
        "n_spans": pa.array(np.diff(span_edges), pa.int64()),
        "spans": spans,
        "kept": kept,
    }
