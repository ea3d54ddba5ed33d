"""Best-fit packing of tokenized documents after Martello-Toth dominance reduction.

A document is its token ids and one end id. A document of more than ``capacity`` ids is cut into full pieces; the first piece
takes what does not fill one. Pieces are then put into as few sequences of ``capacity`` ids as the method finds.

The packing only depends on how many pieces there are of each length, so it is worked out on that histogram (at most
``capacity`` counts, whatever the corpus holds), for all pieces of a length at once:

1. Reduction. For each length, longest first, a set of one, two or three pieces is fixed for good where it provably dominates
   every other set that the piece could share a sequence with. Fixed sets leave fewer choices for the others, so passes over
   all lengths repeat until one fixes nothing.
2. What remains is packed best-fit, longest first.

The result is a list of runs: a pattern of lengths and how many sequences use it. Each piece then finds its sequence from its
rank among the pieces of its length; ranks are made per bucket of rows, so no length is ever gathered in one task.

Defined results: null and empty texts are the end id alone; copies are packed one by one; an empty table gives no row; input
columns (without the text) are kept, result columns replace those of the same name. The order among pieces of one length
follows a hash of the row, so results are repeatable. Texts are cut in slices of ``blocks.BLOCK_BYTES`` or one row.
"""

import bisect
import re
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tonegauge.llm import blocks
from tonegauge.llm.store import stored

SPECIAL = "<|endoftext|>"
#: Known words a worker remembers before it starts afresh.
REMEMBERED = 1_000_000


class Encoder(dict):
    """Ids of texts as little-endian 32-bit bytes; a dict from what stands between single spaces to its ids.

    The vocabulary's pattern never lets a token reach from a character that is not white space over a following space, so
    such pieces can be encoded apart and remembered.
    """

    def __init__(self, json_path: str):
        import tiktoken
        from tokenizers import Tokenizer

        super().__init__()
        self.whole = Tokenizer.from_file(json_path)
        self.words = tiktoken.Encoding(
            "words", pat_str=pattern(), mergeable_ranks=ranks(json_path), special_tokens={}
        )
        self.one = self.words._core_bpe.encode_single_piece

    def __missing__(self, word: str) -> bytes:
        if len(self) >= REMEMBERED:
            self.clear()
        letters = word.rstrip(MARKS)
        marks = word[len(letters) :]
        if letters.removeprefix(" ").isalpha():  # one token of the pattern, and one for the marks behind it
            found = self.one(letters.encode())
            if marks:
                found = found + self.one(marks.encode())
        elif not letters and marks:
            found = self.one(word.encode())
        else:
            found = self.words.encode_ordinary(word)
        ids = self[word] = array("I", found).tobytes()
        return ids

    def encode(self, text: str) -> bytes:
        if SPECIAL in text:  # this string is one id, which the word pieces would not see
            return np.array(self.whole.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        if any(x in text for x in SPACE_PAIRS) or not text.isascii() and WIDE_PAIRS(text):
            words = re.split(r"(?<=\S)(?= )", text)
        else:
            first, *rest = text.split(" ")
            words = [first, *[" " + w for w in rest]] if first else [" " + w for w in rest]
        return b"".join(map(self.__getitem__, words))


MARKS = ".,;:!?*$#&%|"
#: White space in front of a space: there a token can end behind the space, so such texts are cut by a pattern.
SPACE_PAIRS = ["  ", "\n ", "\t ", "\r ", "\v ", "\f "]
WIDE_PAIRS = re.compile("[\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000] ").search


def pattern() -> str:
    import public_tokenizers

    return public_tokenizers.PATTERN


def ranks(json_path: str) -> dict[bytes, int]:
    """Byte strings of the vocabulary by id; the file spells bytes as printable characters."""
    import json

    with open(json_path, encoding="utf-8") as f:
        vocabulary = json.load(f)["model"]["vocab"]
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = {chr(b): b for b in plain}
    letters |= {chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in set(plain))}
    return {bytes(letters[c] for c in word): i for word, i in vocabulary.items() if word != SPECIAL}


def pieces(docs: DataFrame, tokenizer: str, text: str = "text", capacity: int = 1024, end_id: int = 2, with_ids: bool = True) -> DataFrame:
    """One row per piece: the other columns, ``piece``, ``start``, ``length``, ``ids_crc32`` and, if asked for, ``ids``."""
    added = {"piece", "start", "length", "ids_crc32", "ids"}
    others = [c for c in docs.columns if c not in {text, *added}]
    body = blocks.unused(docs.columns)
    rows = docs.select(*others, F.col(text).cast("string").alias(body))
    fields = [rows.schema[c] for c in others] + T.StructType.fromDDL(
        "piece int, start bigint, length bigint, ids_crc32 bigint" + ", ids binary" * with_ids
    ).fields

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(tokenizer)
        end = np.array([end_id], "<u4").tobytes()
        for batch in (part for b in batches for part in blocks.slices(b, blocks.byte_lengths(b.column(body)))):
            row, out = [], {"piece": [], "start": [], "length": [], "ids_crc32": []} | ({"ids": []} if with_ids else {})
            for at, value in enumerate(batch.column(body)):
                ids = encoder.encode(value.as_py() or "") + end
                total = len(ids) // 4
                first = total % capacity or capacity
                edges = [0, *range(first, total + 1, capacity)]
                for piece, (a, b) in enumerate(zip(edges, edges[1:], strict=False)):
                    own = ids[4 * a : 4 * b]
                    row.append(at)
                    out["piece"].append(piece)
                    out["start"].append(a)
                    out["length"].append(b - a)
                    out["ids_crc32"].append(zlib.crc32(own))
                    if with_ids:
                        out["ids"].append(own)
            kept = batch.select(others).take(pa.array(row, pa.int64()))
            columns = [pa.array(out["piece"], pa.int32()), *[pa.array(out[c], pa.int64()) for c in ("start", "length", "ids_crc32")]]
            columns += [pa.array(out["ids"], pa.binary())] if with_ids else []
            yield pa.RecordBatch.from_arrays([*kept.columns, *columns], [*others, *out])

    return rows.mapInArrow(cut, T.StructType(fields))


# the packing of a histogram


def dominant(j: int, sizes: list[int], left: dict[int, int], capacity: int) -> tuple[int, ...] | None:
    """For a piece of length j: a set with it that dominates all others it can be in, or None if none is proven. Its partners
    can be longer than it.

    A set dominates another if the other's pieces can be dealt to its pieces without exceeding any.
    """
    room = capacity - j
    have = lambda s, taken: left[s] - taken.count(s) > 0
    fit = [s for s in sizes[: bisect.bisect_right(sizes, room)] if have(s, (j,))]
    if not fit:
        return (j,)
    best = fit[-1]
    if best == room:
        return (j, best)
    smallest = []
    for s in fit:
        smallest += [s] * min(3, left[s] - (s == j))
        if len(smallest) >= 3:
            break
    if len(smallest) < 2 or smallest[0] + smallest[1] > room:
        return (j, best)  # no two others fit, so the longest single one dominates
    if len(smallest) >= 3 and sum(smallest[:3]) <= room:
        return None  # sets of four and more are left to best-fit
    pairs = []
    for a in fit:
        k = bisect.bisect_right(fit, min(a, room - a)) - 1
        while k >= 0 and not have(fit[k], (j, a)):
            k -= 1
        if k >= 0:
            pairs.append((a, fit[k]))
    if max(a + b for a, b in pairs) <= best:
        return (j, best)
    for a, b in pairs:  # at most two others fit: the pair must cover every pair and the longest single one
        if a >= best and all(c <= a and d <= b for c, d in pairs):
            return (j, a, b)
    return None


def reduce(left: dict[int, int], capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Fixes dominating sets, as often as the counts allow, and takes them out of ``left``: lengths from the longest on, in
    passes until one fixes nothing."""
    runs, fixed = [], True
    while fixed:
        fixed = False
        sizes = sorted(left)
        for j in sizes[::-1]:
            while j in left and (found := dominant(j, sizes, left, capacity)):
                times = min(left[s] // found.count(s) for s in set(found))
                runs.append((found, times))
                take(left, found, times)
                fixed, sizes = True, sorted(left)
    return runs


def take(left: dict[int, int], pattern: tuple[int, ...], times: int) -> None:
    for s in pattern:
        left[s] -= times
        if not left[s]:
            del left[s]


def best_fit(left: dict[int, int], capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Longest first, each into the sequence with the least room that takes it; equal sequences are handled together."""
    rooms: list[int] = []
    bins: dict[int, list[tuple[tuple[int, ...], int]]] = {}

    def put(room: int, pattern: tuple[int, ...], times: int) -> None:
        if times:
            if room not in bins:
                bisect.insort(rooms, room)
                bins[room] = []
            bins[room].append((pattern, times))

    for size in sorted(left, reverse=True):
        n = left[size]
        while n:
            at = bisect.bisect_left(rooms, size)
            if at < len(rooms):
                room = rooms[at]
                pattern, times = bins[room].pop()
                if not bins[room]:
                    del bins[room], rooms[at]
            else:
                room, pattern, times = capacity, (), n
            each = room // size  # the tightest sequence stays the tightest until the piece no longer fits
            full = min(times, n // each)
            put(room - each * size, (*pattern, *[size] * each), full)
            n -= full * each
            times -= full
            if times and n < each:
                put(room - n * size, (*pattern, *[size] * n), 1 if n else 0)
                put(room, pattern, (times - 1 if n else times) if pattern else 0)
                n = 0
    return [run for room in rooms for run in bins[room]]


def plan(histogram: dict[int, int], capacity: int) -> list[tuple[tuple[int, ...], int]]:
    left = {s: n for s, n in histogram.items() if n}
    return reduce(left, capacity) + best_fit(left, capacity)


def places(runs: list[tuple[tuple[int, ...], int]]) -> dict[int, list[np.ndarray]]:
    """By length: ascending first ranks, pieces a sequence, first sequence number and first offset of each run that uses it.
    Equal lengths of a pattern lie side by side."""
    out: dict[int, list[list[int]]] = {}
    used: dict[int, int] = {}
    sequence = 0
    for pattern, times in runs:
        offset = 0
        for size in sorted(set(pattern), reverse=True):
            each = pattern.count(size)
            out.setdefault(size, []).append([used.get(size, 0), each, sequence, offset])
            used[size] = used.get(size, 0) + each * times
            offset += each * size
        sequence += times
    return {s: [np.array(c, np.int64) for c in zip(*rows, strict=True)] for s, rows in out.items()}


def pack(docs: DataFrame, tokenizer: str, text: str = "text", capacity: int = 1024, end_id: int = 2, with_ids: bool = True) -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset`` (gapless from 0 in each sequence)."""
    spark = docs.sparkSession
    docs = docs.drop("sequence_id", "offset")
    table = stored(pieces(docs, tokenizer, text, capacity, end_id, with_ids))
    buckets = 8 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    # a row's bucket must not follow its length, and copies must spread: the row's number in its file part decides
    keyed = stored(table.withColumn("_row", F.monotonically_increasing_id()).withColumn("_bucket", F.pmod(F.xxhash64("_row"), F.lit(buckets)).cast("int")))
    counts = keyed.groupBy("length", "_bucket").agg(F.count("*").alias("n"))
    counts = stored(counts)
    histogram = {r.length: r.n for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    where = places(plan(histogram, capacity))
    before = Window.partitionBy("length").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    firsts = counts.select("length", "_bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_first"))
    own = Window.partitionBy("length", "_bucket").orderBy("_row")
    ranked = (
        keyed.withColumn("_rank", F.row_number().over(own) - 1)
        .join(firsts, ["length", "_bucket"])
        .withColumn("_rank", F.col("_rank") + F.col("_first"))
        .select(*table.columns, "_rank")
    )
    columns = table.columns
    schema = T.StructType([*table.schema.fields, *T.StructType.fromDDL("sequence_id bigint, offset bigint").fields])

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths, rank = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("length", "_rank"))
            sequence, offset = np.zeros(len(rank), np.int64), np.zeros(len(rank), np.int64)
            for size in np.unique(lengths).tolist():
                rows = np.flatnonzero(lengths == size)
                first, each, number, start = where[size]
                run = np.searchsorted(first, rank[rows], "right") - 1
                turn, slot = np.divmod(rank[rows] - first[run], each[run])
                sequence[rows] = number[run] + turn
                offset[rows] = start[run] + slot * size
            yield pa.RecordBatch.from_arrays(
                [*batch.select(columns).columns, pa.array(sequence), pa.array(offset)], [*columns, "sequence_id", "offset"]
            )

    return ranked.mapInArrow(place, schema)


def lower_bound(histogram: dict[int, int], capacity: int) -> int:
    """No packing has fewer sequences (Martello and Toth's second bound): used by tests and reports."""
    sizes = sorted(histogram)
    best = -(-sum(s * n for s, n in histogram.items()) // capacity)
    for k in {0, *[s for s in sizes if s <= capacity // 2]}:
        big = sum(n for s, n in histogram.items() if s > capacity - k)
        half = [(s, n) for s, n in histogram.items() if capacity // 2 < s <= capacity - k]
        small = sum(s * n for s, n in histogram.items() if k <= s <= capacity // 2)
        room = sum((capacity - s) * n for s, n in half)
        best = max(best, big + sum(n for _, n in half) + max(0, -(-(small - room) // capacity)))
    return best

