"""Rows packed into compressed blocks, and sorted keys that blocks exchange by bucket.

A block is one row: some consecutive rows of a table as a compressed Arrow stream. Blocks are written once, so every later
pass over the texts sees the same rows in the same order under the same block number, and only compressed bytes move.
Blocks ask questions about their keys ("does this key occur elsewhere?") by sending sorted distinct keys, delta coded, to
one bucket per key range. A bucket sees a key at most once per block, however often the block holds it, and sends back one
answer per key in the order in which the keys came.
"""

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tonegauge.llm.store import stored

BLOCK_BYTES = 4 << 20


def squeeze(data: bytes, level: int = 1) -> bytes:
    return zstandard.ZstdCompressor(level=level).compress(data)


def unsqueeze(data: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(data)


def to_stream(table: pa.RecordBatch | pa.Table) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as writer:
        writer.write(table)
    return sink.getvalue().to_pybytes()


def from_stream(data: bytes) -> pa.Table:
    return pa.ipc.open_stream(data).read_all()


def slices(batch: pa.RecordBatch, sizes: np.ndarray, most: int = BLOCK_BYTES) -> Iterator[pa.RecordBatch]:
    """Consecutive rows of at most ``most`` bytes together; a longer row is a slice of its own."""
    start, held = 0, 0
    for i, size in enumerate(sizes.tolist()):
        if held and held + size > most:
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += size
    if start < len(sizes):
        yield batch.slice(start)


def byte_lengths(column: pa.Array) -> np.ndarray:
    lengths = pa.compute.binary_length(column)
    return pa.compute.fill_null(lengths, 0).to_numpy(zero_copy_only=False).astype(np.int64)


def unused(columns: list[str]) -> str:
    """A column name that none of these is equal to."""
    return max(columns, key=len, default="") + "_"


def numbers() -> Iterator[int]:
    """Block numbers that no other task uses. They are kept with the block, so a task that runs again does no harm."""
    first = TaskContext.get().partitionId() << 32
    while True:
        yield first
        first += 1


def packed(df: DataFrame, size_of: str) -> DataFrame:
    """All rows as blocks (block, payload), written once. ``size_of``: the binary column that fills a block."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = numbers()
        for batch in batches:
            for part in slices(batch, byte_lengths(batch.column(size_of))):
                yield pa.RecordBatch.from_pydict({"block": [next(number)], "payload": [to_stream(part)]})

    return stored(df.mapInArrow(pack, "block bigint, payload binary"))


def flat(column: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a binary column end to end, and where each row begins (one more entry than rows); null is empty."""
    column = pa.compute.fill_null(column.cast(pa.large_binary()), b"").combine_chunks()
    if isinstance(column, pa.ChunkedArray):
        column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], pa.large_binary())
    _, offsets, data = column.buffers()
    edges = np.frombuffer(offsets, np.int64, len(column) + 1, column.offset * 8) if offsets else np.zeros(1, np.int64)
    content = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return content[edges[0] : edges[-1]], edges - edges[0]


# keys


def encode(keys: np.ndarray) -> bytes:
    """Ascending uint64 keys: gaps, byte planes apart, so that the planes that are nearly all zero cost nothing."""
    gaps = np.diff(keys, prepend=np.uint64(0))
    return squeeze(np.ascontiguousarray(gaps.view(np.uint8).reshape(-1, 8).T).tobytes())


def decode(data: bytes) -> np.ndarray:
    planes = np.frombuffer(unsqueeze(data), np.uint8).reshape(8, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view(np.uint64).ravel(), dtype=np.uint64)


def bounds(keys: np.ndarray, buckets: int, bits: int = 64) -> list[int]:
    """Where each bucket's keys begin in ascending keys of so many bits, and their number at the end."""
    steps = [((1 << bits) * b) // buckets for b in range(1, buckets)]
    return [0, *np.searchsorted(keys, np.array(steps, np.uint64)).tolist(), len(keys)]


ASKED = "bucket int, block bigint, keys binary, extra binary"
REPLY = "block bigint, bucket int, reply binary"


def questions(block: int, keys: np.ndarray, extra: Callable[[int, int], bytes], buckets: int, bits: int = 64) -> pa.RecordBatch:
    """Rows of ASKED for one block's ascending distinct keys; ``extra(a, b)`` is what goes with keys a to b."""
    edges = bounds(keys, buckets, bits)
    some = [(b, x, y) for b, (x, y) in enumerate(zip(edges, edges[1:], strict=False)) if y > x]
    return pa.RecordBatch.from_pydict(
        {
            "bucket": pa.array([b for b, _, _ in some], pa.int32()),
            "block": pa.array([block] * len(some), pa.int64()),
            "keys": pa.array([encode(keys[x:y]) for _, x, y in some], pa.binary()),
            "extra": pa.array([extra(x, y) for _, x, y in some], pa.binary()),
        }
    )


def per_block(replies: DataFrame) -> DataFrame:
    """One row per block with its replies in bucket order. A block asks each bucket once, so the list is bounded."""
    listed = F.sort_array(F.collect_list(F.struct("bucket", "reply")))
    return replies.groupBy("block").agg(F.transform(listed, lambda x: x["reply"]).alias("replies"))


def repeated_keys(asked: DataFrame, buckets: int) -> DataFrame:
    """REPLY rows: a bit per key, set if the key occurs twice or more. ``extra`` has a bit per key, set if the block itself
    holds it twice. One bucket is sorted at a time, and there are as many tasks as buckets."""

    def sort_bucket(table: pa.Table) -> pa.Table:
        held = [decode(x) for x in table.column("keys").to_pylist()]
        own = [
            np.unpackbits(np.frombuffer(x, np.uint8), count=len(k)).astype(bool)
            for x, k in zip(table.column("extra").to_pylist(), held, strict=True)
        ]
        ranked = np.sort(np.concatenate([*held, *[k[o] for k, o in zip(held, own, strict=True)]]))
        twice = np.unique(ranked[1:][ranked[1:] == ranked[:-1]])
        bits = []
        for keys in held:
            at = np.searchsorted(twice, keys)
            at[at == len(twice)] = 0
            bits.append(np.packbits(twice[at] == keys if len(twice) else np.zeros(len(keys), bool)).tobytes())
        return pa.table({"block": table.column("block"), "bucket": table.column("bucket"), "reply": pa.array(bits, pa.binary())})

    return asked.repartition(buckets, "bucket").groupBy("bucket").applyInArrow(sort_bucket, REPLY)


def bits_of(replies: Iterable[bytes], keys: np.ndarray, buckets: int, bits: int = 64) -> np.ndarray:
    """The answers of ``repeated_keys`` to one block's ascending distinct keys."""
    edges = bounds(keys, buckets, bits)
    counts = [y - x for x, y in zip(edges, edges[1:], strict=False) if y > x]
    parts = [np.unpackbits(np.frombuffer(r, np.uint8), count=n) for r, n in zip(replies, counts, strict=True)]
    return np.concatenate(parts).astype(bool) if parts else np.zeros(0, bool)
