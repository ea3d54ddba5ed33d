"""Quoted, multi-line CSV read by many tasks a file.

A line break ends a record only outside quotes, and whether a place is outside depends on all quotes before it in the file. So

1. lines are read in splits, and the quotes of each split are counted (grouped in the tasks; one row per split),
2. a running total over the splits of a file tells which splits begin inside a field,
3. each split then joins its lines to records, starting inside or outside; a batch of lines that are records of their own
   passes as it is,
4. only records that go over the end of a split leave their task: their parts, at most two a split, are put together by a
   grouping of their own.

Fields are taken apart by the engine's own ``from_csv``. Quotes must stand as CSV has them: around a field, doubled inside. A
single quote mark in the middle of an unquoted field shifts the count, as it can't be told from an opening one; such files need
``spark.read`` with ``multiLine``. Lines end with LF or CR LF; text is UTF-8. Empty lines between records are skipped.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: A record that lies in one split, or a part of one: what follows the last whole record, goes through, or ends the first.
WHOLE, OPENS, GOES_ON, CLOSES = range(4)


def lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Every line with the file and split that it begins in, in the order of the file within a split."""
    paths = [path] if isinstance(path, str) else path
    return spark.read.option("lineSep", "\n").text(paths).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split"), "value"
    )


def splits_inside(found: DataFrame) -> DataFrame:
    """(file, split) of the splits whose first line begins inside a quoted field: one row a split at most."""
    quotes = F.char_length("value") - F.char_length(F.replace("value", F.lit('"'), F.lit("")))
    odd = found.groupBy("file", "split").agg((F.sum(quotes) % 2).alias("odd"))
    earlier = W.partitionBy("file").orderBy("split").rowsBetween(W.unboundedPreceding, -1)
    return odd.withColumn("before", F.sum("odd").over(earlier)).filter(F.col("before") % 2 == 1).select("file", "split")


def join_lines(values: pa.Array, inside: bool) -> tuple[pa.Array, np.ndarray, bool]:
    """Lines of one split, joined where a break is inside quotes: the records, where each ends (line number), and whether
    the last one is still open. ``inside``: the first line goes on with a field."""
    odd = pc.count_substring(values, '"').to_numpy(zero_copy_only=False) % 2
    after = (np.cumsum(odd) + inside) % 2
    ends = np.flatnonzero(after == 0)
    if len(ends) == len(values):
        return values, ends, False
    text = values.to_pylist()
    edges = [0, *(ends + 1).tolist()]
    joined = ["\n".join(text[a:b]) for a, b in zip(edges, edges[1:], strict=False)]
    if edges[-1] < len(text):
        joined.append("\n".join(text[edges[-1] :]))
    return pa.array(joined, pa.string()), ends, edges[-1] < len(text)


def pieces_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Records and parts of records (file, split, place, kind, value) of lines that come with their split and ``inside``."""
    now, place, held, first_inside = None, 0, None, False

    def out(rows: list[tuple[int, int, str]]) -> pa.RecordBatch:
        columns = list(zip(*rows, strict=True)) or [[], [], []]
        return batch_of(pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int32()), pa.array(columns[2], pa.string()))

    def batch_of(places: pa.Array, kinds: pa.Array, values: pa.Array) -> pa.RecordBatch:
        n = len(values)
        return pa.RecordBatch.from_arrays(
            [pa.repeat(pa.scalar(now[0], pa.string()), n), pa.repeat(pa.scalar(now[1], pa.int64()), n), places, kinds, values],
            ["file", "split", "place", "kind", "value"],
        )

    def closing() -> Iterator[pa.RecordBatch]:
        if now and held is not None:  # an open record at the end of its split
            yield out([(place, GOES_ON if first_inside and place == 0 else OPENS, held)])

    for batch in batches:
        files, splits = batch.column("file"), batch.column("split").to_numpy(zero_copy_only=False)
        codes = files.dictionary_encode().indices.to_numpy(zero_copy_only=False)
        change = np.flatnonzero((np.diff(codes) != 0) | (np.diff(splits) != 0)) + 1
        edges = [0, *change.tolist(), batch.num_rows]
        for a, b in zip(edges, edges[1:], strict=False):
            if a == b:
                continue
            key = (files[a].as_py(), int(splits[a]))
            if key != now:
                yield from closing()
                now, place, held = key, 0, None
                first_inside = bool(batch.column("inside")[a].as_py())
            opened = held is not None or (first_inside and place == 0)
            values, ends, open_ = join_lines(batch.column("value").slice(a, b - a), opened)
            if held is not None:
                values = pa.concat_arrays([pa.array([held + "\n" + values[0].as_py()], pa.string()), values.slice(1).cast(pa.string())])
            held = None
            if open_:
                held = values[-1].as_py()
                values = values.slice(0, len(values) - 1)
            n = len(values)
            if n:
                kinds = np.full(n, WHOLE, np.int32)
                if first_inside and place == 0:
                    kinds[0] = CLOSES
                yield batch_of(pa.array(np.arange(place, place + n), pa.int64()), pa.array(kinds), values.cast(pa.string()))
                place += n
    yield from closing()


def over_splits(parts: DataFrame) -> DataFrame:
    """Records put together from their parts, at the place where each begins. A record has an opening part, any number of
    whole splits and a closing part; the file can end inside a field."""
    order = W.partitionBy("file").orderBy("split", F.col("kind") == OPENS).rowsBetween(W.unboundedPreceding, W.currentRow)
    owned = parts.withColumn("number", F.count_if(F.col("kind") == OPENS).over(order))
    said = F.sort_array(F.collect_list(F.struct("split", "place", "value")))
    joined = owned.groupBy("file", "number").agg(said.alias("parts"))
    return joined.select(
        "file", F.col("parts")[0]["split"].alias("split"), F.col("parts")[0]["place"].alias("place"),
        F.array_join(F.transform("parts", lambda p: p["value"]), "\n").alias("value"),
    )


def records(spark: SparkSession, path: str | list[str], header: bool = True) -> DataFrame:
    """(file, split, place, value): every record of the files as text, without the header record of each file, and where it
    begins."""
    found = lines(spark, path)
    # a key of two numbers, so what is sent to the tasks is small: a row for each split that begins inside a field
    inside = splits_inside(found).select(F.xxhash64("file", "split").alias("key"), F.lit(True).alias("inside"))
    marked = found.withColumn("key", F.xxhash64("file", "split")).join(F.broadcast(inside), "key", "left")
    pieces = marked.select("file", "split", "value", F.coalesce("inside", F.lit(False)).alias("inside")).mapInArrow(
        pieces_of, "file string, split bigint, place bigint, kind int, value string"
    )
    whole = pieces.filter(F.col("kind") == WHOLE).select("file", "split", "place", "value")
    rows = whole.unionByName(over_splits(pieces.filter(F.col("kind") != WHOLE)))
    # the header is the first record of the first split
    kept = rows.filter((F.col("split") > 0) | (F.col("place") > 0)) if header else rows
    trimmed = kept.withColumn("value", F.regexp_replace("value", "\r$", ""))
    return trimmed.filter(F.col("value") != "")


def numbered(rows: DataFrame) -> DataFrame:
    """Adds ``position`` (from 1, in the file) and ``number`` (from 0, in all files by name) of each record. Only the numbers of
    records in each split are summed in order; inside a split they are numbered as they come."""
    order = W.partitionBy("file", "split").orderBy("place")
    ranked = rows.withColumn("rank", F.row_number().over(order))
    sizes = rows.groupBy("file", "split").agg(F.count(F.lit(1)).alias("rows"))
    in_file = W.partitionBy("file").orderBy("split").rowsBetween(W.unboundedPreceding, -1)
    before = sizes.withColumn("before", F.coalesce(F.sum("rows").over(in_file), F.lit(0)))
    files = sizes.groupBy("file").agg(F.sum("rows").alias("rows"))
    # one row a file
    in_all = W.partitionBy(F.col("rows") < 0).orderBy("file").rowsBetween(W.unboundedPreceding, -1)
    starts = files.select("file", F.coalesce(F.sum("rows").over(in_all), F.lit(0)).alias("start"))
    placed = ranked.join(before.select("file", "split", "before").join(starts, "file"), ["file", "split"])
    position = F.col("before") + F.col("rank")
    return placed.select(*rows.columns, position.alias("position"), (F.col("start") + position - 1).alias("number"))


def read(
    spark: SparkSession, path: str | list[str], schema: T.StructType, header: bool = True, strict: bool = False, position: bool = False,
) -> DataFrame:
    """The columns of CSV files with quoted, possibly multi-line fields. ``strict`` stops at the first malformed record;
    ``position`` adds the columns of ``numbered``."""
    options = {"escape": '"', "multiLine": "true", "mode": "FAILFAST" if strict else "PERMISSIVE"}
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    found = records(spark, path, header)
    places = ["position", "number"] if position else []
    return (numbered(found) if position else found).select(F.from_csv("value", ddl, options).alias("r"), *places).select("r.*", *places)
