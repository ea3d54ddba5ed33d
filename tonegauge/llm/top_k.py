"""Exact top-k by inner product: every query against every row, term at a time.

Vectors become integers, floor(scale * x). Rows are dealt into blocks; a block's postings are, per term (component), the
weights of its rows. A query block takes its non-zero terms one after the other and adds weight times postings into a dense
array of scores, keeps the best k of each query by partition selection, and the best of all blocks are merged.

A cell of the work is one query block and one row block, both of bounded size, so neither side is ever held whole; the pairs
of cells grow with queries times rows, which is what an exhaustive search costs. Scores are exact 64-bit integers.

Defined results: vectors that are null, or hold null or non-finite components, take no part; where lengths differ, missing
components count as zero; ties go to the smaller id; rows with equal vectors are all candidates; a query with fewer
candidates than k returns all of them; ids that are null take no part; an empty table gives no row; extra columns are ignored.
Products are computed in 64-bit integers, so components must stay below 2^28 in size.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

QUERIES_A_CELL = 2048
ROWS_A_CELL = 512
#: Queries whose dense score arrays are held at once.
TOGETHER = 256


def usable(vector: Column) -> Column:
    """Not null, and all components finite."""
    return vector.isNotNull() & F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))


def matrix(column: pa.ChunkedArray) -> np.ndarray:
    """Rows of integers, as long as the longest."""
    rows = [np.asarray(x.values.to_numpy(zero_copy_only=False), np.int64) for x in column]
    out = np.zeros((len(rows), max(map(len, rows), default=0)), np.int64)
    for k, row in enumerate(rows):
        out[k, : len(row)] = row
    return out


def best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k highest scores, ties to the smaller id, highest first."""
    if len(scores) > k:
        cut = np.partition(scores, len(scores) - k)[len(scores) - k]
        places = np.flatnonzero(scores >= cut)  # with all that tie at the cut
    else:
        places = np.arange(len(scores))
    return places[np.lexsort((ids[places], -scores[places]))][:k]


def cell(queries: pa.Table, rows: pa.Table, k: int) -> pa.Table:
    """The best k rows of one cell for each of its queries."""
    out = {"query_id": [], "vec_id": [], "score": []}
    if queries.num_rows and rows.num_rows:
        weights, postings = matrix(queries.column("vector")), np.ascontiguousarray(matrix(rows.column("vector")).T)
        query_ids, row_ids = queries.column("id").to_numpy(), rows.column("id").to_numpy()
        for first in range(0, len(query_ids), TOGETHER):
            part = weights[first : first + TOGETHER]
            scores = np.zeros((len(part), len(row_ids)), np.int64)
            for term in range(min(part.shape[1], len(postings))):
                asks = np.flatnonzero(part[:, term])
                scores[asks] += part[asks, term, None] * postings[term]
            for query, own in zip(query_ids[first : first + TOGETHER].tolist(), scores, strict=True):
                others = np.flatnonzero(row_ids != query)
                top = others[best(own[others], row_ids[others], k)]
                out["query_id"] += [query] * len(top)
                out["vec_id"] += row_ids[top].tolist()
                out["score"] += own[top].tolist()
    return pa.table({c: pa.array(x, pa.int64()) for c, x in out.items()})


def search(rows: DataFrame, is_query: Column, id: str = "vec_id", vector: str = "embedding", k: int = 5, scale: int = 256) -> DataFrame:
    """(query_id, rank, vec_id, score): for each query row the ``k`` best other rows. Ids are integers and name the rows."""
    ints = rows.filter(usable(F.col(vector)) & F.col(id).isNotNull()).select(
        F.col(id).cast("bigint").alias("id"),
        F.transform(vector, lambda x: F.floor(x.cast("double") * scale)).alias("vector"),
        F.coalesce(is_query, F.lit(False)).alias("q"),
    )
    n, asked = ints.agg(F.count("*"), F.count_if("q")).first()
    row_cells, query_cells = n // ROWS_A_CELL + 1, asked // QUERIES_A_CELL + 1
    cell_of = lambda cells: F.pmod(F.xxhash64("id"), F.lit(cells)).cast("int")
    queries = ints.filter("q").dropDuplicates(["id", "vector"]).select(
        "id", "vector", cell_of(query_cells).alias("query_cell"), F.explode(F.sequence(F.lit(0), F.lit(row_cells - 1))).alias("row_cell")
    )
    # all query cells need each row
    candidates = ints.select(
        "id", "vector", F.explode(F.sequence(F.lit(0), F.lit(query_cells - 1))).alias("query_cell"), cell_of(row_cells).alias("row_cell")
    )
    keys = ["query_cell", "row_cell"]
    found = queries.groupBy(*keys).cogroup(candidates.groupBy(*keys)).applyInArrow(
        lambda q, r: cell(q, r, k), "query_id bigint, vec_id bigint, score bigint"
    )
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
