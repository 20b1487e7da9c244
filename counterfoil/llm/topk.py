"""Exact top-k by inner product, with whole blocks of vectors pruned.

Vectors lie in blocks of document ranges with the largest and smallest value of every term
(dimension). For a query the sum over terms of the largest possible product bounds every score
of a block. Blocks are visited in the order of their bounds, each scored through its forward
index (the matrix of its vectors), until the next bound falls below the k-th best score so far.
Within a range the vectors are put into blocks by the nearest of a few of them, so that the values
of a block's terms lie close together and its bound is near its scores.

Spark deals chunks of queries and ranges of vectors out to tasks: every chunk meets every range
once. Both hold up to ``TILE_BYTES``, so a vector is copied once for every 65,000 queries of 64
terms and a query once for as many vectors; up to that many queries no vector is copied at all.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from counterfoil.llm.common import positions
from counterfoil.sources.storage import store

BLOCK_ROWS = 256
#: Bytes of a range's vectors, or a chunk's queries, as 64-bit numbers.
TILE_BYTES = 32 << 20
#: Rows of a range below which more tasks do not help.
LEAST_RANGE = 16_384
#: Integers up to here are exact as doubles.
EXACT = 1 << 53


def grouped_alike(vectors: np.ndarray) -> np.ndarray:
    """An order of the rows in which similar ones are neighbours: by the nearest of so many evenly
    spaced rows as there are blocks."""
    pivots = vectors[:: max(1, BLOCK_ROWS)].astype(np.float64)
    if len(pivots) < 2:
        return np.arange(len(vectors))
    rows = vectors.astype(np.float64)
    near = (rows @ pivots.T - 0.5 * (pivots * pivots).sum(axis=1)).argmax(axis=1)
    return np.argsort(near, kind="stable")


def best_of_group(
    rows: np.ndarray,
    ids: np.ndarray,
    vectors: np.ndarray,
    query_rows: np.ndarray,
    queries: np.ndarray,
    k: int,
    visited: list[int] | None = None,
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Index of the query, vector id and score of the k best of a range for each query.

    Equal scores go to the smaller id. A block is left out only if its bound is below the k-th
    score. A query never meets its own row; ``rows`` tell which that is. The number of blocks that
    each query visits is added to ``visited``, if given.
    """
    top = float(np.abs(vectors).max(initial=0)) * float(np.abs(queries).max(initial=0))
    if top * max(1, vectors.shape[1]) < EXACT:  # a double adds these exactly, and faster
        vectors, queries = vectors.astype(np.float64), queries.astype(np.float64)
    order = grouped_alike(vectors)
    rows, ids, vectors = rows[order], ids[order], vectors[order]
    starts = np.arange(0, len(ids), BLOCK_ROWS)
    high = np.maximum.reduceat(vectors, starts, axis=0)
    low = np.minimum.reduceat(vectors, starts, axis=0)
    out_q, out_v, out_s = [], [], []
    for q, query in enumerate(queries):
        bounds = high @ np.maximum(query, 0) + low @ np.minimum(query, 0)
        best_s, best_i, seen = np.empty(0, vectors.dtype), np.empty(0, np.int64), 0
        for b in np.argsort(-bounds, kind="stable"):
            if len(best_s) == k and bounds[b] < best_s[-1]:
                break
            seen += 1
            at = slice(starts[b], min(starts[b] + BLOCK_ROWS, len(ids)))
            scores, mine, other = vectors[at] @ query, ids[at], rows[at] != query_rows[q]
            if len(best_s) == k:
                other &= scores >= best_s[-1]
            scores = np.concatenate([best_s, scores[other]])
            mine = np.concatenate([best_i, mine[other]])
            first = np.lexsort((mine, -scores))[:k]
            best_s, best_i = scores[first], mine[first]
        if visited is not None:
            visited.append(seen)
        out_q.append(np.full(len(best_i), q, np.int64))
        out_v.append(best_i)
        out_s.append(best_s.astype(np.int64))
    if not out_q:
        return (np.empty(0, np.int64),) * 3
    return np.concatenate(out_q), np.concatenate(out_v), np.concatenate(out_s)


def quantized(
    df: DataFrame, is_query: Column, id_column: str, vector_column: str, scale: float
) -> DataFrame:
    """id, whether it is a query, and floor(scale * x); rows that are null or hold null or
    non-finite values are left out."""
    vector = F.col(vector_column)
    whole = F.forall(
        vector,
        lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))),
    )
    numbers = F.transform(vector, lambda x: F.floor(F.lit(float(scale)) * x.cast("double")))
    return (
        df.filter(vector.isNotNull() & F.col(id_column).isNotNull())
        .filter(whole)
        .select(
            F.col(id_column).cast("bigint").alias("id"),
            F.coalesce(is_query, F.lit(False)).alias("asks"),
            numbers.alias("vector"),
        )
    )


def matrix(column: pa.ChunkedArray, width: int) -> np.ndarray:
    """Rows as a matrix, shorter vectors filled up with zeros."""
    out = np.zeros((len(column), width), np.int64)
    lists = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    lengths = np.asarray(lists.value_lengths(), dtype=np.int64)
    place = np.arange(width)[None, :] < lengths[:, None]
    out[place] = lists.flatten().to_numpy(zero_copy_only=False)
    return out


def tiles(count: int, asking: int, width: int, partitions: int) -> tuple[int, int, int]:
    """Rows of a range, ranges, and chunks of queries. As many ranges as partitions while those are
    small, then both as large as a tile: so many copies of a vector and of a query are shuffled as
    there are chunks and ranges."""
    most = max(1, TILE_BYTES // (8 * max(1, width)))
    per_range = min(most, max(LEAST_RANGE, -(-count // partitions)))
    return per_range, max(1, -(-count // per_range)), max(1, -(-asking // most))


def top_k(
    vectors: DataFrame,
    is_query: Column,
    k: int = 20,
    scale: float = 64.0,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best other rows of every query row.

    Equal scores go to the smaller id; with fewer than k other rows all are returned. Rows
    with a null id or vector, or with a null or non-finite component, take no part. Vectors of
    different lengths are compared as if filled up with zeros. Rows that repeat an id, or a whole
    row, are rows like all others: each is a candidate for the others, and each asks if its id
    does, so a query id that repeats has so many results of every rank. No rows give no rows; other
    columns are not read. Sums beyond 64 bits wrap around.
    """
    data = store(quantized(vectors, is_query, id_column, vector_column, scale), "vectors")
    count, asking, width = data.agg(
        F.count("id"), F.count(F.when(F.col("asks"), 1)), F.max(F.size("vector"))
    ).first()
    width = max(width or 0, 0)
    partitions = int(vectors.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    per_range, ranges, chunks = tiles(count, asking, width, partitions)
    placed = positions(data, "row")
    chunk = F.pmod(F.xxhash64("row"), F.lit(chunks)).cast("int")
    left = placed.select(
        F.expr(f"cast(row div {per_range} as int)").alias("range"),
        F.explode(F.sequence(F.lit(0), F.lit(chunks - 1))).alias("chunk"),
        "row",
        "id",
        "vector",
    )
    right = placed.filter("asks").select(
        F.explode(F.sequence(F.lit(0), F.lit(ranges - 1))).alias("range"),
        chunk.alias("chunk"),
        *[F.col(c).alias(f"asked_{c}") for c in ("row", "id", "vector")],
    )

    def search(mine: pa.Table, asked: pa.Table) -> pa.Table:
        found = (np.empty(0, np.int64),) * 3
        if len(mine) and len(asked):
            found = best_of_group(
                mine["row"].to_numpy(),
                mine["id"].to_numpy(),
                matrix(mine["vector"], width),
                asked["asked_row"].to_numpy(),
                matrix(asked["asked_vector"], width),
                k,
            )
        at, vec_id, score = found
        return pa.table(
            {
                "row": asked["asked_row"].to_numpy()[at],
                "query_id": asked["asked_id"].to_numpy()[at],
                "vec_id": vec_id,
                "score": score,
            }
        )

    found = (
        left.groupBy("chunk", "range")
        .cogroup(right.groupBy("chunk", "range"))
        .applyInArrow(search, "row bigint, query_id bigint, vec_id bigint, score bigint")
    )
    # At most k rows per range and query meet here.
    by_score = Window.partitionBy("row").orderBy(F.col("score").desc(), "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(by_score))
        .filter(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
