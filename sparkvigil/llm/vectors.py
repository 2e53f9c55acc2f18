"""Helpers of the vector searches: usable rows, and queries against all rows in blocks."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def usable(vectors: DataFrame, zero: bool) -> DataFrame:
    """vec_id and vector (doubles) of the rows that take part.

    Null vectors and those with null or non-finite components do not, nor all-zero ones unless
    ``zero``; nor vectors of another length than the most frequent one (of ties, the longest).
    """
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = vectors.select("vec_id", F.col("embedding").cast("array<double>").alias("vector"))
    rows = rows.filter(F.col("vec_id").isNotNull() & F.col("vector").isNotNull() & (F.size("vector") > 0) & finite)
    if not zero:
        rows = rows.filter(F.exists("vector", lambda x: x != 0))
    sizes = rows.groupBy(F.size("vector").alias("n")).count().orderBy(F.desc("count"), F.desc("n")).first()
    return rows.filter(F.size("vector") == (sizes["n"] if sizes else 0))


def matrix(column: pa.ChunkedArray | pa.Array, kind: type = np.float64) -> np.ndarray:
    """A column of equally long lists as a matrix."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if not len(column):
        return np.zeros((0, 0), dtype=kind)
    return column.flatten().to_numpy(zero_copy_only=False).astype(kind, copy=False).reshape(len(column), -1)


def lists(rows: np.ndarray, kind: pa.DataType) -> pa.Array:
    """A matrix as a column of equally long lists."""
    n, width = rows.shape
    return pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * width), pa.array(rows.ravel(), kind))


def in_blocks(
    rows: DataFrame, queries: DataFrame, search: Callable[[pa.Table, pa.Table], pa.Table], schema: str, chunks: int
) -> DataFrame:
    """``search(rows of a block, queries of a chunk)`` for every block and chunk of queries.

    ``rows`` has ``block``; ``queries`` has ``chunk`` and ``blocks``, the blocks it must be held
    against. Blocks and chunks are of bounded size, and each pair is a task group of its own.
    """
    repeated = rows.withColumn("chunk", F.explode(F.sequence(F.lit(0), F.lit(chunks - 1))))
    sent = queries.withColumn("block", F.explode("blocks")).drop("blocks")
    pairs = repeated.groupBy("block", "chunk").cogroup(sent.groupBy("block", "chunk"))
    return pairs.applyInArrow(lambda left, right: search(left, right), schema)


def best(found: DataFrame, k: int) -> DataFrame:
    """The ``k`` best (query_id, vec_id, score) of every query, ranked from 1; ties to smaller ids."""
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def keep_best(query: np.ndarray, score: np.ndarray, vec_id: np.ndarray, k: int) -> np.ndarray:
    """Places of the ``k`` best rows of every query, ties to smaller ids."""
    order = np.lexsort((vec_id, -score, query))
    first = np.r_[True, query[order][1:] != query[order][:-1]] if len(order) else np.zeros(0, bool)
    begin = np.maximum.accumulate(np.where(first, np.arange(len(order)), 0))
    return order[np.arange(len(order)) - begin < k]
