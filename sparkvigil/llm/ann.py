"""Approximate nearest neighbours (largest inner product) by a permutation index.

A few pivots are drawn from the vectors. Every vector is described by the order of the pivots from
nearest to farthest, and posted in the inverted files of its ``POSTED`` nearest ones. A query reads
the files of its own ``READ`` nearest pivots, ranks what it finds by the footrule distance of the
pivot orders, and reranks the best ``RERANK`` share by exact products, and whatever is only half as
far as a random order, so that dense groups are not cut; equal vectors are ranked as one. Rows are dealt into blocks of
bounded size, each with inverted files of its own; queries are held against all blocks.

Largest products become nearest vectors by one more coordinate, which lifts every vector to the
largest length. Only pivots (``PIVOTS`` rows, by hash) are a sample; every vector is indexed.

Defined results: vectors that are null, zero, not finite or of an unusual length take no part; rows
with the query's own vec_id are not its neighbours; equal scores are ordered by vec_id (equal
vectors get equal scores: products are summed in the order of the components); a query has fewer
than ``k`` rows only if there are fewer candidates; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkvigil.llm.vectors import best, in_blocks, keep_best, lists, matrix, usable
from sparkvigil.session import stage

PIVOTS = 128
POSTED = 24
READ = 24
RERANK = 0.25
K = 20
BLOCK_ROWS = 16_384
CHUNK_ROWS = 8_192

FOUND = "query_id bigint, vec_id bigint, score double"
FOUND_TYPE = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])


def lifted(rows: np.ndarray, longest: float) -> np.ndarray:
    """Rows with a coordinate that gives all of them the length ``longest``."""
    rest = np.sqrt(np.maximum(longest**2 - np.einsum("ij,ij->i", rows, rows), 0))
    return np.column_stack([rows, rest])


def places(rows: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """For each row the place of every pivot in its order, nearest first (ties: first pivot)."""
    order = np.argsort(-(rows @ pivots.T), axis=1, kind="stable")
    out = np.empty(order.shape, dtype=np.int16)
    np.put_along_axis(out, order, np.arange(order.shape[1], dtype=np.int16)[None, :], axis=1)
    return out


def products(rows: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Inner products, summed component by component: equal rows have equal products."""
    total = np.zeros(len(rows))
    for j in range(rows.shape[1]):
        total += rows[:, j] * query[j]
    return total


def footrules(seats: np.ndarray, asked: np.ndarray) -> np.ndarray:
    """Footrule distance of every row of places to one order; both as floats, which is exact here."""
    out, ones = np.empty(len(seats), dtype=np.float32), np.ones(seats.shape[1], dtype=np.float32)
    for at in range(0, len(seats), 2048):
        apart = np.subtract(seats[at : at + 2048], asked)
        np.dot(np.abs(apart, out=apart), ones, out=out[at : at + 2048])
    return out


def search_block(rows: pa.Table, queries: pa.Table, k: int, posted: int, read: int, rerank: float) -> pa.Table:
    """The best ``k`` of one block for each query of a chunk."""
    if not rows.num_rows or not queries.num_rows:
        return FOUND_TYPE.empty_table()
    ids, own = rows["vec_id"].to_numpy(), queries["vec_id"].to_numpy()
    sort = np.argsort(ids, kind="stable")
    ids, vectors = ids[sort], matrix(rows["vector"])[sort]
    # Equal vectors are one entry of the index, however many there are: members in order of their ids.
    whole = np.ascontiguousarray(vectors).view(np.dtype((np.void, vectors.shape[1] * 8))).ravel()
    _, first, entry = np.unique(whole, return_index=True, return_inverse=True)
    members = np.argsort(entry, kind="stable")
    size = np.bincount(entry)
    begin = np.cumsum(size) - size
    vectors, seats = vectors[first], matrix(rows["places"], np.float32)[sort][first]
    asked, asked_seats = matrix(queries["vector"]), matrix(queries["places"], np.float32)
    files = [np.flatnonzero(seats[:, p] < posted) for p in range(seats.shape[1])]
    heavy = np.flatnonzero(size >= k)  # could fill an answer alone: always reranked, few in any block
    dense = seats.shape[1] ** 2 / 6  # half of what two random orders are apart
    wanted = max(8 * k, int(np.ceil(rerank * len(first))))
    out = []
    for i, query_id in enumerate(own):
        hit = np.zeros(len(first), dtype=bool)
        for pivot in np.flatnonzero(asked_seats[i] < read):
            hit[files[pivot]] = True
        found = np.flatnonzero(hit)
        if size[found].sum() <= k:  # too few postings to fill the answer: the whole block
            found = np.arange(len(first))
        footrule = footrules(seats[found], asked_seats[i])
        last = min(wanted, len(found)) - 1
        near = np.union1d(found[footrule <= max(dense, np.partition(footrule, last)[last])], heavy)
        # Fast products leave out what cannot be among the best; the others are summed in order. One
        # entry more than asked for, as one may hold the query alone; ties of the last one stay.
        rough = vectors[near] @ asked[i]
        last = min(k, len(rough) - 1)
        least = -np.partition(-rough, last)[last] - 1e-9 * np.abs(rough).max()
        near = near[rough >= least]
        score = products(vectors[near], asked[i])
        count = np.minimum(size[near], k + 1)
        nth = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
        row = members[np.repeat(begin[near], count) + nth]
        score = np.repeat(score, count)[ids[row] != query_id]
        row = row[ids[row] != query_id]
        top = keep_best(np.zeros(len(row)), score, ids[row], k)
        out.append((np.full(len(top), query_id), ids[row[top]], score[top]))
    columns = [np.concatenate(c) for c in zip(*out, strict=True)]
    return pa.table([pa.array(c) for c in columns], schema=FOUND_TYPE)


def draw(rows: DataFrame, count: int, pivots: int) -> list:
    """At most ``pivots`` different vectors, by hash; a vector that is repeated is drawn once."""
    key = F.xxhash64("vector")
    for share in (16 * pivots / max(1, count), 1.0):
        near = rows.filter(F.pmod(key, F.lit(1 << 30)) < share * (1 << 30)).select("vector").distinct()
        found = near.orderBy(key, "vector").limit(pivots).collect()
        if len(found) == pivots or share >= 1:
            break
    return found


def nearest(
    vectors: DataFrame,
    is_query,
    k: int = K,
    pivots: int = PIVOTS,
    posted: int = POSTED,
    read: int = READ,
    rerank: float = RERANK,
    block_rows: int = BLOCK_ROWS,
    chunk_rows: int = CHUNK_ROWS,
) -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` nearest found of the rows for which ``is_query``."""
    rows = stage(usable(vectors, zero=False), "vectors")
    square = F.aggregate("vector", F.lit(0.0), lambda a, x: a + x * x)
    sums = rows.agg(
        F.count(F.lit(1)).alias("n"), F.count_if(is_query).alias("q"), F.sqrt(F.max(square)).alias("longest")
    ).first()
    longest = sums["longest"] or 1.0
    drawn = draw(rows, sums["n"], pivots)
    base = lifted(np.array([r["vector"] for r in drawn]), longest) if drawn else np.zeros((0, 0))

    def describe(column: str, query: bool):
        @F.arrow_udf("array<smallint>")
        def seats(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            for batch in batches:
                data = matrix(batch)
                if query:
                    data = np.column_stack([data, np.zeros(len(data))])
                elif len(data):
                    data = lifted(data, longest)
                yield lists(places(data, base), pa.int16()) if len(data) else pa.array([], pa.list_(pa.int16()))

        return seats(F.col(column))

    blocks, chunks = -(-sums["n"] // block_rows) or 1, -(-sums["q"] // chunk_rows) or 1
    key = F.xxhash64("vec_id")
    indexed = rows.select(
        "vec_id", "vector", describe("vector", False).alias("places"), F.pmod(key, F.lit(blocks)).cast("int").alias("block")
    )
    asked = rows.filter(is_query).select(
        "vec_id",
        "vector",
        describe("vector", True).alias("places"),
        F.pmod(key, F.lit(chunks)).cast("int").alias("chunk"),
        F.sequence(F.lit(0), F.lit(blocks - 1)).alias("blocks"),
    )
    found = in_blocks(indexed, asked, lambda a, b: search_block(a, b, k, posted, read, rerank), FOUND, chunks)
    return best(found, k)
