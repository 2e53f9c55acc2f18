"""Exact top-k inner products of integer vectors by norm-bucketed retrieval.

Vectors are range-partitioned by length into blocks, longest first, and a block's task cuts them
into buckets of similar length. Every query starts with a lower bound for its k-th best product,
taken from the longest vectors of all; a block that cannot reach the bound with its longest vector
is not even sent the query. In a bucket the bound becomes a local cosine threshold. A high one
prunes by coordinates: the feasible ranges of the query's largest components are looked up in sorted
columns and intersected. A low one prunes by length alone. What is left is verified by its product,
and the bounds rise from bucket to bucket.

Defined results: vectors that are null, not finite or of an unusual length take no part, zero ones
do; rows with the query's own vec_id are not its answers; equal products are ordered by vec_id; an
empty table gives an empty result. Products must fit 63 bits.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkvigil.llm.vectors import best, in_blocks, keep_best, matrix, usable
from sparkvigil.session import stage

K = 5
SCALE = 256
SEED_ROWS = 1024
BLOCK_ROWS = 8_192
CHUNK_ROWS = 8_192
BUCKET_ROWS = 512
# Local cosine threshold from which coordinates prune, and how many of them are looked up.
COORDINATE_FROM = 0.75
FOCUS = 6
# Products that are checked at a time.
STEP = 1 << 21

FOUND = "query_id bigint, vec_id bigint, score bigint"
FOUND_TYPE = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])
# A little room for rounding wherever lengths or cosines decide.
SLACK = 1e-9


def exact_products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """All products of rows of ``a`` and ``b``; in doubles as long as those are exact."""
    if not len(a) or not len(b):
        return np.zeros((len(a), len(b)), dtype=np.int64)
    bound = float(np.abs(a).max()) * float(np.abs(b).max()) * a.shape[1]
    if bound < 2**53:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    return a @ b.T


def lengths(rows: np.ndarray) -> np.ndarray:
    return np.sqrt(np.einsum("ij,ij->i", rows.astype(np.float64), rows.astype(np.float64)))


class Answers:
    """The best ``k`` so far of every query of a chunk, and the bound that follows."""

    def __init__(self, ids: np.ndarray, bound: np.ndarray, k: int):
        self.ids, self.bound, self.k = ids, bound.astype(np.float64), k
        self.query, self.vec_id, self.score = (np.zeros(0, dtype=np.int64) for _ in range(3))

    def add(self, query: np.ndarray, vec_id: np.ndarray, score: np.ndarray) -> None:
        own = vec_id != self.ids[query]
        query, vec_id, score = query[own], vec_id[own], score[own]
        query, vec_id, score = (
            np.concatenate(x)
            for x in ((self.query, query), (self.vec_id, vec_id), (self.score, score))
        )
        top = keep_best(query, score, vec_id, self.k)
        self.query, self.vec_id, self.score = query[top], vec_id[top], score[top]
        count = np.bincount(self.query, minlength=len(self.ids))
        last = np.cumsum(count) - 1
        full = count == self.k
        self.bound[full] = np.maximum(self.bound[full], self.score[last[full]])


class Bucket:
    """Vectors of similar length, longest first, with sorted columns of their directions."""

    def __init__(self, ids: np.ndarray, rows: np.ndarray, norms: np.ndarray):
        self.ids, self.rows, self.norms = ids, rows, norms
        self.longest = norms[0]
        self.columns = None

    def sorted_columns(self):
        if self.columns is None:
            unit = self.rows / np.maximum(self.norms, 1e-300)[:, None]
            order = np.argsort(unit, axis=0)
            self.columns = order, np.take_along_axis(unit, order, axis=0)
        return self.columns

    def by_coordinates(self, unit: np.ndarray, cosine: float) -> np.ndarray:
        """Rows whose focus coordinates are all within reach of the cosine threshold."""
        order, columns = self.sorted_columns()
        seen = np.zeros(len(self.ids), dtype=np.int64)
        focus = np.argsort(-np.abs(unit))[:FOCUS]
        for f in focus:
            reach = np.sqrt(max(0.0, (1 - cosine**2) * (1 - unit[f] ** 2)))
            low = -1.0 if unit[f] <= -cosine else unit[f] * cosine - reach
            high = 1.0 if unit[f] >= cosine else unit[f] * cosine + reach
            begin, end = np.searchsorted(columns[:, f], [low - SLACK, high + SLACK])
            seen[order[begin:end, f]] += 1
        return np.flatnonzero(seen == len(focus))


def search_block(rows: pa.Table, queries: pa.Table, k: int) -> pa.Table:
    """The best ``k`` of one block for each query of a chunk, as far as its bound allows."""
    if not rows.num_rows or not queries.num_rows:
        return FOUND_TYPE.empty_table()
    data, ids = matrix(rows["vector"], np.int64), rows["vec_id"].to_numpy()
    norms = lengths(data)
    order = np.lexsort((ids, -norms))
    data, ids, norms = data[order], ids[order], norms[order]
    asked, own = matrix(queries["vector"], np.int64), queries["vec_id"].to_numpy()
    asked_norms = lengths(asked)
    bound = queries["bound"].to_numpy(zero_copy_only=False)
    answers = Answers(own, np.where(np.isnan(bound), -np.inf, bound), k)
    unit = asked / np.maximum(asked_norms, 1e-300)[:, None]
    for at in range(0, len(ids), BUCKET_ROWS):
        part = slice(at, at + BUCKET_ROWS)
        bucket = Bucket(ids[part], data[part], norms[part])
        reach = asked_norms * bucket.longest
        # The largest product in the bucket is the product of the lengths.
        live = np.flatnonzero(reach * (1 + SLACK) + SLACK >= answers.bound)
        if not len(live):
            if (asked_norms * norms[part][-1] < answers.bound).all() and (answers.bound >= 0).all():
                break  # what follows is shorter still
            continue
        cosine = np.where(reach[live] > 0, answers.bound[live] / np.maximum(reach[live], 1e-300), -1)
        by_length = live[cosine < COORDINATE_FROM]
        for some in np.array_split(by_length, -(-len(by_length) * BUCKET_ROWS // STEP) or 1):
            check_lengths(bucket, some, asked, asked_norms, answers)
        query, place = [], []
        for i, c in zip(live[cosine >= COORDINATE_FROM], cosine[cosine >= COORDINATE_FROM], strict=True):
            near = bucket.by_coordinates(unit[i], min(1.0, c * (1 - SLACK)))
            query.append(np.full(len(near), i))
            place.append(near)
        if query:
            query, place = np.concatenate(query), np.concatenate(place)
            score = np.einsum("ij,ij->i", asked[query], bucket.rows[place])
            good = score >= answers.bound[query]
            answers.add(query[good], bucket.ids[place[good]], score[good])
    return pa.table(
        [pa.array(own[answers.query]), pa.array(answers.vec_id), pa.array(answers.score)], schema=FOUND_TYPE
    )


def check_lengths(bucket: Bucket, some: np.ndarray, asked: np.ndarray, asked_norms: np.ndarray, answers: Answers) -> None:
    """Products of the queries ``some`` with the leading rows that are long enough for any of them."""
    if not len(some):
        return
    need = np.where(asked_norms[some] > 0, answers.bound[some] / np.maximum(asked_norms[some], 1e-300), 0)
    n = int(np.searchsorted(-bucket.norms, -(need.min() * (1 - SLACK)) + SLACK, side="right"))
    score = exact_products(asked[some], bucket.rows[:n])
    row, place = np.nonzero(score >= answers.bound[some][:, None])
    answers.add(some[row], bucket.ids[place], score[row, place])


def search(
    vectors: DataFrame,
    is_query,
    k: int = K,
    scale: int = SCALE,
    block_rows: int = BLOCK_ROWS,
    chunk_rows: int = CHUNK_ROWS,
) -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` largest products of the rows for which ``is_query``."""
    whole = F.transform("vector", lambda x: F.floor(x * F.lit(float(scale))))
    rows = usable(vectors, zero=True).select("vec_id", whole.alias("vector"))
    square = F.aggregate("vector", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))
    rows = stage(rows.withColumn("norm", F.sqrt(square)), "vectors")
    sums = rows.agg(F.count(F.lit(1)).alias("n"), F.count_if(is_query).alias("q")).first()
    blocks, chunks = -(-sums["n"] // block_rows) or 1, -(-sums["q"] // chunk_rows) or 1
    ranged = rows.repartitionByRange(blocks, F.desc("norm"), "vec_id").withColumn("block", F.spark_partition_id())
    ranged = stage(ranged, "norm_blocks")
    # One row for each block of about ``block_rows`` vectors.
    reach = [(r["block"], r["longest"]) for r in ranged.groupBy("block").agg(F.max("norm").alias("longest")).collect()]
    seeds = rows.orderBy(F.desc("norm"), "vec_id").limit(SEED_ROWS).collect()
    seed_ids = np.array([r["vec_id"] for r in seeds], dtype=np.int64)
    seed_rows = np.array([r["vector"] for r in seeds], dtype=np.int64) if seeds else np.zeros((0, 0), dtype=np.int64)

    numbers = np.array([b for b, _ in reach], dtype=np.int32)
    longest = np.array([m for _, m in reach])

    @F.arrow_udf("struct<bound:double,blocks:array<int>>")
    def bounds(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for ids, batch in batches:
            data = matrix(batch, np.int64)
            low = np.full(len(ids), np.nan)
            if len(ids) and len(seed_ids) > k:
                score = exact_products(data, seed_rows).astype(np.float64)
                score[ids.to_numpy()[:, None] == seed_ids[None, :]] = -np.inf
                kth = -np.partition(-score, k - 1, axis=1)[:, k - 1]
                low = np.where(np.isfinite(kth), kth, np.nan)
            norms = lengths(data) if len(ids) else np.zeros(0)
            blocks = [
                numbers[np.isnan(bound) | (norm * longest * (1 + SLACK) + SLACK >= bound)]
                for norm, bound in zip(norms, low, strict=True)
            ]
            yield pa.StructArray.from_arrays(
                [pa.array(low, pa.float64()), pa.array(blocks, pa.list_(pa.int32()))], ["bound", "blocks"]
            )

    chunk = F.pmod(F.xxhash64("vec_id"), F.lit(chunks)).cast("int").alias("chunk")
    asked = rows.filter(is_query).select("vec_id", "vector", bounds("vec_id", "vector").alias("limit"), chunk)
    asked = asked.select("vec_id", "vector", "chunk", "limit.bound", "limit.blocks")
    found = in_blocks(ranged.drop("norm"), asked, lambda a, b: search_block(a, b, k), FOUND, chunks)
    return best(found, k)
