"""Near copies by SimHash through its Gray-order index, min-hash bands for what lies further apart, and
an exact check of the Jaccard similarity of word shingles.

Equal sets of shingles are one entry. Entries whose fingerprints differ in at most
``simhash.MAX_BITS`` bits are linked by the index of ``simhash``. Pairs of Jaccard 0.8 often differ
in more bits, so each entry also has ``HASHES`` minimum hashes; entries that agree on one of the
bands of ``BAND_ROWS`` of them meet in a bucket (a pair of Jaccard 0.8 meets in none of 32 bands of
4 with a chance of 5e-8), where those whose sketches agree in a share of ``ROUGH`` or more are
linked. Both kinds of links make candidate groups; inside such a group every link is decided by the
exact similarity of the shingle sets. Chaining compares members with those that are not yet reached,
so a dense group costs about its size, and only spanning forests leave a task.

Buckets and groups above ``MAX_GROUP`` entries (groups also above ``MAX_WORDS`` words) are cut into
even slices by hash, and every pair of slices is a task group of its own.

Defined results: texts under ``words`` words have one shingle, their whole; null and empty texts
have the empty set and are copies of each other only.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkvigil.llm.columns import text_slices
from sparkvigil.llm.components import connected_components
from sparkvigil.llm.simhash import fingerprint_links, fingerprint_of_hashes, shingle_hashes, whole_groups
from sparkvigil.session import stage

WORDS = 5
LEAST = 0.8
HASHES = 128
BAND_ROWS = 4
# Six standard deviations of a sketch of a pair of Jaccard 0.8 below it: one such pair in 3e9 agrees
# less. 0 compares every pair of a bucket exactly.
ROUGH = 0.58
MAX_GROUP = 4096
MAX_WORDS = 1 << 22
STEP = 1024

_rng = np.random.default_rng(5)
FLIPS = _rng.integers(0, 1 << 32, (HASHES, 1), dtype=np.uint32)
FACTORS = _rng.integers(0, 1 << 32, (HASHES, 1), dtype=np.uint32) | np.uint32(1)


def shingle_set(text: str | None, words: int) -> np.ndarray:
    return np.unique(np.array(shingle_hashes(text, words), dtype=np.uint64))


def minima(shingles: np.ndarray) -> np.ndarray:
    """The minimum of each of the ``HASHES`` hashes over a set."""
    out = np.full(HASHES, ~np.uint32(0), dtype=np.uint32)
    high = (shingles >> np.uint64(32)).astype(np.uint32)
    for at in range(0, len(high), STEP):
        np.minimum(out, ((high[at : at + STEP] ^ FLIPS) * FACTORS).min(axis=1), out=out)
    return out


def with_sketches(docs: DataFrame, name: str, words: int) -> DataFrame:
    """``docs`` with (fp: hash of the set, size, bands, sketch, simhash) of its text in the column ``name``."""
    kind = pa.struct(
        [("fp", pa.int64()), ("size", pa.int32()), ("bands", pa.list_(pa.int64())), ("sketch", pa.binary()),
         ("simhash", pa.int64())]
    )

    def of(text: str | None) -> dict:
        shingles = shingle_set(text, words)
        least = minima(shingles)
        parts = least.reshape(-1, BAND_ROWS)
        keys = np.array([xxhash.xxh64_intdigest(p.tobytes(), i) for i, p in enumerate(parts)], dtype=np.uint64)
        fp = np.array([xxhash.xxh64_intdigest(shingles.tobytes())], dtype=np.uint64)
        return {
            "fp": int(fp.view(np.int64)[0]), "size": len(shingles),
            "bands": keys.view(np.int64), "sketch": least.astype(np.uint8).tobytes(),
            "simhash": int(np.uint64(fingerprint_of_hashes(shingles)).astype(np.int64)),
        }

    @F.arrow_udf("struct<fp:bigint,size:int,bands:array<bigint>,sketch:binary,simhash:bigint>")
    def sketches(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for part in (part for batch in batches for part in text_slices(batch)):
            yield pa.array([of(t) for t in part.to_pylist()], kind)

    return docs.withColumn(name, sketches(F.col("text")))


def chained(n: int, close: Callable[[int, np.ndarray], np.ndarray]) -> np.ndarray:
    """The first member of each one's chain; ``close`` says which of some members one is linked to."""
    root, left = np.arange(n), np.arange(n)
    while len(left):
        first, left = left[0], left[1:]
        reached = [first]
        while reached and len(left):
            near = close(reached.pop(), left)
            root[left[near]] = first
            reached += left[near].tolist()
            left = left[~near]
    return root


def rough_links(frame: pd.DataFrame, rough: float) -> np.ndarray:
    """Chains of one bucket by the share of equal places of the sketches."""
    codes = np.frombuffer(b"".join(frame["sketch"]), dtype=np.uint8).reshape(len(frame), HASHES)
    return chained(len(frame), lambda x, left: (codes[left] == codes[x]).sum(axis=1) >= rough * HASHES)


def exact_links(frame: pd.DataFrame, words: int, least: float) -> np.ndarray:
    """Chains of one candidate group by the exact similarity of the shingle sets."""
    sets = [shingle_set(t, words) for t in frame["text"]]
    size = np.array([len(s) for s in sets])
    codes = np.unique(np.concatenate(sets), return_inverse=True)[1]
    start = np.cumsum(size) - size
    mark = np.zeros(len(codes), dtype=bool)

    def close(x: int, left: np.ndarray) -> np.ndarray:
        out = np.zeros(len(left), dtype=bool)
        fit = np.flatnonzero((size[left] >= least * size[x]) & (least * size[left] <= size[x]) & (size[left] > 0))
        if not len(fit):
            return out
        own = codes[start[x] : start[x] + size[x]]
        mark[own] = True
        many = size[left[fit]]
        heads = np.cumsum(many) - many
        at = np.repeat(start[left[fit]] - heads, many) + np.arange(many.sum())
        common = np.add.reduceat(mark[codes[at]], heads, dtype=np.int64)
        mark[own] = False
        out[fit] = common + 1e-9 >= least * (many + size[x] - common)
        return out

    return chained(len(frame), close)


def forests(frames: Iterator[pd.DataFrame], chains: Callable[[pd.DataFrame], np.ndarray]) -> Iterator[pd.DataFrame]:
    """Edges (entry, first of its chain) of task groups that arrive sorted and whole."""
    for frame in whole_groups(frames):
        bucket = frame["bucket"].to_numpy()
        edges = np.r_[0, np.flatnonzero(np.diff(bucket)) + 1, len(bucket)]
        fp, root = frame["fp"].to_numpy(), np.arange(len(frame))
        for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
            if b - a > 1:
                root[a:b] = a + chains(frame.iloc[a:b])
        moved = root != np.arange(len(frame))
        yield pd.DataFrame({"a": fp[moved], "b": fp[root[moved]]})


def slice_count(column: str, most: int) -> Column:
    """Slices of which two hold about ``most``."""
    return F.when(F.col(column) <= most, F.lit(1)).otherwise(F.ceil(F.col(column) / F.lit(most // 2)))


def in_slices(entries: DataFrame, key: str, many: Column) -> DataFrame:
    """``entries`` with their task group in ``bucket``: once, or once for every pair with their slice."""
    cut = entries.withColumn("n", many.cast("int")).withColumn("i", F.pmod(F.xxhash64("fp"), F.col("n")).cast("int"))
    paired = cut.withColumn("j", F.explode(F.sequence(F.lit(0), F.col("n") - 1)))
    bucket = F.xxhash64(key, F.least("i", "j"), F.greatest("i", "j"))
    # Of two slices or more, a slice alone is in each of its pairs.
    needed = (F.col("n") == 1) | (F.col("i") != F.col("j"))
    return paired.filter(needed).withColumn("bucket", bucket).drop("n", "i", "j", key)


def simhash_links(sets: DataFrame) -> DataFrame:
    """Edges (a, b) that join all entries with fingerprints that are equal or linked by the Gray index."""
    centres = stage(sets.groupBy("simhash").agg(F.min("fp").alias("fp")), "centres")
    equal = sets.select("simhash", F.col("fp").alias("a")).join(centres, "simhash").filter("a <> fp")
    links = fingerprint_links(centres.select(F.col("simhash").alias("fp"))).distinct()
    first, second = (centres.select(F.col("simhash").alias(c), F.col("fp").alias(f"fp_{c}")) for c in ("a", "b"))
    near = links.join(first, "a").join(second, "b").select(F.col("fp_a").alias("a"), F.col("fp_b").alias("b"))
    return near.union(equal.select("a", F.col("fp").alias("b")))


def candidate_groups(sets: DataFrame, rough: float = ROUGH) -> DataFrame:
    """(fp, root) of all entries of ``sets`` (fp, bands, sketch, simhash) that may have a near copy."""
    entries = sets.select("fp", F.explode("bands").alias("key"))
    sizes = entries.groupBy("key").agg(F.count(F.lit(1)).alias("entries")).filter("entries > 1")
    met = in_slices(entries.join(sizes, "key"), "key", slice_count("entries", MAX_GROUP))
    met = met.select("fp", "bucket").join(sets.select("fp", "sketch"), "fp")
    grouped = met.select("bucket", "fp", "sketch").repartition("bucket").sortWithinPartitions("bucket")
    edges = grouped.mapInPandas(lambda frames: forests(frames, lambda f: rough_links(f, rough)), "a bigint, b bigint")
    edges = edges.union(simhash_links(sets))
    return connected_components(edges.distinct()).select(F.col("node").alias("fp"), "root")


def near_copy_roots(
    prints: DataFrame, docs: DataFrame, words: int = WORDS, least: float = LEAST, rough: float = ROUGH
) -> DataFrame:
    """(fp, root) of every entry with a near copy.

    ``prints``: stored rows (tag, fp, size, bands, sketch, simhash); ``docs``: the texts by ``tag``.
    """
    sets = stage(prints.groupBy("fp").agg(
        F.min("tag").alias("tag"), F.first("size").alias("size"),
        F.first("bands").alias("bands"), F.first("sketch").alias("sketch"),
        F.first("simhash").alias("simhash"),
    ), "sets")
    groups = stage(candidate_groups(sets, rough), "groups").join(sets.select("fp", "tag", "size"), "fp")
    sums = groups.groupBy("root").agg(F.count(F.lit(1)).alias("entries"), F.sum("size").alias("shingles"))
    many = F.greatest(slice_count("entries", MAX_GROUP), slice_count("shingles", MAX_WORDS))
    tasks = in_slices(groups.join(sums, "root"), "root", many).select("bucket", "fp", "tag")
    texts = docs.select("tag", "text").join(groups.select("tag"), "tag", "left_semi").dropDuplicates(["tag"])
    grouped = tasks.join(texts, "tag").select("bucket", "fp", "text").repartition("bucket").sortWithinPartitions("bucket")
    edges = grouped.mapInPandas(
        lambda frames: forests(frames, lambda f: exact_links(f, words, least)), "a bigint, b bigint"
    )
    return connected_components(edges.distinct()).select(F.col("node").alias("fp"), "root")
