"""SimHash near-duplicates through a Gray-order hierarchical index.

Two fingerprints within ``max_bits`` differing bits share at least two of ``BLOCKS`` bit blocks
unchanged, so each pair meets in the bucket of such a block pair. In a bucket the fingerprints are
sorted by Gray rank; every few neighbours get an upper node that keeps the bits they share as a
masked pattern, level by level. Pairs of nodes are compared from the top: differences accumulate as
lower nodes share more bits, and a pair of whole groups is dropped once they exceed the limit. A
node whose members differ in at most ``max_bits`` places is one linked group without a comparison.

A bucket returns a spanning forest of its links, not its pairs. A bucket of more than
``MAX_BUCKET`` fingerprints is cut into even slices by hash, and every pair of slices is a group of
its own with its own index, so that nothing is lost and no group is unbounded.

Defined results: null and empty texts have fingerprint zero and are linked like any other; repeated
rows and copies share a fingerprint and so a component; ``component_id`` is the smallest non-null
doc_id of the component (null if it has none); an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkvigil.llm.columns import fresh
from sparkvigil.llm.components import connected_components
from sparkvigil.session import stage

BITS = 64
SHINGLE_WORDS = 4
MAX_BITS = 4
SEED = 42
BLOCKS = 6
# Children of an index node, and most fingerprints of a bucket that are compared as one group.
FANOUT = 8
MAX_BUCKET = 4096
# Node pairs that are compared at a time.
PAIR_STEP = 1 << 18

BIT_ORDER = np.arange(BITS, dtype=np.uint64)


def shingle_hashes(text: str | None, words: int = SHINGLE_WORDS, seed: int = SEED) -> list[int]:
    """Hashes of all runs of ``words`` words; a shorter text is one run."""
    parts = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not parts:
        return []
    joined = b" ".join(parts)
    ends = np.cumsum([len(p) + 1 for p in parts]) - 1
    first = np.r_[0, ends[:-1] + 1]
    n = max(1, len(parts) - words + 1)
    return [
        xxhash.xxh64_intdigest(joined[a:b], seed)
        for a, b in zip(first[:n].tolist(), ends[-n:].tolist(), strict=True)
    ]


def fingerprint_of(text: str | None, words: int = SHINGLE_WORDS, seed: int = SEED) -> int:
    """The fingerprint of one text: each bit is 1 if set in over half of the shingle hashes."""
    return fingerprint_of_hashes(np.array(shingle_hashes(text, words, seed), dtype="<u8"))


def fingerprint_of_hashes(hashed: np.ndarray) -> int:
    n = len(hashed)
    if not n:
        return 0
    rows = hashed.view(np.uint8).reshape(-1, 8)
    counts = np.zeros(BITS, dtype=np.int64)
    for start in range(0, n, 255):
        bits = np.unpackbits(rows[start : start + 255], axis=1, bitorder="little")
        counts += np.add.reduce(bits, axis=0, dtype=np.uint8)
    return int(((counts * 2 > n).astype(np.uint64) << BIT_ORDER).sum())


def with_fingerprints(docs: DataFrame, name: str, words: int = SHINGLE_WORDS, seed: int = SEED) -> DataFrame:
    """``docs`` with its fingerprint as a signed long in the new column ``name``."""

    @F.arrow_udf("bigint")
    def fingerprints(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            found = [fingerprint_of(t, words, seed) for t in batch.to_pylist()]
            yield pa.array(np.array(found, dtype=np.uint64).view(np.int64))

    return docs.withColumn(name, fingerprints(F.col("text")))


def gray_rank(fp: np.ndarray) -> np.ndarray:
    """The place of each code in Gray order: the prefix exclusive-or of its bits."""
    rank = fp.copy()
    for shift in (1, 2, 4, 8, 16, 32):
        rank ^= rank >> np.uint64(shift)
    return rank


def shared_bits(mask: np.ndarray, pattern: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Mask and pattern of the bits that all children of each parent share."""
    ones = np.bitwise_and.reduceat(pattern & mask, starts)
    zeros = np.bitwise_and.reduceat(~pattern & mask, starts)
    return ones | zeros, ones


class GrayIndex:
    """Levels of masked patterns over fingerprints sorted by (group, Gray rank)."""

    def __init__(self, group: np.ndarray, fp: np.ndarray):
        self.levels = [(np.full(len(fp), ~np.uint64(0)), fp, np.arange(len(fp) + 1))]
        while True:
            mask, pattern, _ = self.levels[-1]
            at = np.r_[True, group[1:] != group[:-1]]
            if at.all():
                break
            place = np.arange(len(group)) - np.maximum.accumulate(np.where(at, np.arange(len(group)), 0))
            starts = np.flatnonzero(place % FANOUT == 0)
            self.levels.append((*shared_bits(mask, pattern, starts), np.r_[starts, len(group)]))
            group = group[starts]

    def links(self, max_bits: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs of positions that, with what they chain together, are all links of every group."""
        top = len(self.levels) - 1
        roots = np.arange(len(self.levels[top][1]))
        stack = [(top, roots, roots)]
        while stack:
            level, a, b = stack.pop()
            if len(a) > PAIR_STEP:
                half = len(a) // 2
                stack += [(level, a[:half], b[:half]), (level, a[half:], b[half:])]
                continue
            mask, pattern, children = self.levels[level]
            close = np.bitwise_count((pattern[a] ^ pattern[b]) & mask[a] & mask[b]) <= max_bits
            a, b = a[close], b[close]
            if level == 0:
                yield a[a != b], b[a != b]
                continue
            same = (a == b) & (BITS - np.bitwise_count(mask[a]) <= max_bits)
            if same.any():
                yield self.chain(level, a[same])
                a, b = a[~same], b[~same]
            if len(a):
                stack.append((level - 1, *self.expand(children, a, b)))

    def chain(self, level: int, nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Neighbouring members of nodes that are linked as a whole."""
        lo, hi = nodes, nodes + 1
        for _, _, children in reversed(self.levels[1 : level + 1]):
            lo, hi = children[lo], children[hi]
        size = hi - lo - 1
        left = np.repeat(lo, size) + np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
        return left, left + 1

    @staticmethod
    def expand(children: np.ndarray, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        wide, high = children[a + 1] - children[a], children[b + 1] - children[b]
        many = wide * high
        pair = np.repeat(np.arange(len(a)), many)
        nth = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
        left, right = children[a][pair] + nth // high[pair], children[b][pair] + nth % high[pair]
        keep = left <= right
        return left[keep], right[keep]


def forest(links: Iterator[tuple[np.ndarray, np.ndarray]], n: int) -> np.ndarray:
    """The smallest position linked to each position, from batches of links."""
    label = np.arange(n)
    for a, b in links:
        a, b = label[a], label[b]
        while (differ := a != b).any():
            a, b = a[differ], b[differ]
            np.minimum.at(label, np.maximum(a, b), np.minimum(a, b))
            while not np.array_equal(jumped := label[label], label):
                label = jumped
            a, b = label[a], label[b]
    return label


def linked(frames: Iterator[pd.DataFrame], max_bits: int) -> Iterator[pd.DataFrame]:
    """Edges (fingerprint, smallest linked one) of buckets that arrive sorted and whole."""
    for frame in whole_groups(frames):
        fp = frame["fp"].to_numpy().view(np.uint64)
        group = pd.factorize(frame["bucket"])[0]
        order = np.lexsort((gray_rank(fp), group))
        fp, group = fp[order], group[order]
        root = forest(GrayIndex(group, fp).links(max_bits), len(fp))
        moved = root != np.arange(len(fp))
        yield pd.DataFrame({"a": fp[moved].view(np.int64), "b": fp[root[moved]].view(np.int64)})


def whole_groups(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Cut a stream that is sorted by bucket so that no bucket is split between two frames."""
    rest = None
    for frame in frames:
        frame = frame if rest is None else pd.concat([rest, frame], ignore_index=True)
        last = frame["bucket"].to_numpy() == frame["bucket"].iloc[-1] if len(frame) else np.array([], bool)
        rest, frame = frame[last], frame[~last]
        if len(frame):
            yield frame
    if rest is not None and len(rest):
        yield rest


def bucket_keys(max_bits: int) -> list:
    """One column per choice of blocks: the choice and the bits of the chosen blocks.

    Of ``BLOCKS`` blocks at most ``max_bits`` can change, so some choice of the others stays equal.
    """
    edges = [BITS * i // BLOCKS for i in range(BLOCKS + 1)]
    masks = [((1 << b) - 1) ^ ((1 << a) - 1) for a, b in zip(edges, edges[1:], strict=False)]
    keys = []
    for i, chosen in enumerate(combinations(masks, BLOCKS - max_bits)):
        mask = sum(chosen)
        signed = mask - (1 << BITS) if mask >> (BITS - 1) else mask
        keys.append(F.struct(F.lit(i).alias("choice"), F.col("fp").bitwiseAND(F.lit(signed)).alias("bits")))
    return keys


def fingerprint_links(prints: DataFrame, max_bits: int = MAX_BITS, max_bucket: int = MAX_BUCKET) -> DataFrame:
    """Edges (a, b) that join all distinct fingerprints ``fp`` within ``max_bits`` of each other."""
    if not 0 < max_bits < BLOCKS:
        raise ValueError(f"max_bits must be between 1 and {BLOCKS - 1}")
    entries = prints.select("fp", F.explode(F.array(*bucket_keys(max_bits))).alias("key"))
    sizes = entries.groupBy("key").agg(F.count(F.lit(1)).alias("size")).filter("size > 1")
    entries = entries.join(sizes, "key")
    small = entries.filter(F.col("size") <= max_bucket).select(
        F.struct("key.choice", "key.bits", F.lit(0).alias("i"), F.lit(0).alias("j")).alias("key"), "fp"
    )
    both = small.unionByName(slices(entries.filter(F.col("size") > max_bucket), max_bucket))
    # The bucket travels as one number; two keys that hash alike are only compared as one bucket.
    keyed = both.select(F.xxhash64("key.choice", "key.bits", "key.i", "key.j").alias("bucket"), "fp")
    grouped = keyed.repartition("bucket").sortWithinPartitions("bucket")
    return grouped.mapInPandas(lambda frames: linked(frames, max_bits), "a bigint, b bigint")


def slices(entries: DataFrame, max_bucket: int) -> DataFrame:
    """Fingerprints of large buckets, once for every pair of slices their own slice is in.

    A slice holds about ``max_bucket / 2`` fingerprints; two slices, or one alone, make a group.
    """
    many = F.ceil(F.col("size") / F.lit(max_bucket // 2)).cast("int")
    cut = entries.withColumn("n", many).withColumn("i", F.pmod(F.xxhash64("fp"), F.col("n")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("n") - 1)).alias("j")
    paired = cut.select("key", "fp", "i", other)
    return paired.select(
        F.struct("key.choice", "key.bits", F.least("i", "j").alias("i"), F.greatest("i", "j").alias("j")).alias("key"),
        "fp",
    )


def with_components(prints: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """Stored rows (doc_id, fp and others) with the smallest doc_id of their component."""
    groups = stage(prints.groupBy("fp").agg(F.min("doc_id").alias("least")), "fingerprints")
    edges = fingerprint_links(groups.select("fp"), max_bits).distinct()
    roots = connected_components(edges).select(F.col("node").alias("fp"), "root")
    known = groups.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    least = known.groupBy("root").agg(F.min("least").alias("component_id"))
    members = known.select("fp", "root").join(least, "root").select("fp", "component_id")
    return prints.join(members, "fp")


def near_duplicates(docs: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """doc_id, fp, component_id of every row of ``docs``."""
    prints = with_fingerprints(docs.select("doc_id", "text"), "fp").select("doc_id", "fp")
    return with_components(stage(prints, "prints"), max_bits).select("doc_id", "fp", "component_id")


def keep_one(docs: DataFrame) -> DataFrame:
    """``docs`` with one row of every group of near copies: its smallest doc_id (null last), then row hash.

    Near copies are linked as ``near_copies`` defines it: this index and min-hash bands find candidates,
    the Jaccard similarity of five-word shingles decides. Rows are told apart by doc_id and a hash of all columns; exact copies of a row are one.
    """
    from sparkvigil.llm import near_copies

    tag, keep_id, keep_tag = fresh(docs, "tag", "keep_id", "keep_tag")
    row_hash = F.xxhash64(*docs.columns)
    narrow = docs.select("doc_id", row_hash.alias("tag"), "text")
    prints = near_copies.with_sketches(narrow, "found", near_copies.WORDS).select("doc_id", "tag", "found.*")
    prints = stage(prints, "prints")
    roots = near_copies.near_copy_roots(prints, narrow)
    found = prints.select("doc_id", "tag", "fp").join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    # Ids that are null come last.
    order = F.struct(F.col("doc_id").isNull().alias("missing"), "doc_id", "tag")
    chosen = (
        found.groupBy("root")
        .agg(F.min(order).alias("first"))
        .select(F.col("first.doc_id").alias(keep_id), F.col("first.tag").alias(keep_tag))
    )
    match = F.col("doc_id").eqNullSafe(F.col(keep_id)) & (F.col(tag) == F.col(keep_tag))
    kept = docs.withColumn(tag, row_hash).join(chosen, match, "left_semi").drop(tag)
    # Only a table with repeated rows pays for the comparison of whole rows.
    repeated = prints.groupBy("doc_id", "tag").count().filter("count > 1")
    return kept if repeated.isEmpty() else kept.dropDuplicates()
