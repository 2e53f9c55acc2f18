"""Benchmark passages in documents by Wu-Manber search over words.

A pattern is a window of ``WINDOW`` consecutive words of a benchmark item; an item of fewer words is
one window. Patterns of one length share a shift table and buckets: the block of the last two words
of the search window says how far the window may move without missing any pattern (by the whole
window where the block is in none), and where it may not move, the buckets of its last and
first block select whether it is compared, word by word, with the patterns.

The benchmark is the pattern set. It is cut into blocks of at most ``BLOCK_WORDS`` words; the tables
of one block are all that the driver and a task hold. One block is the usual case and one pass over
the documents; more blocks are one pass each over the stored texts, and their hits meet by row.

Defined results: null and empty texts, and texts of separators only, have no words, as documents and
as items. Windows that several items share count for each of them; rows of one item_id, null
included, are one item. Repeated documents are rows of their own, null ids too; a very long text is
searched in pieces whose windows overlap. Only doc_id, item_id and text are read, whatever else the
tables hold; an empty benchmark hits nothing.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkvigil.llm.columns import text_slices
from sparkvigil.session import stage

WINDOW = 10
# Words of one block of benchmark items, and of one slice of a long item.
BLOCK_WORDS = 1 << 18
SLICE_WORDS = 1 << 14
# Bytes of a text that are words at one time.
PIECE_BYTES = 1 << 20

# A-Z in lower case; 0-9, a-z and every byte of other letters stay; all else separates.
FOLD = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256)
)
HITS = "struct<words:bigint,spans:array<struct<start:bigint,end:bigint>>,items:array<bigint>,no_id:boolean>"
HITS_ARROW = pa.struct(
    [
        ("words", pa.int64()),
        ("spans", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
        ("items", pa.list_(pa.int64())),
        ("no_id", pa.bool_()),
    ]
)


def words_of(text: bytes | None) -> list[bytes]:
    return (text or b"").translate(FOLD).split()


@dataclass
class Length:
    """Tables of the patterns of one length."""

    words: int
    block: int
    # Moves by block; (last block, first block) of the patterns; items by pattern.
    shift: dict = field(default_factory=dict)
    buckets: set = field(default_factory=set)
    items: dict = field(default_factory=dict)

    def add(self, pattern: tuple[bytes, ...], item: int | None) -> None:
        b = self.block
        for end in range(b, self.words + 1):
            key = pattern[end - b : end]
            self.shift[key] = min(self.shift.get(key, self.words), self.words - end)
        self.buckets.add(pattern[-b:] + pattern[:b])
        self.items[pattern] = (*self.items.get(pattern, ()), item)

    def search(self, words: list[bytes]) -> Iterator[tuple[int, frozenset]]:
        """(start, items) of every occurrence."""
        m, b, n = self.words, self.block, len(words)
        shift, buckets, free = self.shift, self.buckets, m - b + 1
        end = m
        while end <= n:
            last = tuple(words[end - b : end])
            move = shift.get(last, free)
            if move:
                end += move
                continue
            start = end - m
            if last + tuple(words[start : start + b]) in buckets:
                items = self.items.get(tuple(words[start:end]))
                if items:
                    yield start, items
            end += 1


class Patterns:
    """Windows of benchmark items, by their length."""

    def __init__(self, items: Iterable[tuple[int | None, list[bytes]]]) -> None:
        self.lengths: dict[int, Length] = {}
        for item, words in items:
            m = min(WINDOW, len(words))
            if not m:
                continue
            if m not in self.lengths:
                self.lengths[m] = Length(m, min(2, m))
            for at in range(len(words) - m + 1):
                self.lengths[m].add(tuple(words[at : at + m]), item)
        for length in self.lengths.values():
            one_per_set(length)

    def scan(self, text: bytes | None) -> dict:
        """Number of words, spans of words that are hit, and the items that hit."""
        spans: list[list[int]] = []
        found: dict[int, frozenset] = {}
        total, carried = 0, []
        for piece in pieces(text):
            words = carried + piece.split()
            before = total - len(carried)
            hits = []
            for length in self.lengths.values():
                # A window that ends within the carried words has been seen with the last piece.
                seen = len(carried) - length.words
                for start, items in length.search(words):
                    if start > seen:
                        hits.append((before + start, before + start + length.words))
                        found[id(items)] = items
            total += len(words) - len(carried)
            carried = words[max(0, len(words) - WINDOW + 1) :]
            merge(spans, sorted(hits))
        items = set().union(*found.values())
        known = sorted(i for i in items if i is not None)
        spread = [{"start": a, "end": b} for a, b in spans]
        return {"words": total, "spans": spread, "items": known, "no_id": None in items}


def one_per_set(length: Length) -> None:
    """Equal sets of items become one object, so a text unites each of them once."""
    kept: dict[frozenset, frozenset] = {}
    for pattern, items in length.items.items():
        alike = frozenset(items)
        length.items[pattern] = kept.setdefault(alike, alike)


def pieces(text: bytes | None) -> Iterator[bytes]:
    """A text folded, in parts that end between words."""
    text, at = text or b"", 0
    while at < len(text):
        part = text[at : at + PIECE_BYTES].translate(FOLD)
        if at + len(part) < len(text):
            size = PIECE_BYTES
            while not (cut := part.rfind(b" ") + 1) and at + size < len(text):  # a word longer than a piece
                size *= 2
                part = text[at : at + size].translate(FOLD)
            part = part[: cut or len(part)]
        at += len(part)
        yield part


def merge(spans: list[list[int]], found: list[tuple[int, int]]) -> None:
    """Add sorted spans to merged ones; touching spans stay apart, overlapping ones are one."""
    for start, end in found:
        # A shorter window found now may lie before the last span of an earlier piece.
        if spans and start < spans[-1][1]:
            while len(spans) > 1 and start < spans[-2][1]:
                last = spans.pop()
                spans[-1][1] = max(spans[-1][1], last[1])
            spans[-1][0] = min(spans[-1][0], start)
            spans[-1][1] = max(spans[-1][1], end)
        else:
            spans.append([start, end])


def item_slices(benchmark: DataFrame) -> DataFrame:
    """item_id and words of the slices of the items; neighbouring slices share WINDOW - 1 words."""
    kind = pa.list_(pa.list_(pa.binary()))

    @F.arrow_udf("array<array<binary>>")
    def cut(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            out = []
            for text in batch.cast(pa.binary()).to_pylist():
                words = words_of(text)
                ends = range(0, max(1, len(words) - WINDOW + 1), SLICE_WORDS)
                out.append([words[a : a + SLICE_WORDS + WINDOW - 1] for a in ends])
            yield pa.array(out, kind)

    slices = benchmark.select("item_id", F.explode(cut(F.col("text"))).alias("words"))
    return slices.filter(F.size("words") > 0)


def pattern_blocks(benchmark: DataFrame, block_words: int) -> list[DataFrame]:
    """The slices in blocks by hash, counted to hold at most ``block_words`` words or one slice each."""
    slices = stage(item_slices(benchmark), "benchmark")
    total = slices.agg(F.sum(F.size("words"))).first()[0] or 0
    if total <= block_words:
        return [slices] if total else []
    count = -(-2 * total // block_words)
    while True:
        block = F.pmod(F.xxhash64("item_id", "words"), F.lit(count))
        sizes = slices.groupBy(block.alias("block")).agg(F.sum(F.size("words")).alias("n"), F.count(F.lit(1)).alias("slices"))
        if sizes.filter((F.col("n") > block_words) & (F.col("slices") > 1)).isEmpty() or count >= total:
            return [slices.filter(block == b) for b in range(count)]
        count *= 2


def with_hits(docs: DataFrame, slices: DataFrame, name: str) -> DataFrame:
    """``docs`` with the hits of one block of patterns in the new column ``name``."""
    spark = docs.sparkSession
    patterns = spark.sparkContext.broadcast(Patterns((r["item_id"], [bytes(w) for w in r["words"]]) for r in slices.collect()))

    @F.arrow_udf(HITS)
    def hits(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        tables = patterns.value
        for batch in batches:
            for part in text_slices(batch):
                yield pa.array([tables.scan(t) for t in part.cast(pa.binary()).to_pylist()], HITS_ARROW)

    return docs.withColumn(name, hits(F.col("text")))


def find_overlaps(docs: DataFrame, benchmark: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """doc_id, words, spans (start, end) of hit words, items and no_id of every document.

    ``items`` are the distinct item_ids with an occurring window, ascending; ``no_id`` tells whether
    items without an id are among those that occur.
    """
    docs = docs.select("doc_id", "text")
    blocks = pattern_blocks(benchmark, block_words)
    if len(blocks) <= 1:
        empty = benchmark.limit(0).select("item_id", F.array().cast("array<binary>").alias("words"))
        return with_hits(docs, blocks[0] if blocks else empty, "hits").select("doc_id", "hits.*")
    rows = stage(docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", "text"), "documents")
    parts = None
    for block in blocks:
        found = with_hits(rows.select("row", "text"), block, "hits").select("row", "hits.*")
        found = stage(found.filter((F.size("spans") > 0) | (parts is None)), "hits")
        parts = found if parts is None else parts.unionByName(found)
    # At most one row a document and block.
    grouped = parts.groupBy("row").agg(
        F.max("words").alias("words"),
        F.array_sort(F.flatten(F.collect_list("spans"))).alias("spans"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
        F.bool_or("no_id").alias("no_id"),
    )
    return rows.select("row", "doc_id").join(grouped.withColumn("spans", united()), "row").drop("row")


def united():
    """Sorted spans with overlapping ones made one."""
    empty = F.array().cast("array<struct<start:bigint,end:bigint>>")

    def add(done, span):
        last = F.try_element_at(done, F.lit(-1))
        joined = F.struct(last["start"].alias("start"), F.greatest(last["end"], span["end"]).alias("end"))
        return F.when(
            (F.size(done) > 0) & (span["start"] < last["end"]),
            F.concat(F.slice(done, 1, F.size(done) - 1), F.array(joined)),
        ).otherwise(F.concat(done, F.array(span)))

    return F.aggregate("spans", empty, add)
