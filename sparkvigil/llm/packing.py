"""Best-fit packing of tokenised documents by linear grouping.

Lengths are whole numbers up to the sequence capacity, so a histogram of at most ``capacity`` rows
describes the packing problem whatever the corpus size. Large lengths are rounded up to the largest
of their equal-cardinality group, the few rounded sizes are packed by a linear programme over
configurations (column generation), real lengths take the rounded places, the last place of a
configuration the largest real length that its true room holds, and everything left is best-fitted
into the remaining room. What counts as large is tried with each of ``LARGE_SHARES``; the plan with
the fewest sequences is taken. The plan works on runs of equal sequences; Spark ranks the pieces
within their length and looks their places up.

Defined results: a null or empty text is the end token alone; repeated rows are packed as often as
they occur; pieces of one length are interchangeable, so ties only affect which copy goes where; an
empty table gives an empty result; columns other than the two named ones are ignored.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sparkvigil.llm.columns import text_slices
from sparkvigil.session import stage

CAPACITY = 1024
END_ID = 2
# Lengths above such a share of the capacity are grouped; the rest is best-fitted. Above a half, a
# configuration has one place.
LARGE_SHARES = (0.2, 0.5)
# Most groups of the rounding.
MAX_GROUPS = 128
# The linear programme ends when it is this close to its own lower bound.
GAP = 5e-4
# Pieces of one length that are ranked together.
BUCKET_ROWS = 4096

PIECES = "array<struct<piece:int,start:bigint,length:bigint,ids:binary>>"


@lru_cache(maxsize=2)
def load_encoder(path: str):
    """A byte-level BPE encoder from a file of ranks; ids equal those of the JSON form of the file."""
    import public_tokenizers
    import tiktoken

    with open(path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    special = {"<|endoftext|>": len(ranks)}
    return tiktoken.Encoding(
        "corpus", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=special
    )


def cut(ids: np.ndarray, capacity: int) -> list[dict]:
    """Pieces of one document: all of ``capacity`` tokens but the first, which may be shorter."""
    first = len(ids) % capacity or min(len(ids), capacity)
    edges = [0, *range(first, len(ids) + 1, capacity)]
    return [
        {"piece": i, "start": a, "length": b - a, "ids": ids[a:b].astype("<u4").tobytes()}
        for i, (a, b) in enumerate(zip(edges, edges[1:], strict=False))
    ]


def tokenize(
    docs: DataFrame, vocabulary: str, capacity: int = CAPACITY, end_id: int = END_ID
) -> DataFrame:
    """doc_id, piece, start, length, ids (little-endian unsigned 32-bit) of every piece."""

    @F.arrow_udf(PIECES)
    def pieces(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        encoder = load_encoder(vocabulary)
        kind = pa.list_(
            pa.struct(
                [("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids", pa.binary())]
            )
        )
        for texts in (part for batch in batches for part in text_slices(batch)):
            out = []
            for text in texts.to_pylist():
                ids = encoder.encode_to_numpy(text or "", allowed_special="all")
                out.append(cut(np.append(ids, np.uint32(end_id)), capacity))
            yield pa.array(out, kind)

    return docs.select("doc_id", F.inline(pieces(F.col("text"))))


def group_sizes(lengths: np.ndarray, counts: np.ndarray, groups: int) -> np.ndarray:
    """The rounded size of each (ascending) length: the largest of its equal-cardinality group."""
    rank = np.cumsum(counts) - counts
    group = rank * groups // max(1, counts.sum())
    last = np.r_[group[1:] != group[:-1], True]
    return lengths[last][np.searchsorted(group[last], group)]


def best_configuration(sizes: np.ndarray, values: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """The configuration of largest value: an unbounded knapsack over the few sizes."""
    best, take = np.zeros(capacity + 1), np.full(capacity + 1, -1)
    order = np.argsort(sizes)
    small, worth = sizes[order], values[order]
    fits = np.searchsorted(small, np.arange(capacity + 1), side="right")
    for room in range(1, capacity + 1):
        best[room] = best[room - 1]
        if fits[room]:
            sums = worth[: fits[room]] + best[room - small[: fits[room]]]
            i = int(sums.argmax())
            if sums[i] > best[room] + 1e-12:
                best[room], take[room] = sums[i], order[i]
    counts, room = np.zeros(len(sizes)), capacity
    while room > 0:
        if take[room] < 0:
            room -= 1
        else:
            counts[take[room]] += 1
            room -= sizes[take[room]]
    return float(best[capacity]), counts


def configurations(sizes: np.ndarray, demand: np.ndarray, capacity: int) -> list[tuple[np.ndarray, float]]:
    """(counts per size, sequences) of a near-optimal fractional packing of the rounded sizes."""
    k = len(sizes)
    columns = np.diag(np.floor(capacity / sizes).astype(float))
    inverse = np.diag(1 / np.diag(columns))
    amount = inverse @ demand
    for _ in range(8 * k + 200):
        price = inverse.sum(axis=0)
        value, column = best_configuration(sizes, np.maximum(price, 0), capacity)
        if value <= 1 + GAP:
            break
        step = inverse @ column
        up = step > 1e-9
        ratio = np.where(up, amount / np.where(up, step, 1), np.inf)
        out = int(ratio.argmin())
        amount = np.maximum(amount - ratio[out] * step, 0)
        amount[out] = ratio[out]
        columns[:, out] = column
        row = inverse[out] / step[out]
        inverse -= np.outer(step, row)
        inverse[out] = row
    return [(columns[:, j], amount[j]) for j in range(k) if amount[j] >= 1]


class Plan:
    """Runs of places: pieces ``rank..`` of a length go to sequences ``first..``, ``each`` per sequence."""

    def __init__(self, counts: dict[int, int], capacity: int):
        self.capacity, self.left, self.sequences = capacity, dict(counts), 0
        self.taken = dict.fromkeys(counts, 0)
        self.runs: list[tuple[int, int, int, int, int]] = []  # length, rank, first, each, offset
        self.open: dict[int, list[tuple[int, int]]] = {}  # room -> (first sequence, sequences)

    def place(self, length: int, first: int, sequences: int, each: int, used: int) -> None:
        self.runs.append((length, self.taken[length], first, each, used))
        self.taken[length] += sequences * each
        self.left[length] -= sequences * each

    def leave(self, room: int, first: int, sequences: int) -> None:
        if sequences:
            self.open.setdefault(room, []).append((first, sequences))

    def fill(self, parts: list[tuple[int, int, int]], candidates: list[int]) -> list[tuple[int, int, int]]:
        """Put into each of the runs (first, sequences, used) the first candidate that is left and fits.

        ``candidates`` are in descending order; those of which none are left any more are removed.
        """
        done = []
        while parts:
            first, many, used = parts.pop()
            while candidates and not self.left[candidates[0]]:
                candidates.pop(0)
            length = next((n for n in candidates if n <= self.capacity - used and self.left[n]), None)
            if length is None:
                done.append((first, many, used))
                continue
            now = min(many, self.left[length])
            self.place(length, first, now, 1, used)
            done.append((first, now, used + length))
            if now < many:
                parts.append((first + now, many - now, used))
        return done

    def substitute(self, members: list[list[int]], column: np.ndarray, sequences: int, lengths: list[int]) -> None:
        """Fill ``sequences`` new ones with real lengths of the groups of one configuration.

        Of several places, the smallest one gets the largest of all ``lengths`` that fits: that also
        uses the room which rounding up has left.
        """
        column = column.copy()
        several = column.sum() > 1
        if several:
            column[np.flatnonzero(column)[0]] -= 1
        parts = [(self.sequences, sequences, 0)]
        self.sequences += sequences
        for group in np.flatnonzero(column)[::-1]:
            for _ in range(int(column[group])):
                parts = self.fill(parts, members[group])
        for first, many, used in self.fill(parts, lengths) if several else parts:
            self.leave(self.capacity - used, first, many)

    def best_fit(self) -> None:
        """Everything left, longest first, each into the fullest sequence with room for it."""
        for length in sorted(self.left, reverse=True):
            while self.left[length]:
                room = min((r for r in self.open if r >= length), default=None)
                if room is None:
                    each = min(self.capacity // length, self.left[length])
                    many = self.left[length] // each
                    first, self.sequences = self.sequences, self.sequences + many
                    self.place(length, first, many, each, 0)
                    self.leave(self.capacity - each * length, first, many)
                    continue
                first, many = self.open[room].pop()
                if not self.open[room]:
                    del self.open[room]
                each = min(room // length, self.left[length])
                now = min(many, self.left[length] // each)
                self.place(length, first, now, each, self.capacity - room)
                self.leave(room - each * length, first, now)
                self.leave(room, first + now, many - now)


def plan_packing(counts: dict[int, int], capacity: int = CAPACITY) -> Plan:
    """The whole plan from the histogram {length: pieces}; its size depends on the capacity alone."""
    return min((plan_above(counts, capacity, share) for share in LARGE_SHARES), key=lambda plan: plan.sequences)


def plan_above(counts: dict[int, int], capacity: int, share: float) -> Plan:
    """The plan in which lengths above a share of the capacity are large."""
    plan = Plan(counts, capacity)
    large = np.array(sorted(n for n in counts if share * capacity < n < capacity), dtype=int)
    many = np.array([counts[n] for n in large], dtype=int)
    if len(large):
        few = len(large) <= MAX_GROUPS
        rounded = large if few else group_sizes(large, many, int(min(MAX_GROUPS, many.sum())))
        sizes, at = np.unique(rounded, return_inverse=True)
        demand = np.bincount(at, weights=many)
        members = [[int(n) for n in large[at == g][::-1]] for g in range(len(sizes))]
        lengths = sorted(counts, reverse=True)
        found = configurations(sizes, demand, capacity)
        for column, amount in sorted(found, key=lambda x: -x[1]):
            plan.substitute(members, column, int(amount), lengths)
    plan.best_fit()
    return plan


def pack(pieces: DataFrame, capacity: int = CAPACITY, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """``pieces`` (doc_id, piece, start, length and any digest columns) with sequence_id and offset.

    ``pieces`` must be a stored table of narrow columns: it is read twice. A length that holds most of
    the rows is ranked in hash buckets of about ``bucket_rows``, whose offsets come from their counts;
    rows that a document number does not tell apart are dealt by ``_row``, if there is one.
    """
    key = ["_row"] if "_row" in pieces.columns else pieces.columns
    histogram = pieces.groupBy("length").count().collect()  # at most ``capacity`` rows
    counts = {int(r["length"]): int(r["count"]) for r in histogram}
    plan = plan_packing(counts, capacity)
    # A length gets buckets by its own count: at most ``capacity`` entries.
    buckets = ", ".join(f"{n}L, {-(-many // bucket_rows)}L" for n, many in counts.items()) or "0L, 1L"
    keyed = pieces.withColumn("_bucket", F.pmod(F.xxhash64(*key), F.expr(f"map({buckets})[length]")))
    before = Window.partitionBy("length").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        keyed.groupBy("_bucket", "length")
        .agg(F.count(F.lit(1)).alias("_rows"))
        .select("_bucket", "length", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before"))
    )
    order = [c for c in pieces.columns if c != "length"]
    within = Window.partitionBy("_bucket", "length").orderBy(*order)
    ranked = (
        keyed.withColumn("_rank", F.row_number().over(within) - 1)
        .join(offsets, ["_bucket", "length"])
        .withColumn("_rank", F.col("_rank") + F.col("_before"))
        .drop("_bucket", "_before")
    )
    runs = np.array(sorted(plan.runs), dtype=np.int64).reshape(-1, 5)
    keys = (runs[:, 0] << 44) | runs[:, 1]

    @F.arrow_udf("struct<sequence_id:bigint,offset:bigint>")
    def places(length: pa.Array, rank: pa.Array) -> pa.Array:
        size, at = length.to_numpy(zero_copy_only=False), rank.to_numpy(zero_copy_only=False)
        run = runs[np.searchsorted(keys, (size << 44) | at, side="right") - 1]
        nth = at - run[:, 1]
        sequence = run[:, 2] + nth // run[:, 3]
        offset = run[:, 4] + nth % run[:, 3] * size
        return pa.StructArray.from_arrays([pa.array(sequence), pa.array(offset)], ["sequence_id", "offset"])

    placed = ranked.withColumn("_place", places("length", "_rank"))
    kept = [c for c in pieces.columns if c != "_row"]
    return placed.select(*kept, "_place.sequence_id", "_place.offset")


def pack_documents(docs: DataFrame, vocabulary: str, capacity: int = CAPACITY) -> DataFrame:
    """Tokenise, cut and place whole documents; ids are kept as their checksum."""
    pieces = tokenize(docs, vocabulary, capacity).withColumn("ids_crc32", F.crc32("ids")).drop("ids")
    return pack(stage(pieces.withColumn("_row", F.monotonically_increasing_id()), "pieces"), capacity)


def build_sequences(pieces: DataFrame, placed: DataFrame) -> DataFrame:
    """sequence_id and the ids (binary) of each packed sequence, from ``tokenize`` and ``pack``.

    At most ``capacity`` tokens meet in a group. Needs doc_id and piece to name a piece uniquely.
    """
    parts = pieces.select("doc_id", "piece", "ids").join(placed, ["doc_id", "piece"])
    inside = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return (
        parts.groupBy("sequence_id")
        .agg(inside.alias("parts"))
        .select("sequence_id", F.expr("aggregate(parts.ids, X'', (a, x) -> concat(a, x))").alias("ids"))
    )
