"""Mixing sources to target weights by Sainte-Lague apportionment of equal-token blocks.

The words of all documents are the house: it is cut into blocks of ``block_words`` words, and the
blocks go one by one to the source with the highest quotient target / (2 * seats + 1). The seats of a
source go to its shards the same way, by shard size. A shard lays its documents out in seeded order
and cuts that stream into blocks; a quota of q blocks out of n takes every block q // n times and
q % n blocks, from a seeded start, once more. A document's share of its shard's blocks is arithmetic
on its word range, so blocks are never rows.

Defined results: a null text has size 0 and is taken 0 times; a null source is a source of its own,
last in order; ties of quotients go to the earlier source or shard, ties of the seeded order to the
smaller doc_id and then size; repeated rows are documents of their own; an empty table gives an
empty result; other columns are ignored.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sparkvigil.llm.columns import fresh
from sparkvigil.session import stage

WEIGHTS = (5, 2, 1)
MAX_REPEATS = 3
BLOCK_WORDS = 16
# Words of one shard, and most shards of one source (three hex digits of the key hash).
SHARD_WORDS = 2_000_000
MAX_SHARDS = 4096
SEED = "mix"
WORD = r"[^\x20\x09-\x0D]+"


def targets(sizes: list[int], weights: list[float], repeats: int = MAX_REPEATS) -> list[float]:
    """Shares of the sum of ``sizes`` by weight; what exceeds ``repeats`` sizes is shared out again."""
    left, open_ = float(sum(sizes)), list(range(len(sizes)))
    out = [0.0] * len(sizes)
    while open_:
        total = sum(weights[i] for i in open_)
        full = [i for i in open_ if left * weights[i] / total > repeats * sizes[i]]
        if not full:
            for i in open_:
                out[i] = left * weights[i] / total
            break
        for i in full:
            out[i] = float(repeats * sizes[i])
        left -= sum(out[i] for i in full)
        open_ = [i for i in open_ if i not in set(full)]
    return out


def apportion(shares: list[float], seats: int, limits: list[int]) -> list[int]:
    """``seats`` to ``shares`` by highest quotients share / (2k + 1), at most ``limits`` to each.

    Starts from the rounded quotas, which differ from the result by about one seat per share, and
    moves seats between the lowest quotient that is seated and the highest that is not.
    """
    total = sum(shares)
    if total <= 0 or seats <= 0:
        return [0] * len(shares)
    got = [min(int(s * seats / total + 0.5), m) for s, m in zip(shares, limits, strict=True)]
    quotient = lambda i, k: shares[i] / (2 * k + 1)
    lowest = [(quotient(i, got[i] - 1), -i) for i in range(len(shares)) if got[i]]
    heapq.heapify(lowest)
    for _ in range(sum(got) - seats):
        i = -heapq.heappop(lowest)[1]
        got[i] -= 1
        if got[i]:
            heapq.heappush(lowest, (quotient(i, got[i] - 1), -i))
    highest = [(-quotient(i, got[i]), i) for i in range(len(shares)) if shares[i] and got[i] < limits[i]]
    heapq.heapify(highest)
    for _ in range(seats - sum(got)):
        if not highest:
            break
        i = heapq.heappop(highest)[1]
        got[i] += 1
        if got[i] < limits[i]:
            heapq.heappush(highest, (-quotient(i, got[i]), i))
    return got


@dataclass
class Shard:
    source: str | None
    shard: int
    words: int
    shards: int
    source_size: int
    target: float
    blocks: int = 0
    quota: int = 0


def plan_mix(
    cells: list[tuple[str | None, int, int]], block_words: int = BLOCK_WORDS, shard_words: int = SHARD_WORDS
) -> list[Shard]:
    """Quotas of all shards from (source, cell of the key hash, words)."""
    by_source: dict[str | None, dict[int, int]] = {}
    for source, cell, words in cells:
        by_source.setdefault(source, {})[cell] = words
    order = sorted(by_source, key=lambda s: (s is None, s or ""))
    sizes = [sum(by_source[s].values()) for s in order]
    goal = targets(sizes, [WEIGHTS[i % len(WEIGHTS)] for i in range(len(order))])
    plan: list[Shard] = []
    limits = []
    for source, size, target in zip(order, sizes, goal, strict=True):
        n = max(1, min(MAX_SHARDS, -(-size // shard_words)))
        words = [0] * n
        for cell, w in by_source[source].items():
            words[cell % n] += w
        plan += [Shard(source, k, w, n, size, target, -(-w // block_words)) for k, w in enumerate(words)]
        limits.append(sum(MAX_REPEATS * -(-w // block_words) for w in words))
    seats = apportion(goal, round(sum(sizes) / block_words), limits)
    at = 0
    for count in seats:
        own = plan[at : at + plan[at].shards]
        quotas = apportion([float(x.words) for x in own], count, [MAX_REPEATS * x.blocks for x in own])
        for shard, quota in zip(own, quotas, strict=True):
            shard.quota = quota
        at += len(own)
    return plan


def covered(low, high, start, length):
    """How much of the word range [low, high) lies in [start, start + length)."""
    return F.greatest(F.lit(0), F.least(high, start + length) - F.greatest(low, start))


def mix(sized: DataFrame, block_words: int = BLOCK_WORDS, seed: str = SEED, shard_words: int = SHARD_WORDS) -> DataFrame:
    """``sized`` (stored: doc_id, source, size, and others) with source_size, target, taken and parts.

    ``parts`` are the word ranges [from, to) of the document that are taken once more after
    ``copies`` whole copies. Only the totals per source and hash cell reach the driver: at most
    ``MAX_SHARDS`` rows for each source of the mixture.
    """
    spark = sized.sparkSession
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))
    keyed = sized.withColumn("_digest", digest).withColumn(
        "_cell", F.conv(F.substring("_digest", 1, 3), 16, 10).cast("int")
    )
    cells = keyed.groupBy("source", "_cell").agg(F.sum("size").alias("words")).collect()
    plan = plan_mix([(r["source"], r["_cell"], r["words"]) for r in cells], block_words, shard_words)
    rows = [
        (x.source, x.shard, x.shards, x.source_size, x.target, x.blocks, x.quota, start_block(seed, x))
        for x in plan
    ]
    quotas = spark.createDataFrame(
        rows,
        "_source string, _shard int, _shards int, source_size bigint, target double,"
        " _blocks bigint, _quota bigint, _start bigint",
    )
    # One row per source and shard; a plan has at most MAX_SHARDS of them for a source.
    sources = F.broadcast(quotas.select("_source", "_shards", "source_size", "target").distinct())
    placed = (
        keyed.join(sources, F.col("source").eqNullSafe(F.col("_source")))
        .drop("_source")
        .withColumn("_shard", F.pmod("_cell", "_shards"))
    )
    line = (
        Window.partitionBy("source", "_shard")
        .orderBy("_digest", "doc_id", "size")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    quotas = quotas.select(
        "_source", F.col("_shard").alias("_nth"), *[F.col(c) for c in ("_blocks", "_quota", "_start")]
    )
    laid = placed.withColumn("_high", F.sum("size").over(line)).withColumn("_low", F.col("_high") - F.col("size"))
    found = laid.join(
        F.broadcast(quotas), F.col("source").eqNullSafe(F.col("_source")) & (F.col("_shard") == F.col("_nth"))
    )
    blocks = F.greatest(F.col("_blocks"), F.lit(1))
    copies = F.floor(F.col("_quota") / blocks)
    extra = F.col("_quota") % blocks
    first = F.least(extra, blocks - F.col("_start"))
    spans = [(F.lit(0), extra - first), (F.col("_start"), first)]  # what wraps round, then from the start
    parts, taken = [], copies * F.col("size")
    for begin, many in spans:
        inside = covered(F.col("_low"), F.col("_high"), begin * block_words, many * block_words)
        from_ = F.greatest(begin * block_words, F.col("_low")) - F.col("_low")
        parts.append(F.struct(from_.alias("from"), (from_ + inside).alias("to")))
        taken = taken + inside
    return found.select(
        *sized.columns,
        "source_size",
        "target",
        taken.cast("long").alias("taken"),
        copies.cast("int").alias("copies"),
        F.filter(F.array(*parts), lambda p: p["to"] > p["from"]).alias("parts"),
    )


def start_block(seed: str, shard: Shard) -> int:
    """The block from which a shard's extra blocks are taken: the same on every run."""
    from hashlib import md5

    name = f"{seed}:{shard.source}:{shard.shard}"
    return int(md5(name.encode()).hexdigest()[:15], 16) % max(1, shard.blocks)


def word_count():
    """Words of the column ``text``; a null text has none."""
    return F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long")


def mix_documents(docs: DataFrame, **options) -> DataFrame:
    """doc_id, source, size, source_size, target, taken, copies, parts of every document."""
    return mix(stage(docs.select("doc_id", "source", word_count().alias("size")), "sizes"), **options)


def mixed_texts(docs: DataFrame, **options) -> DataFrame:
    """The mix itself, with the columns of ``docs``: whole copies, then the ranges taken besides.

    Rows are matched to the plan by doc_id and a hash of all columns. ``n_chars``, where there is
    one, is counted anew.
    """
    tag, own_id, own_tag, takes, part = fresh(docs, "tag", "own_id", "own_tag", "takes", "part")
    row_hash = F.xxhash64(*docs.columns)
    narrow = stage(docs.select("doc_id", "source", row_hash.alias("tag"), word_count().alias("size")), "sizes")
    plan = mix(narrow, **options).filter("taken > 0")
    plan = plan.select(F.col("doc_id").alias(own_id), F.col("tag").alias(own_tag), "copies", "parts")
    # Copies of one row may be taken differently: one of them stands for all their takes.
    counted = plan.groupBy(own_id, own_tag).agg(F.collect_list(F.struct("copies", "parts")).alias(takes))
    repeated = narrow.groupBy("doc_id", "tag").count().filter("count > 1")
    tagged = docs.withColumn(tag, row_hash)
    once = tagged if repeated.isEmpty() else tagged.dropDuplicates(["doc_id", tag])
    match = F.col("doc_id").eqNullSafe(F.col(own_id)) & (F.col(tag) == F.col(own_tag))
    kept = once.join(counted, match)

    @F.arrow_udf("array<string>")
    def cut(texts: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for text, takes in texts:
            yield pa.array(
                [taken_texts(t, k) for t, k in zip(text.to_pylist(), takes.to_pylist(), strict=True)],
                pa.list_(pa.string()),
            )

    mixed = kept.withColumn(part, F.explode(cut("text", takes)))
    fields = {"text": F.col(part)}
    if "n_chars" in docs.columns:
        fields["n_chars"] = F.length(part).cast(docs.schema["n_chars"].dataType)
    return mixed.select(*[fields[c].alias(c) if c in fields else F.col(f"`{c}`") for c in docs.columns])


def taken_texts(text: str, takes: list[dict]) -> list[str]:
    """Whole copies and word ranges of one text, in its own spelling and spacing."""
    out, spans = [], None
    for take in takes:
        out += [text] * take["copies"]
        for part in take["parts"]:
            if spans is None:
                spans = [m.span() for m in regex.finditer(WORD, text)]
            out.append(text[spans[part["from"]][0] : spans[part["to"] - 1][1]])
    return out
