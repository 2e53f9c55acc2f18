"""A Merkle manifest of a dataset, and the fold of every leaf to the root by hash midstates.

Every row is a leaf; the leaves of one language, by doc_id, are a tree of fan-out ``FAN``, and the
subroots, by language, are one more. A parent hashes its children's digests in order and keeps a copy
of its hash state from before each child: to replace a child it resumes that copy, takes the new
digest and the siblings right of it, and never hashes the left ones again.

Leaves are hashed where their texts are; only digests travel. They are ranged by tree and order, and
a row's position is its place in its range plus the counts before it, so no task holds a language.
``FAN ** height`` consecutive nodes are a block and one task group: a pass up replaces the blocks by
their roots until each tree has one; a pass down hands every block the runs above it.

Defined results: a null in any column is its mark `-`; a null language is a tree of its own, the
first; null ids come first in their tree and are never tampered with; leaves of one id are in the
order of their digests, and repeated rows are leaves each. Texts of any length are hashed as wholes.
Only the five columns of a leaf are read, whatever else the table holds. No rows make no tree.
"""

from __future__ import annotations

import string
from collections.abc import Callable
from dataclasses import dataclass
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkvigil.plans.skew import is_small, null_safe_join
from sparkvigil.session import stage

FAN = 8
# Levels of a block: 4,096 nodes.
HEIGHT = 4
# Rows of one range of the leaves.
RANGE_ROWS = 1 << 20

NODES = "tree string, pos bigint, total bigint, digest binary"
PATHS = "tree string, pos bigint, subroot binary, root binary, path array<struct<slot:int,nodes:array<binary>>>"
PATH_ARROW = pa.list_(pa.struct([("slot", pa.int32()), ("nodes", pa.list_(pa.binary()))]))


# ---- leaves -------------------------------------------------------------------------------------


def encoded(value: Column) -> Column:
    """`-` for null, else the UTF-8 byte count, a colon and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(text: Column) -> Column:
    """Digest (hex) of a document row with the text given."""
    fields = [F.col("doc_id"), F.col("source"), F.col("lang"), F.col("n_chars"), text]
    return F.sha2(F.concat(*[encoded(f) for f in fields]), 256)


def lowered(text: Column) -> Column:
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def tampered_third() -> Column:
    """The text as someone changed it: in lower case where 3 divides the CRC-32 of the id."""
    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    return F.when(hit, lowered(F.col("text"))).otherwise(F.col("text"))


# ---- runs ---------------------------------------------------------------------------------------


class Run:
    """Children of one parent with the hash states from before each of them."""

    def __init__(self, children: list[bytes]) -> None:
        self.children, self.states = children, []
        state = sha256()
        for child in children:
            self.states.append(state.copy())
            state.update(child)
        self.digest = state.hexdigest().encode()
        self.right = [b"".join(children[i + 1 :]) for i in range(len(children))]

    def folded(self, slot: int, digest: bytes) -> bytes:
        """The parent's digest with another child in ``slot``."""
        state = self.states[slot].copy()
        state.update(digest)
        state.update(self.right[slot])
        return state.hexdigest().encode()

    def siblings(self, slot: int) -> bytes:
        return b"".join(self.children[:slot]) + self.right[slot]


def block_runs(digests: list[bytes], total: int, height: int) -> list[list[Run]]:
    """The runs of a block, by level: ``height`` levels, or up to the root of a tree of one block."""
    levels = []
    while len(levels) < height and (total > FAN**height or len(digests) > 1):
        levels.append([Run(digests[i : i + FAN]) for i in range(0, len(digests), FAN)])
        digests = [run.digest for run in levels[-1]]
    return levels


def hex_list(column: pa.ChunkedArray) -> list[bytes]:
    return [value.hex().encode() for value in column.to_pylist()]


def block_root(table: pa.Table, height: int) -> pa.Table:
    """One node for a block of consecutive nodes."""
    table = table.sort_by("pos")
    total, pos, size = table["total"][0].as_py(), table["pos"][0].as_py(), FAN**height
    levels = block_runs(hex_list(table["digest"]), total, height)
    digest = bytes.fromhex(levels[-1][0].digest.decode()) if levels else table["digest"][0].as_py()
    row = {"tree": table["tree"][0].as_py(), "pos": pos // size, "total": -(-total // size), "digest": digest}
    return pa.Table.from_pylist(
        [row], pa.schema([("tree", pa.string()), ("pos", pa.int64()), ("total", pa.int64()), ("digest", pa.binary())])
    )


def paths_down(nodes: pa.Table, above: pa.Table, height: int) -> pa.Table:
    """The runs above every node of a block, from its own to the root's."""
    nodes = nodes.sort_by("pos")
    tree, subroot, root = (above[c][0].as_py() for c in ("tree", "subroot", "root"))
    upper = above["path"][0].as_py()
    levels = block_runs(hex_list(nodes["digest"]), nodes["total"][0].as_py(), height)
    paths = []
    for i in range(len(nodes)):
        path, at = [], i
        for runs in levels:
            children = [bytes.fromhex(c.decode()) for c in runs[at // FAN].children]
            path.append({"slot": at % FAN, "nodes": children})
            at //= FAN
        paths.append(path + upper)
    same = lambda value, kind: pa.array([value] * len(nodes), kind)
    return pa.table(
        {
            "tree": same(tree, pa.string()), "pos": nodes["pos"], "subroot": same(subroot, pa.binary()),
            "root": same(root, pa.binary()), "path": pa.array(paths, PATH_ARROW),
        }
    )


def folds(leaves: pa.Table, above: pa.Table, height: int) -> pa.Table:
    """Proof and folded root of every leaf of a block."""
    leaves = leaves.sort_by("pos")
    upper = [(Run([n.hex().encode() for n in run["nodes"]]), run["slot"]) for run in above["path"][0].as_py()]
    higher = b"".join(run.siblings(slot) for run, slot in upper)
    levels = block_runs(hex_list(leaves["digest"]), leaves["total"][0].as_py(), height)
    subroot, root = above["subroot"][0].as_py().hex(), above["root"][0].as_py().hex()
    proofs, roots = [], []
    for i, digest in enumerate(hex_list(leaves["offered"])):
        siblings, at = [], i
        for runs in levels:
            run, slot = runs[at // FAN], at % FAN
            siblings.append(run.siblings(slot))
            digest = run.folded(slot, digest)
            at //= FAN
        for run, slot in upper:
            digest = run.folded(slot, digest)
        proofs.append(sha256(b"".join([*siblings, higher])).hexdigest())
        roots.append(digest.decode())
    n = len(leaves)
    return pa.table(
        {
            "doc_id": leaves["doc_id"], "position": leaves["pos"],
            "leaf": pa.array([d.hex() for d in leaves["digest"].to_pylist()], pa.string()),
            "subroot": pa.array([subroot] * n, pa.string()), "root": pa.array([root] * n, pa.string()),
            "proof_sha256": pa.array(proofs, pa.string()), "folded_root": pa.array(roots, pa.string()),
            "verified": pa.array([r == root for r in roots], pa.bool_()),
        }
    )


# ---- trees --------------------------------------------------------------------------------------


def with_positions(rows: DataFrame, order: list[Column], range_rows: int = RANGE_ROWS) -> DataFrame:
    """Stored ``rows`` with ``pos`` within their ``tree`` along ``order``, and the tree's ``total``."""
    spark = rows.sparkSession
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows.count() // range_rows))
    keys = [F.col("tree"), *order]
    ranged = rows.repartitionByRange(parts, *keys).sortWithinPartitions(*keys)
    nth = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    cut = stage(ranged.select("*", F.spark_partition_id().alias("_part"), nth.alias("_nth")), "ranges")
    # A row for every range and tree in it.
    counts = cut.groupBy("tree", "_part").agg(F.count(F.lit(1)).alias("_n"), F.min("_nth").alias("_first"))
    whole = Window.partitionBy("tree")
    before = whole.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = stage(
        counts.select(
            "tree", "_part", "_first",
            F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"), F.sum("_n").over(whole).alias("total"),
        ),
        "starts",
    )
    joined = null_safe_join(cut, starts, ["tree", "_part"], small=is_small(starts))
    placed = joined.withColumn("pos", F.col("_start") + F.col("_nth") - F.col("_first"))
    return placed.drop("_part", "_nth", "_first", "_start")


def in_blocks(nodes: DataFrame, height: int) -> DataFrame:
    return nodes.withColumn("block", F.expr(f"pos div {FAN**height}"))


def levels_up(nodes: DataFrame, height: int) -> list[DataFrame]:
    """``nodes`` and the stored block roots above them, up to one node a tree."""
    levels = [nodes]
    while (levels[-1].agg(F.max("total")).first()[0] or 1) > 1:
        blocks = in_blocks(levels[-1].select("tree", "pos", "total", "digest"), height).groupBy("tree", "block")
        levels.append(stage(blocks.applyInArrow(lambda table: block_root(table, height), NODES), "block_roots"))
    return levels


def beside(nodes: DataFrame, paths: DataFrame, height: int, work: Callable, schema: str) -> DataFrame:
    """``work(nodes of a block, the path above it)`` for all blocks."""
    above = paths.withColumn("block", F.col("pos")).drop("pos")
    grouped = in_blocks(nodes, height).groupBy("tree", "block").cogroup(above.groupBy("tree", "block"))
    return grouped.applyInArrow(lambda left, right: work(left, right, height=height), schema)


@dataclass
class Manifest:
    """Positions and digests of all leaves, and the runs above every block of them."""

    leaves: DataFrame
    paths: DataFrame
    height: int

    def audit(self) -> DataFrame:
        """Every leaf's proof, and the root that its offered digest folds to."""
        kind = self.leaves.schema["doc_id"].dataType.simpleString()
        schema = (
            f"doc_id {kind}, position bigint, leaf string, subroot string, root string, "
            "proof_sha256 string, folded_root string, verified boolean"
        )
        return beside(self.leaves, self.paths, self.height, folds, schema)


def build_manifest(
    docs: DataFrame, offered: Column | None = None, height: int = HEIGHT, range_rows: int = RANGE_ROWS
) -> Manifest:
    """The manifest of ``docs``; ``offered`` is the text that the audit holds against it."""
    # A null language sorts before every other one.
    tree = F.coalesce(F.concat(F.lit("="), F.col("lang")), F.lit("-"))
    digest, own = leaf_digest(F.col("text")), F.col("text")
    changed = F.lit(False) if offered is None else ~offered.eqNullSafe(own)
    rows = docs.select(
        "doc_id",
        tree.alias("tree"),
        F.unhex(digest).alias("digest"),
        F.when(changed, F.unhex(leaf_digest(own if offered is None else offered))).alias("other"),
    )
    rows = stage(rows, "leaves").withColumn("offered", F.coalesce("other", "digest")).drop("other")
    placed = stage(with_positions(rows, [F.col("doc_id"), F.col("digest")], range_rows), "placed")
    levels = levels_up(placed, height)

    subroots = levels[-1].select(F.lit("").alias("tree"), F.col("tree").alias("own"), "digest")
    top = stage(with_positions(subroots, [F.col("own")], range_rows), "subroots")
    higher = levels_up(top, height)
    last = F.array().cast("array<struct<slot:int,nodes:array<binary>>>").alias("path")
    root = F.col("digest")
    paths = higher[-1].select("tree", "pos", root.alias("subroot"), root.alias("root"), last)
    for level in higher[-2::-1]:
        paths = stage(beside(level.select("tree", "pos", "total", "digest"), paths, height, paths_down, PATHS), "paths")
    named = top.select(F.col("pos"), "own", F.col("digest").alias("of")).join(paths, "pos")
    paths = named.select(F.col("own").alias("tree"), F.lit(0).cast("bigint").alias("pos"), F.col("of").alias("subroot"), "root", "path")
    for level in levels[-2:0:-1]:
        paths = stage(beside(level, paths, height, paths_down, PATHS), "paths")
    return Manifest(placed, paths, height)
