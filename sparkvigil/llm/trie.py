"""The prefix trie of conversations, by union-find over sorted neighbours.

A conversation is the sequence of its turns, each a digest of role and text with the text's number of
words: `UNIT` bytes a turn, so sequences compare as bytes. All sequences are range-partitioned by
(sequence, conv_id) and sorted, so a task has neighbours only, however often one sequence occurs.
Two neighbours share as many first turns as their longest common prefix (LCP) says. In descending
LCP the neighbours' components are joined by union-find, and every join makes, or extends, the
branching node at that depth; the nodes between two branchings have the members of the lower one.

Only a node on the way to the first or the last sequence of a partition can have members elsewhere.
All other nodes are finished within the task. What remains of a partition are those two ways, its
spines, with the totals of what was finished below each of their nodes: spines of consecutive
partitions are neighbours again, with an LCP, and the same union-find joins them, ``FAN`` partitions
at a time, until one group is left.

Defined results: null conv_ids are no conversation. Turns are in the order of turn (null first), role
and digest; null role or text is empty; repeated turns stay. A conversation without turns ends at the
root. Two turns are equal if 128 bits of their SHA-256 and their numbers of words are. A conversation
is one value of ``UNIT`` bytes a turn, texts do not travel. No conversations make no nodes, not even
a root. Only conv_id, turn, role and text are read, whatever else the table holds.
"""

from __future__ import annotations

import struct
from collections.abc import Callable, Iterator, Sequence
from hashlib import blake2b, sha256

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkvigil.plans.skew import lookup_join
from sparkvigil.session import stage

# 16 bytes of the digest, 8 of the number of words.
UNIT = 24
KEY = 16
# Conversations and bytes of sequences of one partition.
PART_ROWS = 20_000
PART_BYTES = 1 << 26
# Partitions whose spines are joined in one group.
FAN = 1024
# Ids of one piece of a long list of ids.
CHUNK_IDS = 8192

WORDS = r"[^\x20\x09-\x0D]+"
NO_IDS = sha256().hexdigest()

NODE, SPINE, IDS = 0, 1, 2
LONGS = "array<bigint>"
SCHEMA = (
    "kind int, key binary, parent_key binary, conv_id bigint, depth bigint, parent_conv_id bigint, n_convs bigint, "
    "n_children bigint, n_leaves bigint, saved_tokens bigint, ends_sha256 string, part bigint, side int, keys binary, "
    f"words {LONGS}, n {LONGS}, least {LONGS}, children {LONGS}, leaves {LONGS}, saved {LONGS}, ids string"
)
ARROW = pa.schema(
    [("kind", pa.int32()), ("key", pa.binary()), ("parent_key", pa.binary()), ("conv_id", pa.int64()), ("depth", pa.int64()),
     ("parent_conv_id", pa.int64()), ("n_convs", pa.int64()), ("n_children", pa.int64()), ("n_leaves", pa.int64()),
     ("saved_tokens", pa.int64()), ("ends_sha256", pa.string()), ("part", pa.int64()), ("side", pa.int32()), ("keys", pa.binary()),
     *[(c, pa.list_(pa.int64())) for c in ("words", "n", "least", "children", "leaves", "saved")], ("ids", pa.string())]
)
TOTALS = ("n", "least", "children", "leaves", "saved")


# ---- sequences ----------------------------------------------------------------------------------


def turn_units(conversations: DataFrame) -> DataFrame:
    """conv_id and units: the hexadecimal units of its turns, in order."""
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    written = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    count = F.lpad(F.lower(F.hex(F.regexp_count(text, F.lit(WORDS)).cast("bigint"))), 16, "0")
    unit = F.concat(F.substring(F.sha2(written, 256), 1, 32), count)
    turns = conversations.filter(F.col("conv_id").isNotNull()).select("conv_id", "turn", role.alias("role"), unit.alias("unit"))
    ordered = F.sort_array(F.collect_list(F.struct("turn", "role", "unit")))
    return turns.groupBy("conv_id").agg(F.transform(ordered, lambda t: t["unit"]).alias("units"))


def common(a: bytes, b: bytes, unit: int) -> int:
    """Number of equal first units."""
    low, high = 0, min(len(a), len(b)) // unit
    if a[: high * unit] == b[: high * unit]:
        return high
    while high - low > 1:
        mid = (low + high) // 2
        if a[low * unit : mid * unit] == b[low * unit : mid * unit]:
            low = mid
        else:
            high = mid
    return low


def prefix_keys(path: bytes) -> list[bytes]:
    """A key for every prefix, the empty one first."""
    state = blake2b(digest_size=KEY)
    keys = [state.digest()]
    for at in range(0, len(path), UNIT):
        state.update(path[at : at + UNIT])
        keys.append(state.copy().digest())
    return keys


# ---- the forest of a run of neighbours ------------------------------------------------------------


class Forest:
    """Branching nodes over sorted entries, by union-find on the edges between neighbours.

    ``depths`` are the entries' own, ``shared[i]`` the LCP of entries i and i + 1, which differ.
    """

    def __init__(self, depths: list[int], shared: list[int]) -> None:
        self.depth = list(depths)
        self.parent: list[int] = [-1] * len(depths)
        self.children: list[list[int]] = [[] for _ in depths]
        joined, top = list(range(len(depths))), list(range(len(depths)))

        def find(i: int) -> int:
            while joined[i] != i:
                joined[i] = joined[joined[i]]
                i = joined[i]
            return i

        for i in sorted(range(len(shared)), key=lambda i: -shared[i]):
            a, b, at = find(i), find(i + 1), shared[i]
            one, two = top[a], top[b]
            node = one
            if self.depth[one] != at:
                node = self.add(at)
                self.hang(one, node)
            if self.depth[two] == at:
                raise ValueError("neighbours must differ and be sorted")
            self.hang(two, node)
            joined[b], top[a] = a, node
        root = top[find(0)]
        if self.depth[root]:
            self.hang(root, self.add(0))
            root = len(self.depth) - 1
        self.root = root

    def add(self, depth: int) -> int:
        self.depth.append(depth)
        self.parent.append(-1)
        self.children.append([])
        return len(self.depth) - 1

    def hang(self, child: int, parent: int) -> None:
        self.parent[child] = parent
        self.children[parent].append(child)

    def way(self, entry: int) -> list[int]:
        """The nodes from an entry up to the root."""
        out = [entry]
        while self.parent[out[-1]] >= 0:
            out.append(self.parent[out[-1]])
        return out


def nothing() -> list:
    """Totals of no conversation, in the order of ``TOTALS``."""
    return [0, None, 0, 0, 0]


def add(to: list, totals: Sequence) -> None:
    n, least, children, leaves, saved = totals
    to[0] += n
    if to[1] is None or (least is not None and least < to[1]):
        to[1] = least
    to[2] += children
    to[3] += leaves
    to[4] += saved


class Run:
    """Sorted entries with what is known about the nodes on their ways.

    ``given[i]`` has, by depth, the totals (n, least, children, leaves, saved) that entry i brings to
    the node at that depth; ``words(i, d)`` the words of its d-th turn; ``key(i, d)`` the key of its
    first d turns. Unless this is the ``whole`` trie, the ways to its first and last entry stay open.
    """

    def __init__(
        self,
        depths: list[int],
        shared: list[int],
        given: list[dict],
        words: Callable[[int, int], int],
        key: Callable[[int, int], bytes],
        whole: bool,
    ) -> None:
        self.forest = forest = Forest(depths, shared)
        self.words, self.key = words, key
        count = len(forest.depth)
        self.sides = list(dict.fromkeys((0, len(depths) - 1)))
        # Open nodes, with the side whose way they are on.
        self.open = {} if whole else {v: i for i in self.sides[::-1] for v in forest.way(i)}
        # Any entry below a node: its prefix is the node's.
        self.entry = list(range(len(depths))) + [-1] * (count - len(depths))
        # Deep nodes first, so children come before their parents.
        order = sorted(range(count), key=lambda v: -forest.depth[v])
        for v in order:
            p = forest.parent[v]
            if p >= 0 and self.entry[p] < 0:
                self.entry[p] = self.entry[v]
        self.given: list[dict[int, list]] = [{} for _ in range(count)]
        for i, by_depth in enumerate(given):
            v, low = i, self.low(i)
            for d in sorted(by_depth, reverse=True):
                while d <= low:
                    v = forest.parent[v]
                    low = self.low(v)
                self.bring(v, d, by_depth[d])
        self.nodes: list[tuple] = []
        for v in order:
            self.finish(v)

    def low(self, v: int) -> int:
        """The depth below which the nodes of ``v`` lie: its parent's."""
        p = self.forest.parent[v]
        return self.forest.depth[p] if p >= 0 else -1

    def bring(self, v: int, depth: int, totals: Sequence) -> None:
        add(self.given[v].setdefault(depth, nothing()), totals)

    def finish(self, v: int) -> None:
        """Totals of the nodes of ``v``, from its depth up; an open one keeps what it was given."""
        if v in self.open:
            return
        forest, i = self.forest, self.entry[v]
        total, below = nothing(), []
        for d in range(forest.depth[v], self.low(v), -1):
            add(total, self.given[v].get(d, nothing()))
            if not total[2]:
                total[3] = 1
            if d:
                total[4] += (total[0] - 1) * self.words(i, d)
            if below:
                below[-1][1] = total[1]
            below.append([(v, d), None, *total])
            # To the node above, this one is a child.
            total[2] = 1
        self.nodes += below
        p = forest.parent[v]
        if p >= 0:
            self.bring(p, forest.depth[p], total)

    def spines(self) -> list[tuple[int, int, list]]:
        """(entry, first depth that is its own, totals by depth) of the ways to the first and last entry."""
        forest, out, seen = self.forest, [], set()
        for entry in self.sides:
            totals, first = {}, 0
            for v in forest.way(entry):
                if v in seen:
                    first = forest.depth[v] + 1
                    break
                seen.add(v)
                for d in range(forest.depth[v], self.low(v), -1):
                    totals[d] = self.given[v].get(d, nothing())
            out.append((entry, first, [totals[d] for d in sorted(totals)]))
        return out


def node_rows(run: Run, ends: dict[int, str], keyed: bool) -> Iterator[dict]:
    """The finished nodes; a node's parent is finished with it, or open and given by its key."""
    forest = run.forest
    least = {place: least for place, _, _, least, *_ in run.nodes}
    for (v, d), above, n, first, children, leaves, saved in run.nodes:
        row = {
            "kind": NODE, "conv_id": first, "depth": d, "n_convs": n, "n_children": children, "n_leaves": leaves,
            "saved_tokens": saved, "parent_conv_id": above,
        }
        p = forest.parent[v]
        if above is None and p >= 0:
            if p in run.open:
                row["parent_key"] = run.key(run.open[p], d - 1)
            else:
                row["parent_conv_id"] = least[(p, d - 1)]
        if keyed:
            row["key"] = run.key(run.entry[v], d)
        else:
            row["ends_sha256"] = ends.get(v, NO_IDS) if d == forest.depth[v] else NO_IDS
        yield row


def spine_rows(run: Run, part: int) -> Iterator[dict]:
    for side, (entry, first, totals) in enumerate(run.spines()):
        depth = run.forest.depth[entry]
        empty = [nothing()] * first
        columns = dict(zip(TOTALS, map(list, zip(*empty, *totals, strict=True)), strict=True))
        yield {
            "kind": SPINE, "part": part, "side": side, "keys": b"".join(run.key(entry, d) for d in range(depth + 1)),
            "words": [0] + [run.words(entry, d) for d in range(1, depth + 1)], **columns,
        }


def batches(rows: Iterator[dict], size: int = 4096) -> Iterator[pa.RecordBatch]:
    held = []
    for row in rows:
        held.append(row)
        if len(held) == size:
            yield pa.RecordBatch.from_pylist(held, ARROW)
            held = []
    if held:
        yield pa.RecordBatch.from_pylist(held, ARROW)


def sorted_part(incoming: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Nodes, spines and open lists of ids of a sorted partition of (part, path, conv_id)."""
    paths, ids, part = [], [], 0
    for batch in incoming:
        part = batch.column("part")[0].as_py() if batch.num_rows else part
        for path, conv in zip(batch.column("path").to_pylist(), batch.column("conv_id").to_pylist(), strict=True):
            if not paths or path != paths[-1]:
                paths.append(path)
                ids.append([])
            ids[-1].append(conv)
    if not paths:
        return
    shared = [common(a, b, UNIT) for a, b in zip(paths, paths[1:], strict=False)]
    depths = [len(p) // UNIT for p in paths]
    given = [{depth: (len(own), own[0], 0, 0, 0)} for depth, own in zip(depths, ids, strict=True)]
    known = {}

    def key(i: int, d: int) -> bytes:
        if i not in known:
            known[i] = prefix_keys(paths[i])
        return known[i][d]

    def words(i: int, d: int) -> int:
        return struct.unpack_from(">q", paths[i], UNIT * d - 8)[0]

    run = Run(depths, shared, given, words, key, whole=False)

    def rows() -> Iterator[dict]:
        ends = {i: listed(own) for i, own in enumerate(ids) if i not in run.open}
        yield from node_rows(run, {i: sha256(t.encode()).hexdigest() for i, t in ends.items()}, keyed=False)
        yield from spine_rows(run, part)
        for i in sorted(run.open):
            if i < len(ids):
                for at in range(0, len(ids[i]), CHUNK_IDS):
                    some = ids[i][at : at + CHUNK_IDS]
                    yield {"kind": IDS, "key": key(i, depths[i]), "conv_id": some[0], "ids": listed(some)}

    yield from batches(rows())


def listed(ids: list[int]) -> str:
    return ",".join(map(str, ids))


def joined_spines(table: pa.Table, part: int, whole: bool) -> pa.Table:
    """Nodes that are finished, and the spines that remain, of spines of consecutive partitions."""
    spines = sorted(table.to_pylist(), key=lambda s: (s["part"], s["side"]))
    # Equal neighbours are one entry.
    entries: list[dict] = []
    for spine in spines:
        totals = list(zip(*(spine[c] for c in TOTALS), strict=True))
        if entries and entries[-1]["keys"] == spine["keys"]:
            entries[-1]["totals"].append(totals)
        else:
            entries.append({"keys": spine["keys"], "words": spine["words"], "totals": [totals]})
    depths = [len(e["words"]) - 1 for e in entries]
    # Prefix keys are equal up to where the prefixes are; the empty prefix always is.
    shared = [common(a["keys"], b["keys"], KEY) - 1 for a, b in zip(entries, entries[1:], strict=False)]
    given = []
    for e in entries:
        own: dict[int, list] = {}
        for totals in e["totals"]:
            for d, some in enumerate(totals):
                add(own.setdefault(d, nothing()), some)
        given.append(own)

    def key(i: int, d: int) -> bytes:
        return entries[i]["keys"][KEY * d : KEY * (d + 1)]

    run = Run(depths, shared, given, lambda i, d: entries[i]["words"][d], key, whole)
    rows = list(node_rows(run, {}, keyed=True))
    if not whole:
        rows += spine_rows(run, part)
    return pa.Table.from_pylist(rows, ARROW)


# ---- the trie -----------------------------------------------------------------------------------


def hashed_ids(chunks: DataFrame) -> DataFrame:
    """key and ends_sha256 of lists of ids that come in pieces: one pass over the sorted pieces."""

    def fold(incoming: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state = None, None
        done: list[tuple[bytes, str]] = []
        for batch in incoming:
            for own, text in zip(batch.column("key").to_pylist(), batch.column("ids").to_pylist(), strict=True):
                if own != key:
                    if state is not None:
                        done.append((key, state.hexdigest()))
                    key, state = own, sha256(text.encode())
                else:
                    state.update(b"," + text.encode())
            if done:
                yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in done], pa.binary()), pa.array([h for _, h in done])], ["key", "ends_sha256"])
                done = []
        if state is not None:
            yield pa.RecordBatch.from_arrays([pa.array([key], pa.binary()), pa.array([state.hexdigest()])], ["key", "ends_sha256"])

    dealt = chunks.select("key", "conv_id", "ids").repartition("key").sortWithinPartitions("key", "conv_id")
    return dealt.mapInArrow(fold, "key binary, ends_sha256 string")


def prefix_trie(paths: DataFrame, part_rows: int = PART_ROWS, fan: int = FAN) -> DataFrame:
    """Every node of the trie of (conv_id, path): path is the units of a conversation, one after another.

    conv_id (the smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens,
    ends_sha256.
    """
    spark = paths.sparkSession
    paths = stage(paths.select("conv_id", "path"), "paths")
    size = paths.agg(F.count(F.lit(1)).alias("rows"), F.sum(F.octet_length("path")).alias("bytes")).first()
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    parts = max(least, -(-size["rows"] // part_rows), -(-(size["bytes"] or 0) // PART_BYTES))
    ranged = paths.repartitionByRange(parts, "path", "conv_id").sortWithinPartitions("path", "conv_id")
    numbered = ranged.select(F.spark_partition_id().cast("bigint").alias("part"), "path", "conv_id")
    first = stage(numbered.mapInArrow(sorted_part, SCHEMA), "trie")
    rounds = [first]
    spines = first.filter(F.col("kind") == SPINE)
    while spines.count() > 2 * fan:
        part = F.expr(f"part div {fan}")
        grouped = spines.withColumn("part_group", part).groupBy("part_group")
        done = grouped.applyInArrow(lambda key, table: joined_spines(table, key[0].as_py(), False), SCHEMA)
        rounds.append(stage(done, "trie"))
        spines = rounds[-1].filter(F.col("kind") == SPINE)
    last = spines.groupBy(F.lit(0).alias("all")).applyInArrow(lambda table: joined_spines(table, 0, True), SCHEMA)
    rounds.append(stage(last, "trie"))

    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    is_node = F.col("kind") == NODE
    shared = rounds[1].filter(is_node)
    for table in rounds[2:]:
        shared = shared.unionByName(table.filter(is_node))
    ends = hashed_ids(first.filter(F.col("kind") == IDS))
    shared = shared.drop("ends_sha256").join(ends, "key", "left").withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(NO_IDS)))
    shared = stage(shared.select("key", "parent_key", *columns), "shared")
    nodes = first.filter(is_node).select("parent_key", *columns).unionByName(shared.drop("key"))
    parents = shared.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("_above"))
    found = lookup_join(nodes, parents, ["parent_key"], stored=True)
    return found.withColumn("parent_conv_id", F.coalesce("parent_conv_id", "_above")).select(*columns)
