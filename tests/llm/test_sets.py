"""Decontamination, the prefix trie and the Merkle manifest against plain versions of themselves."""

from __future__ import annotations

import random
import re
import zlib
from hashlib import sha256

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sparkvigil.llm import merkle, overlap, trie
from sparkvigil.llm.queries import QUERIES, rebuilt_conversations

FOLDER = "/root/testdata/sf0.001"
DOCUMENT = "doc_id bigint, text string, lang string, source string, n_chars bigint"
TURN = "conv_id bigint, turn bigint, role string, text string"


# ---- decontamination ----------------------------------------------------------------------------


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def plain_hits(text, items):
    """Number of words, hit places, and items, by comparing every place with every window."""
    own, places, found = words(text), set(), set()
    for item, passage in items:
        other = words(passage)
        m = min(10, len(other))
        windows = {tuple(other[i : i + m]) for i in range(len(other) - m + 1)} if m else set()
        for i in range(len(own) - m + 1 if m else 0):
            if tuple(own[i : i + m]) in windows:
                places |= set(range(i, i + m))
                found.add(item)
    return len(own), places, found


def scanned(text, items):
    tables = overlap.Patterns([(i, overlap.words_of((t or "").encode())) for i, t in items])
    found = tables.scan(None if text is None else text.encode())
    places = {w for s in found["spans"] for w in range(s["start"], s["end"])}
    assert sum(s["end"] - s["start"] for s in found["spans"]) == len(places)
    assert len(set(found["items"])) == len(found["items"])
    return found["words"], places, set(found["items"]) | ({None} if found["no_id"] else set())


passage = st.lists(st.sampled_from(["a", "b", "A", "1", "é", "c-d", "\n"]), max_size=40).map(" ".join)


@settings(max_examples=150, deadline=None)
@given(passage, st.lists(st.tuples(st.integers(1, 4), passage), max_size=4), st.sampled_from([7, 64, 1 << 20]))
def test_windows_like_plain_search(text, items, size):
    before, overlap.PIECE_BYTES = overlap.PIECE_BYTES, size
    try:
        assert scanned(text, items) == plain_hits(text, items)
    finally:
        overlap.PIECE_BYTES = before


def test_windows_on_long_texts():
    rng = random.Random(3)
    vocabulary = [f"w{i}" for i in range(40)]
    items = [(i, " ".join(rng.choices(vocabulary, k=n))) for i, n in enumerate([1, 3, 9, 10, 11, 40, 60, 0])]
    text = " ".join(rng.choices(vocabulary, k=20_000) + words(items[6][1]) + rng.choices(vocabulary, k=20_000))
    assert scanned(text, items) == plain_hits(text, items)
    assert scanned("x" * 3_000_000 + " " + items[5][1], items[3:])[2] == {5}
    # A passage that repeats itself and one that all items share cost no more than others.
    assert scanned("na " * 300_000, [(i, "na " * 50) for i in range(500)])[1] == set(range(300_000))


@pytest.fixture(scope="module")
def odd(spark):
    rows = [
        (1, None, "en", "a", 0), (2, "", None, "a", None), (3, "!? ...", "en", None, 6),
        (4, "One two three four five six seven eight nine TEN eleven", "en", "a", 50),
        (4, "One two three four five six seven eight nine TEN eleven", "en", "a", 50),
        (None, "so: one two three four five six seven eight nine ten", "fr", "b", 9),
        (None, "short item", None, None, 9), (-5, "very " * 60_000 + "short ITEM", "de", "c", 9),
    ]
    extra = "*, 1 AS words, 'x' AS hits, 2 AS spans, 3 AS row, 4 AS tree, 5 AS pos, 6 AS total, 7 AS digest, 8 AS `_part`"
    return spark.createDataFrame(rows, DOCUMENT).selectExpr(*extra.split(", "))


ITEMS = [
    (1, "one two three four five six seven eight nine ten"), (1, "short item"), (2, "short item"), (None, "Short, item!"),
    (3, None), (4, ""), (5, "never here at all and so on and on and on"),
]


def overlaps(spark, docs, block_words=overlap.BLOCK_WORDS, items=ITEMS):
    bench = spark.createDataFrame(items, "item_id bigint, text string").selectExpr("*", "1 AS words", "2 AS doc_id")
    got = []
    for r in overlap.find_overlaps(docs, bench, block_words).collect():
        places = {w for s in r["spans"] for w in range(s["start"], s["end"])}
        got.append((r["doc_id"], r["words"], places, set(r["items"]) | ({None} if r["no_id"] else set())))
    return got


def sortable(rows):
    return sorted((str(r[0]), r[1], sorted(r[2]), sorted(map(str, r[3]))) for r in rows)


@pytest.mark.parametrize("block_words", [overlap.BLOCK_WORDS, 14])
def test_overlaps_of_odd_rows(spark, odd, block_words):
    want = [(r["doc_id"], *plain_hits(r["text"], ITEMS)) for r in odd.collect()]
    assert sortable(overlaps(spark, odd, block_words)) == sortable(want)
    assert overlaps(spark, odd.limit(0), block_words) == []


def test_overlaps_without_benchmark(spark, odd):
    rows = overlaps(spark, odd, items=[(9, None)])
    assert len(rows) == 8 and not any(r[2] or r[3] for r in rows)


def test_long_items_are_cut(spark, odd, monkeypatch):
    monkeypatch.setattr(overlap, "SLICE_WORDS", 3)
    long = [(7, "zero " + ITEMS[0][1] + " eleven twelve"), (8, "very " * 100)]
    want = [(r["doc_id"], *plain_hits(r["text"], long)) for r in odd.collect()]
    assert sortable(overlaps(spark, odd, items=long)) == sortable(want)


# ---- prefix trie --------------------------------------------------------------------------------


def plain_trie(paths):
    """{prefix: (conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends)} of {conv: units}."""
    members = {}
    for conv, path in paths.items():
        for d in range(len(path) + 1):
            members.setdefault(path[:d], []).append(conv)
    out = {}
    for prefix, convs in members.items():
        below = [p for p in members if p[: len(prefix)] == prefix]
        children = sum(len(p) == len(prefix) + 1 for p in below)
        leaves = sum(not any(len(q) == len(p) + 1 and q[: len(p)] == p for q in below) for p in below)
        saved = sum((len(members[p]) - 1) * p[-1][1] for p in below if p)
        ends = ",".join(map(str, sorted(c for c in convs if len(paths[c]) == len(prefix))))
        above = min(members[prefix[:-1]]) if prefix else None
        out[prefix] = (min(convs), len(prefix), above, len(convs), children, leaves, saved, sha256(ends.encode()).hexdigest())
    return sorted(out.values(), key=str)


def bytes_of(path):
    return b"".join(name.encode().ljust(16, b"\0") + count.to_bytes(8, "big") for name, count in path)


def trie_rows(spark, paths, **options):
    rows = [(c, bytes_of(p)) for c, p in paths.items()]
    df = spark.createDataFrame(rows, "conv_id bigint, path binary")
    return sorted(map(tuple, trie.prefix_trie(df, **options).collect()), key=str)


def random_paths(seed, convs=90, letters="abc", longest=6):
    rng = random.Random(seed)
    made = {c: tuple((rng.choice(letters), 3) for _ in range(rng.randint(0, longest))) for c in rng.sample(range(-50, 500), convs)}
    # A third of all conversations are the same, and some continue it.
    hot = (("h", 2), ("h", 2), ("i", 0))
    for c in list(made)[: convs // 3]:
        made[c] = hot
    for c in list(made)[convs // 3 : convs // 3 + 5]:
        made[c] = hot + made[c]
    return made


@pytest.mark.parametrize(("rows", "fan"), [(trie.PART_ROWS, trie.FAN), (7, 3), (2, 4)])
def test_trie_like_plain_one(spark, rows, fan):
    paths = random_paths(seed=rows)
    assert trie_rows(spark, paths, part_rows=rows, fan=fan) == plain_trie(paths)


def test_trie_of_nested_and_long_conversations(spark, monkeypatch):
    monkeypatch.setattr(trie, "CHUNK_IDS", 2)
    nested = {c: tuple((f"t{i}", 1) for i in range(c)) for c in range(12)}
    assert trie_rows(spark, nested, part_rows=2, fan=2) == plain_trie(nested)
    long = {c: tuple((f"t{i}", i) for i in range(3000)) + (("end", c),) * (c > 2) for c in range(5)}
    got = trie_rows(spark, long, part_rows=2, fan=2)
    assert len(got) == 3003 and {r[3] for r in got} == {5, 1}
    assert trie_rows(spark, {7: ()}) == plain_trie({7: ()})
    assert trie_rows(spark, {}) == []


@settings(max_examples=100, deadline=None)
@given(st.dictionaries(st.integers(0, 99), st.text("ab", max_size=4).map(lambda t: tuple((x, 2) for x in t)), min_size=1, max_size=12))
def test_one_partition_finishes_all_nodes(paths):
    groups = {}
    for conv in sorted(paths):
        groups.setdefault(bytes_of(paths[conv]), []).append(conv)
    known = sorted(groups)
    depths = [len(p) // trie.UNIT for p in known]
    shared = [trie.common(a, b, trie.UNIT) for a, b in zip(known, known[1:], strict=False)]
    given_ = [{d: (len(groups[p]), groups[p][0], 0, 0, 0)} for d, p in zip(depths, known, strict=True)]
    run = trie.Run(depths, shared, given_, lambda i, d: 2, lambda i, d: trie.prefix_keys(known[i])[d], whole=True)
    got = sorted(tuple(r[c] for c in ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens"))
                 for r in trie.node_rows(run, {}, keyed=True))
    assert sorted(got, key=str) == sorted((r[:-1] for r in plain_trie(paths)), key=str)


def test_turns_in_order(spark):
    rows = [
        (1, 2, "user", "third one"), (1, None, None, None), (1, 0, "user", "a  b\tc"), (1, 0, "user", "a  b\tc"),
        (None, 1, "user", "nobody's"), (2, 0, "", ""), (20, 0, "user", "head"),
        *[(c, 0, "user", f"own {c}") for c in (21, 22, 23)],
    ]
    turns = spark.createDataFrame(rows, TURN).selectExpr("*", "1 AS unit", "2 AS units", "3 AS part", "4 AS path")
    own = {r["conv_id"]: r["units"] for r in trie.turn_units(turns).collect()}
    unit = lambda role, text: sha256(f"{len(role)}:{role}{text}".encode()).hexdigest()[:32] + f"{len(text.split()):016x}"
    assert own[1] == [unit("", ""), unit("user", "a  b\tc"), unit("user", "a  b\tc"), unit("user", "third one")]
    assert own[2] == [unit("", "")] and set(own) == {1, 2, 20, 21, 22, 23}
    paths = {r["conv_id"]: r["path"].hex() for r in rebuilt_conversations(turns).collect()}
    for c in (20, 21, 22, 23):
        taken = zlib.crc32(str(c).encode()) % 4
        assert paths[c] == unit("user", "head" if taken or c == 20 else f"own {c}")
    assert rebuilt_conversations(turns.limit(0)).collect() == []
    assert QUERIES["op12_trie"](spark, FOLDER).filter("depth = 0").count() == 1


# ---- Merkle manifest ----------------------------------------------------------------------------


def digest(*parts):
    return sha256("".join(parts).encode()).hexdigest()


def plain_leaf(r, text):
    fields = [r["doc_id"], r["source"], r["lang"], r["n_chars"], text]
    return digest(*["-" if f is None else f"{len(str(f).encode())}:{f}" for f in fields])


def plain_levels(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([digest(*levels[-1][i : i + 8]) for i in range(0, len(levels[-1]), 8)])
    return levels


def plain_fold(levels, at, changed, siblings):
    for level in levels[:-1]:
        begin = at // 8 * 8
        run = level[begin : begin + 8]
        siblings += run[: at - begin] + run[at - begin + 1 :]
        changed = digest(*run[: at - begin], changed, *run[at - begin + 1 :])
        at //= 8
    return changed


def plain_audit(rows):
    trees = {}
    for r in rows:
        trees.setdefault(r["lang"], []).append((r["doc_id"] is not None, r["doc_id"] or 0, plain_leaf(r, r["text"]), r))
    order = sorted(trees, key=lambda t: (t is not None, (t or "").encode()))
    built = {}
    for t in order:
        trees[t].sort(key=lambda x: x[:3])
        built[t] = plain_levels([leaf for _, _, leaf, _ in trees[t]])
    top = plain_levels([built[t][-1][0] for t in order])
    out = []
    for n, t in enumerate(order):
        for at, (_, _, leaf, r) in enumerate(trees[t]):
            text = r["text"]
            if text is not None and r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 3 == 0:
                text = re.sub("[A-Z]", lambda m: m[0].lower(), text)
            siblings = []
            folded = plain_fold(top, n, plain_fold(built[t], at, plain_leaf(r, text), siblings), siblings)
            root = top[-1][0]
            out.append((r["doc_id"], leaf, built[t][-1][0], root, digest(*siblings), folded, folded == root))
    return sorted(out, key=str)


def audit(docs, **options):
    columns = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    found = merkle.build_manifest(docs, merkle.tampered_third(), **options).audit()
    return sorted(map(tuple, found.select(*columns).collect()), key=str)


@pytest.mark.parametrize("options", [{}, {"height": 1, "range_rows": 7}, {"height": 2, "range_rows": 50}])
def test_manifest_like_plain_one(spark, options):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    assert audit(docs, **options) == plain_audit(docs.collect())


@pytest.mark.parametrize("height", [1, 4])
def test_manifest_of_odd_rows(spark, odd, height):
    assert audit(odd, height=height) == plain_audit(odd.collect())
    assert audit(odd.limit(0), height=height) == []
    one = odd.filter("doc_id = 1")
    [row] = audit(one, height=height)
    assert row[1] == row[2] == row[3] and row[4] == sha256().hexdigest()


@pytest.mark.parametrize("rows", [9, 513])
def test_manifest_of_full_and_broken_runs(spark, rows):
    many = spark.range(rows).select(
        F.col("id").alias("doc_id"), F.concat(F.lit("Text "), "id").alias("text"),
        F.when(F.col("id") % 17 != 0, F.concat(F.lit("l"), (F.col("id") % 11).cast("string"))).alias("lang"),
        F.lit("s").alias("source"), F.lit(None).cast("bigint").alias("n_chars"),
    )
    for docs in (many.withColumn("lang", F.lit("en")),) if rows > 9 else (many,):
        assert audit(docs, height=1) == audit(docs) == plain_audit(docs.collect())


def test_no_tampering_verifies_everything(spark, odd):
    assert merkle.build_manifest(odd).audit().filter("NOT verified").count() == 0
