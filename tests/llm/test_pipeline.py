"""The pipeline against its stages done plainly."""

from __future__ import annotations

from collections import Counter

import corpus_pipeline
from sparkvigil.llm import secrets
from tests.llm import brute

FOLDER = "/root/testdata/sf0.001"


def test_stages_take_effect(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    columns, tables = docs.columns, [docs]
    for name, function in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.stage(function(spark, docs, FOLDER), name)
        assert docs.columns == columns and [t for _, t in docs.dtypes] == [t for _, t in tables[0].dtypes]
        tables.append(docs)
    rows = [t.collect() for t in tables]
    # Language: clean documents stay.
    assert {r["doc_id"] for r in rows[1]} == {r["doc_id"] for r in rows[0] if r["text"]}
    # Near copies: the smallest id of each group of similar five-word shingles.
    assert {r["doc_id"] for r in rows[2]} == set(brute.near_copies([(r["doc_id"], r["text"]) for r in rows[1]]).values())
    # Secrets: masked, nothing else changes.
    before = {r["doc_id"]: r["text"] for r in rows[2]}
    for r in rows[3]:
        assert not brute.secrets(r["text"])
        assert r["text"] == before[r["doc_id"]] or brute.secrets(before[r["doc_id"]]) or secrets.scan(before[r["doc_id"]])
    # Mixture: the words near the targets.
    words = lambda table: Counter({s: 0 for s in ()}) + sum(
        (Counter({r["source"]: len(brute.WORD.findall(r["text"]))}) for r in table), Counter()
    )
    size, mixed = words(rows[3]), words(rows[4])
    assert abs(sum(mixed.values()) - sum(size.values())) < 0.02 * sum(size.values())
    assert all(mixed[s] <= 3 * size[s] for s in mixed)
    # Packing: every mixed row is there.
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, FOLDER).collect()
    assert Counter(r["doc_id"] for r in packed if r["piece"] == 0) == Counter(r["doc_id"] for r in rows[4])


def test_run_is_the_stages(spark):
    rows = corpus_pipeline.run(spark, FOLDER)
    assert {"doc_id", "piece", "sequence_id", "offset"} <= set(rows.columns)
    assert rows.count() > 0


def test_empty_documents(spark, tmp_path):
    spark.read.parquet(f"{FOLDER}/documents.parquet").limit(0).write.parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []


def test_odd_rows_through_all_stages(spark, tmp_path):
    """Null ids and sources, empty and long texts, repeated rows, an id of two texts, clashing names."""
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    rows = {r["doc_id"]: r["text"] for r in docs.collect()}
    groups = brute.near_copies(rows.items())
    alone = [i for i, n in sorted(Counter(groups.values()).items()) if n == 1 and len(rows[i]) > 400]
    texts = [rows[i] for i in alone[:6]]
    long = " ".join(r["text"] for r in docs.filter("lang = 'en'").collect())
    odd = [
        (None, texts[0] + " and more of it", None, None, 1), (None, texts[1] + " in other words", None, "a", None),
        (900, None, "en", "a", 0), (901, "", None, "b", 0), (902, "12 + 3 !", "en", "a", 8),
        (903, long * 3, "en", None, 1), (904, texts[2] + " twice", "en", "b", 7), (904, texts[2] + " twice", "en", "b", 7),
        (905, texts[3] + " with an id", "en", "b", 7), (905, texts[4] + " of two texts", "en", "b", 7),
        (906, texts[5] + " password=hunter2hunter2", "en", "c", 7),
    ]
    more = spark.createDataFrame(odd, docs.select("doc_id", "text", "lang", "source", "n_chars").schema)
    # The originals of these texts would be near copies of theirs.
    rest = docs.filter(~docs["text"].isin(texts))
    table = rest.unionByName(more.select(docs.columns)).selectExpr("*", "1 AS tag", "'x' AS fp", "2 AS size", "3 AS language", "4 AS _row", "5 AS root")
    table.write.parquet(f"{tmp_path}/documents.parquet")
    steps = [spark.read.parquet(f"{tmp_path}/documents.parquet")]
    for name, function in corpus_pipeline.STAGES[:-1]:
        steps.append(corpus_pipeline.stage(function(spark, steps[-1], str(tmp_path)), name))
        assert steps[-1].columns == table.columns
    _, spoken, kept, masked, mixed = steps
    gone = {r["doc_id"] for r in steps[0].select("doc_id").distinct().collect()} - {r["doc_id"] for r in spoken.collect()}
    assert gone == {900, 901, 902} and spoken.count() == steps[0].count() - 3
    ids = Counter(r["doc_id"] for r in kept.collect())
    assert ids[None] == 2 and ids[903] == 1 and ids[904] == 1 and ids[905] == 2 and ids[906] == 1
    assert masked.count() == kept.count() and masked.filter("text LIKE '%hunter2%'").isEmpty()
    assert {r["source"] for r in mixed.select("source").distinct().collect()} >= {None}
    packed = corpus_pipeline.STAGES[-1][1](spark, mixed, str(tmp_path)).collect()
    assert sum(r["piece"] == 0 for r in packed) == mixed.count()
    spots = [(r["sequence_id"], r["offset"], r["length"]) for r in packed]
    assert len(set(spots)) == len(spots) and all(offset + length <= 1024 for _, offset, length in spots)
