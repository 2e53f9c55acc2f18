"""What is kept between runs: commits and versions, stream sinks, keyed history, snapshots, stored layouts."""

from __future__ import annotations

import datetime as dt
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import Row
from pyspark.sql import functions as F

from sparkvigil.checks import state_queries
from sparkvigil.operators import features, scoring, sketches, snapshots
from sparkvigil.session import scratch_path
from sparkvigil.sources import layout, retail, tables
from sparkvigil.sources.commits import CommitLog, Versions, file_system, hadoop_path
from sparkvigil.streaming.history import LATE_LABEL, History, Ring, history_stream
from sparkvigil.streaming.scoring import read_rejects, read_scored, score_stream, with_rejects
from sparkvigil.streaming import sink as sink_module
from sparkvigil.streaming.sink import StreamSink

SF_DIR = "/root/testdata/sf0.001"
START = dt.datetime(2024, 1, 15)


def same(one, two):
    assert one.columns == two.columns
    assert one.exceptAll(two).count() == two.exceptAll(one).count() == 0


# ---- commits and versions -----------------------------------------------------------------------


def test_a_name_is_committed_once(spark):
    log = CommitLog(spark, scratch_path(spark, "log"))
    assert log.names() == []
    assert log.commit("a", {"x": 1}) and not log.commit("a", {"x": 2})
    assert log.commit("b", {"text": "é\n"}) and log.names() == ["a", "b"]
    assert log.read("a") == {"x": 1} and log.read("b") == {"text": "é\n"}
    log.drop("a")
    assert log.names() == ["b"]


def test_versions_count_from_their_commit_on(spark):
    versions = Versions(spark, scratch_path(spark, "versions"))
    assert versions.newest() is None and versions.content() is None
    folders = []
    for n in range(4):
        folders.append(versions.new_folder())
        spark.range(n).write.parquet(folders[-1])
        assert versions.publish(folders[-1], rows=n) == n + 1
    spark.range(9).write.parquet(versions.new_folder())  # its writer broke off
    assert versions.content()["rows"] == 3 and spark.read.parquet(versions.content()["folder"]).count() == 3
    assert not versions.publish_after(3, folders[0]) and versions.publish_after(4, folders[0], rows=0)
    versions.keep(2)
    assert versions.numbers() == [4, 5] and spark.read.parquet(versions.content(4)["folder"]).count() == 3


# ---- stream sinks -------------------------------------------------------------------------------


def numbers(spark, a, b):
    return spark.range(a, b).select("id")


def test_a_micro_batch_counts_once_with_all_its_outputs(spark):
    sink = StreamSink(spark, scratch_path(spark, "sink"))
    like = numbers(spark, 0, 0)
    assert sink.read("good", like).count() == 0
    assert sink.append("s", 0, {"good": numbers(spark, 0, 5), "bad": numbers(spark, 5, 7)})
    assert not sink.append("s", 0, {"good": numbers(spark, 0, 5), "bad": numbers(spark, 5, 7)})
    broken = numbers(spark, 7, 9).select(F.raise_error(F.lit("broken")).cast("bigint").alias("id"))
    with pytest.raises(Exception, match="broken"):
        sink.append("s", 1, {"good": numbers(spark, 7, 9), "bad": broken})
    assert sink.read("good", like).count() == 5 and sink.read("bad", like).count() == 2
    assert sink.append("s", 1, {"good": numbers(spark, 7, 9)}) and sink.append("t", 0, {"good": numbers(spark, 9, 10)})
    assert sorted(r.id for r in sink.read("good", like).collect()) == [0, 1, 2, 3, 4, 7, 8, 9]


def test_folds_keep_rows_and_bound_folders(spark):
    sink = StreamSink(spark, scratch_path(spark, "sink"), fan=2)
    like = numbers(spark, 0, 0)
    for n in range(13):
        assert sink.append("s", n, {"good": numbers(spark, 10 * n, 10 * n + 10)})
        sink.fold_when_due()
        assert not sink.append("s", n, {"good": numbers(spark, 0, 10)})
        state = sink.state()
        levels = [level for level, _ in state["folders"]["good"]]
        assert all(levels.count(level) <= 2 for level in levels) and len(state["batches"]) < 2
        assert len(sink.log.names()) <= 2 + 4
    assert sorted(r.id for r in sink.read("good", like).collect()) == list(range(130))
    sink.compact()
    sink.compact()
    kept = file_system(spark, sink.root).listStatus(hadoop_path(spark, f"{sink.root}/good"))
    assert len(kept) <= 8 and sink.read("good", like).count() == 130
    assert not sink.compact()


def test_a_lost_fold_leaves_the_table_as_it_was(spark, monkeypatch):
    sink = StreamSink(spark, scratch_path(spark, "sink"))
    sink.append("s", 0, {"good": numbers(spark, 0, 4)})
    before = sink.state()
    other = StreamSink(spark, sink.root)
    monkeypatch.setattr(other, "state", lambda: before)
    assert sink.compact() and not other.compact()
    assert sink.read("good", numbers(spark, 0, 0)).count() == 4


def test_rejects_and_scored_rows_appear_together(spark):
    raw = retail.batch_text(retail.transactions(spark, SF_DIR))
    source, sink = scratch_path(spark, "upload"), scratch_path(spark, "sink")
    checkpoint = scratch_path(spark, "checkpoint")
    raw.repartition(3).write.parquet(source)
    stream = spark.readStream.schema(raw.schema).option("maxFilesPerTrigger", 1).parquet(source)
    both = with_rejects(tables.parse_batch, lambda good: good.select("transaction_id", "amount"))
    for _ in range(2):
        score_stream(stream, both, sink, checkpoint, fan=2).awaitTermination()
    good, bad = tables.split_rejects(tables.parse_batch(raw))
    same(read_scored(spark, sink, good.select("transaction_id", "amount")), good.select("transaction_id", "amount"))
    same(read_rejects(spark, sink, bad), bad)


# ---- keyed history ------------------------------------------------------------------------------


def plain_history(rows, frame):
    """(rate, rows, frauds) of (at, id, label) in the order of arrival."""
    seen, out = [], []
    for at, number, label in rows:
        before = sorted(e for e in seen if (e[0], e[1]) < (at, number))
        known = [e[2] for e in before[-frame:] if e[2] is not None]
        rate = sum(known) / len(known) if known else 0.0
        out.append((rate, len(before) + 1, sum(e[2] or 0 for e in before) + (label or 0)))
        seen.append((at, number, label))
    return out


@settings(max_examples=150, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 30), st.sampled_from([0, 1, None])), max_size=40), st.integers(1, 6))
def test_ring_like_plain_history(steps, frame):
    rows = [(START + dt.timedelta(minutes=m), i, label) for i, (m, label) in enumerate(steps)]
    ring = Ring(0, 0, [], frame, slack=40)
    assert [ring.add(*r) for r in rows] == plain_history(rows, frame)
    ordered = sorted(rows)
    ring = Ring(0, 0, [], frame, slack=0)
    assert [ring.add(*r) for r in ordered] == plain_history(ordered, frame)
    assert len(ring.newest) <= frame


def test_late_labels_change_what_follows():
    ring = Ring(0, 0, [], 3, slack=0)
    for i in range(5):
        ring.add(START + dt.timedelta(hours=i), i, None)
    ring.correct(4, 1)
    ring.correct(0, 1)  # has left the ring: it counts, but in no frame
    assert ring.add(START + dt.timedelta(hours=9), 9, 0) == (1.0, 6, 2)
    ring.correct(4, 0)
    assert ring.add(START + dt.timedelta(hours=10), 10, None) == (0.0, 7, 1)


def test_a_customer_costs_one_read_and_one_compact_write_of_state():
    class Value:
        calls, held = [], None

        def exists(self):
            self.calls.append("exists")
            return self.held is not None

        def get(self):
            self.calls.append("get")
            return self.held

        def update(self, value):
            self.calls.append("update")
            self.held = value

    names = ["customer_id", "transaction_id", "transaction_datetime", "is_fraud"]
    process = History(names, frame=4, slack=3)
    process.state = Value()
    steps = [(0, None, 1), (1, dt.datetime(1970, 1, 1), None), (2, dt.datetime(1969, 7, 20), 1), *[(i, START + dt.timedelta(hours=i), i % 2) for i in range(3, 12)]]
    rows = [Row(*names, LATE_LABEL)(1, number, at, label, False) for number, at, label in steps]
    got = []
    for part in (rows[:3], rows[3:5], rows[5:]):
        got += [(r.transaction_id, tuple(r)[4:]) for r in process.handleInputRows((1,), iter(part), None)]
    assert process.state.calls == ["get", "update"] * 3
    assert [type(v) for v in process.state.held] == [int, int, bytes] and len(process.state.held[2]) == 7 * 25
    least = dt.datetime.min
    in_order = sorted(steps, key=lambda s: (s[1] is not None, s[1] or least, s[0]))
    want = plain_history([(at or least, number, label) for number, at, label in in_order], 4)
    assert got == [(s[0], h) for s, h in zip(in_order, want, strict=True)]


def test_stream_history_does_not_depend_on_the_cut(spark):
    tx = features.with_time_features(retail.transactions(spark, SF_DIR)).filter("customer_id <= 4")
    tx = tx.unionByName(tx.limit(3).withColumns({"customer_id": F.lit(None).cast("bigint"), "transaction_id": F.col("transaction_id") + 100_000}))
    columns = ["customer_id", "transaction_id", "customer_fraud_rate", "customer_transaction_count", "customer_fraud_count"]
    want = features.with_customer_history(tx, frame=7).select(columns)
    for cuts in ([0.5], [0.1, 0.4, 0.9]):
        source, sink, checkpoint = (scratch_path(spark, n) for n in ("source", "sink", "checkpoint"))
        times = sorted(r[0] for r in tx.select("transaction_datetime").collect())
        edges = [times[0], *[times[int(len(times) * c)] for c in cuts], None]
        for low, high in zip(edges, edges[1:], strict=False):
            part = tx.filter(F.col("transaction_datetime") >= F.lit(low))
            part = part if high is None else part.filter(F.col("transaction_datetime") < F.lit(high))
            part.write.mode("append").parquet(source)
            stream = history_stream(spark.readStream.schema(tx.schema).parquet(source), frame=7)
            score_stream(stream, lambda rows: rows.select(columns), sink, checkpoint).awaitTermination()
        same(read_scored(spark, sink, want), want)


def test_the_query_on_history_passes_only_what_it_needs(spark, monkeypatch):
    passed = []
    real = state_queries.history_stream
    monkeypatch.setattr(state_queries, "history_stream", lambda stream, *a: passed.append(stream.columns) or real(stream, *a))
    got = state_queries.stream_history(spark, SF_DIR)
    assert passed == [["customer_id", "transaction_id", "transaction_datetime", "is_fraud"]] * 3
    same(got, state_queries.history_columns(features.with_customer_history(state_queries.timed(spark, SF_DIR))))


def test_stream_from_a_snapshot_with_late_labels(spark):
    rows = [(1, i, START + dt.timedelta(hours=i), i % 2) for i in range(6)]
    known = spark.createDataFrame(rows, "customer_id bigint, transaction_id bigint, transaction_datetime timestamp_ntz, is_fraud int")
    later = spark.createDataFrame(
        [
            (1, 9, START + dt.timedelta(hours=9), None, False),
            (1, 4, START + dt.timedelta(hours=10), 1, True),
            (1, 11, START + dt.timedelta(hours=11), 1, None),
            (2, 12, START + dt.timedelta(hours=9), 1, False),
        ],
        f"customer_id bigint, transaction_id bigint, transaction_datetime timestamp_ntz, is_fraud int, {LATE_LABEL} boolean",
    )
    source, sink = scratch_path(spark, "source"), scratch_path(spark, "sink")
    later.write.parquet(source)
    stream = history_stream(spark.readStream.schema(later.schema).parquet(source), snapshots.customer_state(known), frame=3)
    score_stream(stream, lambda rows: rows, sink, scratch_path(spark, "checkpoint")).awaitTermination()
    got = {r.transaction_id: tuple(r)[4:] for r in spark.read.parquet(*StreamSink(spark, sink).paths("scored")).collect()}
    assert got == {9: (pytest.approx(2 / 3), 7, 3), 11: (1.0, 8, 5), 12: (0.0, 1, 1)}


# ---- history inside a batch ---------------------------------------------------------------------


@pytest.mark.parametrize("max_group_rows", [2_000_000, 2])
def test_counts_advance_inside_a_batch(spark, max_group_rows):
    profile = spark.createDataFrame([(7, 0.5, 40, 20)], "customer_id bigint, customer_fraud_rate double, customer_transaction_count bigint, customer_fraud_count bigint")
    stats = spark.createDataFrame([("travel", 0.1, 0.2)], "merchant_category string, merchant_fraud_rate double, merchant_fraud_volatility double")
    scorer = scoring.Scorer({}, None, features.Preprocessing([1.0, 2.0, 3.0], 0.0, 1e9, stats), profile)
    rows = [("7", "a", 3), ("7", "b", 1), ("7", "c", 2), ("7", "d", 2), ("x", "e", 1), (None, "f", 1), (None, "g", 2), ("8", "h", 1)]
    batch = spark.createDataFrame(
        [(c, t, START + dt.timedelta(hours=h), 5.0, "travel") for c, t, h in rows],
        "customer_id string, transaction_id string, transaction_timestamp timestamp_ntz, amount double, merchant_category string",
    )
    got = scoring.with_serving_features(batch, scorer, max_group_rows, advance=True)
    assert "_nth" not in got.columns
    assert {r.transaction_id: r.customer_transaction_count for r in got.collect()} == {
        "b": 41, "c": 42, "d": 43, "a": 44, "e": 10, "f": 10, "g": 10, "h": 10,
    }
    still = scoring.with_serving_features(batch, scorer)
    assert {r.customer_transaction_count for r in still.collect()} == {41, 10}


# ---- snapshots ----------------------------------------------------------------------------------


def test_states_merge_in_any_order(spark):
    rng = random.Random(5)
    rows = [
        (rng.choice([1, 2, 3, None]), i, START + dt.timedelta(minutes=rng.randint(0, 40)), rng.choice(["a", "A", "b", None]), rng.choice([0, 1, None]))
        for i in range(200)
    ]
    tx = spark.createDataFrame(rows, "customer_id bigint, transaction_id bigint, transaction_datetime timestamp_ntz, merchant_category string, is_fraud int")
    parts = [tx.filter(F.col("transaction_id") % 4 == n) for n in (2, 0, 3, 1)]
    whole = features.customer_profile(tx, frame=9).withColumn("customer_fraud_rate", F.round("customer_fraud_rate", 9))
    merged = snapshots.merge_customer_states(*[snapshots.customer_state(p, 9) for p in parts], frame=9)
    same(snapshots.profile_of(merged, 9).withColumn("customer_fraud_rate", F.round("customer_fraud_rate", 9)), whole)
    by_pairs = snapshots.merge_customer_states(
        snapshots.merge_customer_states(*[snapshots.customer_state(p, 9) for p in parts[:2]], frame=9),
        snapshots.merge_customer_states(*[snapshots.customer_state(p, 9) for p in parts[2:]], frame=9),
        frame=9,
    )
    same(by_pairs, merged)
    digits = {c: F.round(c, 9) for c in ("merchant_fraud_rate", "merchant_fraud_volatility")}
    stats = snapshots.merchant_stats_of(snapshots.merge_merchant_states(*[snapshots.merchant_state(p) for p in parts]))
    same(stats.withColumns(digits), features.merchant_stats(tx).withColumns(digits))


def test_a_part_is_added_once_and_an_empty_one_changes_nothing(spark):
    tx = features.with_time_features(retail.transactions(spark, SF_DIR))
    store = snapshots.SnapshotStore(spark, scratch_path(spark, "store"))
    assert store.add("all", tx) and not store.add("all", tx) and store.add("none", tx.limit(0))
    assert store.parts() == ["all", "none"]
    assert store.read("customers").agg(F.sum("rows")).first()[0] == 1000
    state = store.preprocessing()
    assert state.lower_bound < state.percentiles[1] < state.upper_bound and state.merchant_stats.count() == 5
    with pytest.raises(FileNotFoundError):
        snapshots.SnapshotStore(spark, scratch_path(spark, "nothing")).profile()


def test_sketches_merge_to_whole_quantiles(spark):
    tx = spark.range(20_000).select(
        F.col("id").alias("transaction_id"), (F.col("id") % 997).cast("double").alias("amount"),
        F.when(F.col("id") % 3 != 0, "A").alias("merchant_category"),
        (F.lit("2024-01-01").cast("timestamp_ntz") + F.make_interval(hours=(F.col("id") % 100).cast("int"))).alias("transaction_datetime"),
    )
    odd = tx.limit(2).withColumn("amount", F.when(F.col("transaction_id") == 0, F.lit(float("nan"))))
    found = sketches.amount_sketches(tx.unionByName(odd))
    assert found.count() == 10 and found.agg(F.sum("rows")).first()[0] == 20_000
    row = sketches.sketched_quantiles(found, {"low": 0.1, "half": 0.5}).first()
    most = 997 * sketches.RANK_ERROR + 1
    assert row.rows == 20_000 and abs(row.half - 498) <= most and abs(row.low - 99) <= most
    with pytest.raises(ValueError, match="amount"):
        sketches.preprocessing_quantiles(found.limit(0))


# ---- stored layout ------------------------------------------------------------------------------


def exchanges(df):
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange")


def test_bucketed_tables_need_no_exchange(spark):
    tx = features.with_time_features(retail.transactions(spark, SF_DIR))
    left, right = scratch_path(spark, "left"), scratch_path(spark, "right")
    assert layout.write_bucketed(tx.limit(10), left) == 1 and layout.write_bucketed(tx, left) == 2
    layout.write_bucketed(retail.good_customers(spark, SF_DIR), right, order=("customer_id",), buckets=4)
    stored = layout.read_bucketed(spark, left)
    same(stored, tx)
    history = features.with_customer_history(stored)
    assert exchanges(history) == 0 and exchanges(features.with_customer_history(tx)) > 0
    same(history.select(*tx.columns, "customer_fraud_rate"), features.with_customer_history(tx).select(*tx.columns, "customer_fraud_rate"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = stored.join(layout.read_bucketed(spark, right), "customer_id")
        assert exchanges(joined) == 0
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert layout.read_bucketed(spark, left, version=1).count() == 10


def test_bucket_counts_fit_together():
    assert layout.bucket_count(0, 4) == 4 and layout.bucket_count(9_000_000, 4) == 8 and layout.bucket_count(10, 5) == 8


# ---- uploads ------------------------------------------------------------------------------------


def test_only_files_with_line_breaks_in_quotes_are_read_whole(spark):
    head = "transaction_timestamp,amount,merchant_category"
    plain = [head, '2024-01-01 00:00:00,1,"home ""and"" garden"', "2024-01-01 00:00:00,2,x"]
    broken = [head, '2024-01-01 00:00:00,3,"a', 'b ""c', '"', '2024-01-01 00:00:00,4,d']
    root = scratch_path(spark, "lines")
    for i, lines in enumerate([plain, broken, plain]):
        spark.createDataFrame([(x,) for x in lines], "v string").coalesce(1).write.text(f"{root}/f{i}")
    closed, opened = tables.files_with_open_quotes(spark, f"{root}/f*")
    assert len(closed) == 2 and len(opened) == 1 and "/f1/" in opened[0]
    automatic, whole = tables.read_batch(spark, f"{root}/f*"), tables.read_batch(spark, f"{root}/f*", multiline=True)
    columns = [c for c in whole.columns if c != "transaction_id"]
    same(automatic.select(columns), whole.select(columns))
    assert automatic.select("transaction_id").distinct().count() == automatic.count() == 6


def test_a_known_part_is_not_worked_out_again(spark, make_tx, monkeypatch):
    store = snapshots.SnapshotStore(spark, scratch_path(spark, "store"))
    assert store.add("a", make_tx([(1, 1, 0, 5.0, "gaming", 1)]))
    monkeypatch.setattr(snapshots, "stage", lambda *_: pytest.fail("worked out"))
    assert not store.add("a", make_tx([(1, 1, 0, 5.0, "gaming", 1)]))


def test_folded_files_are_bounded_by_rows(spark, monkeypatch):
    monkeypatch.setattr(sink_module, "FILE_ROWS", 10, raising=False)
    sink = StreamSink(spark, scratch_path(spark, "sink"), fan=2)
    for n in range(2):
        sink.append("s", n, {"scored": spark.range(20)})
    assert sink.compact()
    rows = spark.read.parquet(*sink.paths("scored"))
    per_file = rows.groupBy(F.input_file_name().alias("f")).count().agg(F.max("count")).first()[0]
    assert rows.count() == 40 and per_file <= 12
