"""Registered queries over what is kept between runs: keyed state, snapshots, versions, stored layouts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkvigil.checks import ml_queries
from sparkvigil.checks.queries import batch_result, batch_upload, rounded, timed
from sparkvigil.checks.rule_scores import with_rule_prediction
from sparkvigil.operators import artifacts, evaluation, features, models, sampling, scoring, sketches, snapshots, training
from sparkvigil.session import scratch_path, stage
from sparkvigil.sources import layout, retail, tables
from sparkvigil.sources.commits import remove
from sparkvigil.streaming.history import LATE_LABEL, history_stream
from sparkvigil.streaming.scoring import SCORED, read_rejects, score_stream, with_rejects
from sparkvigil.streaming.sink import StreamSink

# How long after its transaction a label is known, in the query on late labels.
LABEL_DELAY = "INTERVAL '36' HOUR"
SLICES = 3
# What customer history is worked out from.
HISTORY_INPUT = ["customer_id", "transaction_id", "transaction_datetime", "is_fraud"]
# Rows of one file of an upload.
UPLOAD_ROWS = 250_000


# ---- streams ------------------------------------------------------------------------------------


def in_slices(rows: DataFrame, column: str, number: int = SLICES) -> list[DataFrame]:
    """The rows in equal slices of time."""
    micros = F.unix_micros(F.col(column).cast("timestamp"))
    low, high = rows.agg(F.min(micros), F.max(micros)).first()
    width = (high - low) // number + 1
    nth = F.floor((micros - low) / width)
    return [rows.filter(nth == i) for i in range(number)]


def arriving(spark: SparkSession, slices: list[DataFrame], start: Callable[[DataFrame], object]) -> None:
    """Let the slices arrive one after another; the stream is started anew for each of them."""
    source = scratch_path(spark, "arrivals")
    for rows in slices:
        rows.write.mode("append").parquet(source)
        start(spark.readStream.schema(rows.schema).parquet(source)).awaitTermination()


def history_columns(rows: DataFrame) -> DataFrame:
    columns = ["customer_id", "transaction_id", "customer_fraud_rate", "customer_transaction_count", "customer_fraud_count"]
    return rounded(rows.select(*columns), "customer_fraud_rate")


def stream_history(spark, d):
    """Customer history from keyed state, over three runs of one stream."""
    sink, checkpoint = scratch_path(spark, "history_sink"), scratch_path(spark, "history_checkpoint")
    tx = retail.transactions(spark, d)

    def start(stream: DataFrame):
        needed = features.with_time_features(stream).select(*HISTORY_INPUT)
        return score_stream(history_stream(needed), history_columns, sink, checkpoint)

    arriving(spark, in_slices(tx, "transaction_timestamp"), start)
    like = history_columns(features.with_customer_history(timed(spark, d)))
    return StreamSink(spark, sink).read(SCORED, like)


def stream_late_labels(spark, d):
    """The same with labels that arrive 36 hours after their transactions, from a snapshot of the first third."""
    sink, checkpoint = scratch_path(spark, "late_sink"), scratch_path(spark, "late_checkpoint")
    tx = timed(spark, d).select(*HISTORY_INPUT)
    known, *rest = in_slices(tx, "transaction_datetime")
    later = rest[0].unionByName(rest[1])
    bare = later.withColumns({"is_fraud": F.lit(None).cast("int"), LATE_LABEL: F.lit(False)})
    labels = later.withColumns(
        {"transaction_datetime": F.expr(f"transaction_datetime + {LABEL_DELAY}"), LATE_LABEL: F.lit(True)}
    )
    initial = stage(snapshots.customer_state(known), "initial")

    def start(stream: DataFrame):
        return score_stream(history_stream(stream, initial), history_columns, sink, checkpoint)

    arriving(spark, in_slices(bare.unionByName(labels), "transaction_datetime"), start)
    like = history_columns(features.with_customer_history(timed(spark, d)))
    return StreamSink(spark, sink).read(SCORED, like)


def rejecting_stream(spark, d, sink: str, checkpoint: str, files: int, fan: int = 100) -> Callable[[], None]:
    """A function that runs a stream over the batch upload in several micro-batches to its end.

    A micro-batch is one file, or several of about ``UPLOAD_ROWS`` rows.
    """
    source = scratch_path(spark, "upload")
    raw = batch_upload(spark, d)
    each = max(1, -(-raw.count() // (files * UPLOAD_ROWS)))
    raw.repartition(files * each).write.parquet(source)
    stream = spark.readStream.schema(raw.schema).option("maxFilesPerTrigger", each).parquet(source)
    both = with_rejects(tables.parse_batch, score_rows_of)
    return lambda: score_stream(stream, both, sink, checkpoint, fan=fan).awaitTermination()


def score_rows_of(good: DataFrame) -> DataFrame:
    return scoring.batch_result(with_rule_prediction(features.with_time_features(good)))


def stream_rejects(spark, d):
    """Rows that a stream could not read, after its last micro-batch was made to run again."""
    sink, checkpoint = scratch_path(spark, "rejects_sink"), scratch_path(spark, "rejects_checkpoint")
    run = rejecting_stream(spark, d, sink, checkpoint, files=3)
    run()
    # Without its mark in the checkpoint, the last micro-batch counts as unfinished.
    last = max(int(r["at"]) for r in spark.read.format("binaryFile").load(f"{checkpoint}/commits").select(
        F.regexp_extract("path", r"(\d+)$", 1).alias("at")).collect())
    remove(spark, f"{checkpoint}/commits/{last}")
    run()
    like = tables.parse_batch(batch_upload(spark, d))
    rejects = read_rejects(spark, sink, like)
    return rejects.select("transaction_id", "customer_id", "merchant_category", "reject_reason")


def stream_folded(spark, d):
    """Scored rows after six micro-batches whose commits were folded into larger files."""
    sink, checkpoint = scratch_path(spark, "folded_sink"), scratch_path(spark, "folded_checkpoint")
    rejecting_stream(spark, d, sink, checkpoint, files=6, fan=2)()
    table = StreamSink(spark, sink, fan=2)
    table.compact()
    return table.read(SCORED, batch_result(spark, d))


# ---- samples and contracts -----------------------------------------------------------------------


def shuffled_rows(spark, d):
    """All transactions in random order: the same rows, and no longer in the order of their ids."""
    tx = retail.transactions(spark, d).select("transaction_id", "amount")
    mixed = stage(sampling.shuffle_rows(tx).withColumn("place", F.monotonically_increasing_id()), "shuffled")
    follows = mixed.agg(F.corr("place", "transaction_id").alias("r")).first()["r"]
    return mixed.select("transaction_id", "amount", F.lit(abs(follows) < 0.5).alias("order_is_random"))


def batch_contract(spark, d):
    """Uploads that lack a required column: which ones are refused, with the columns they lack."""
    raw = batch_upload(spark, d)
    refused = []
    for column in raw.columns:
        try:
            rows = tables.parse_batch(raw.drop(column)).count()
            refused.append((column, None, rows))
        except ValueError as error:
            refused.append((column, column in str(error), None))
    kept = set(tables.batch_template(spark).columns) == set(raw.columns)
    found = spark.createDataFrame(refused, "column_name string, refused boolean, rows_without bigint")
    return found.withColumn("template_has_it", F.lit(kept))


# ---- batches ------------------------------------------------------------------------------------


def serving_history(spark, d):
    """Transaction counts of batch rows that advance along each customer's rows."""
    scorer = ml_queries.training_run(spark, d).scorer
    rows = scoring.with_serving_features(ml_queries.stored_batch(spark, d), scorer, advance=True)
    return rows.select("transaction_id", "customer_transaction_count", "customer_fraud_count")


def serving_history_split(spark, d):
    """The same with every customer cut into blocks."""
    scorer = ml_queries.training_run(spark, d).scorer
    rows = scoring.with_serving_features(ml_queries.stored_batch(spark, d), scorer, max_group_rows=10, advance=True)
    return rows.select("transaction_id", "customer_transaction_count", "customer_fraud_count")


# ---- versions -----------------------------------------------------------------------------------


def artifact_versions(spark, d):
    """A first save, one that breaks off, and a second one without customer history: what each can load."""
    run, root = ml_queries.training_run(spark, d), scratch_path(spark, "versions")
    categories = models.merchant_categories(retail.transactions(spark, d))
    best = evaluation.best_model(run.metrics)
    config = models.preprocessing_state(spark, run.scorer.state, run.fraud_weight)
    registry = models.model_registry(run.metrics, best, run.fraud_weight)
    steps = []

    def note(step: str, version: int | None = None) -> None:
        scorer = artifacts.load_artifacts(spark, root, version=version)
        seen = artifacts.saved_version(spark, root, version)["version"]
        rows = 0 if scorer.profile is None else scorer.profile.count()
        steps.append((step, seen, len(scorer.models), rows, artifacts.saved_categories(spark, root, version).count()))

    training.save_run(run, root, categories)
    note("saved")
    try:
        broken = config.withColumn("lower_bound", F.raise_error(F.lit("the disk is full")).cast("double"))
        artifacts.save_artifacts(root, run.scorer, broken, registry, categories, best.first()["best_by_f1"])
    except PySparkException:
        note("broken off")
    loaded = artifacts.load_artifacts(spark, root)
    loaded.profile = None
    artifacts.save_artifacts(root, loaded, config, registry, categories, best.first()["best_by_f1"])
    note("saved without history")
    note("first again", version=1)
    return spark.createDataFrame(steps, "step string, version int, models int, profile_rows bigint, categories bigint")


# ---- snapshots ----------------------------------------------------------------------------------


def added_parts(spark, d, by: str, order: list[int]) -> snapshots.SnapshotStore:
    """A snapshot store to which the transactions came in parts, in the order given, one of them twice."""
    store = snapshots.SnapshotStore(spark, scratch_path(spark, "snapshots"), frame=20)
    tx = timed(spark, d)
    part = F.pmod(F.xxhash64(by), F.lit(len(order)))
    for n in [*order, order[0]]:
        store.add(f"part-{n}", tx.filter(part == n))
    return store


def snapshot_profile(spark, d):
    """Customer profiles from merged states of four parts."""
    return rounded(added_parts(spark, d, "transaction_id", [2, 0, 3, 1]).profile(), "customer_fraud_rate")


def snapshot_merchants(spark, d):
    """Category statistics from merged states of three parts."""
    state = added_parts(spark, d, "transaction_id", [1, 2, 0]).read("merchants")
    return rounded(snapshots.merchant_stats_of(state), "merchant_fraud_rate", "merchant_fraud_volatility")


def stored_quantiles(spark, d):
    """Quartiles by category from stored sketches: their ranks, proved by counts over the rows."""
    store = added_parts(spark, d, "transaction_datetime", [1, 0])
    names = {"q25": 0.25, "q50": 0.5, "q75": 0.75}
    found = stage(sketches.sketched_quantiles(store.read("sketches"), names, "merchant_category"), "quantiles")
    tx = retail.transactions(spark, d).select("amount", F.col("merchant_category").alias("of"))
    joined = tx.join(F.broadcast(found), F.col("of") == F.col("merchant_category"))
    holds = []
    for name, p in names.items():
        below = F.avg((F.col("amount") < F.col(name)).cast("int"))
        upto = F.avg((F.col("amount") <= F.col(name)).cast("int"))
        error = sketches.RANK_ERROR
        holds.append(((below <= p + error) & (upto >= p - error)).alias(f"{name}_holds"))
    return joined.groupBy("merchant_category").agg(F.max("rows").alias("row_count"), *holds)


def stored_preprocessing(spark, d):
    """Bounds and category count fitted from stored states alone: the ranks of the bounds, by counts."""
    state = added_parts(spark, d, "transaction_datetime", [0, 1, 2]).preprocessing()
    tx, error = retail.transactions(spark, d), sketches.RANK_ERROR
    checks = []
    for name, value, p in [("low", state.lower_bound, 0.005), ("high", state.upper_bound, 0.995)]:
        below, upto = F.avg((F.col("amount") < value).cast("int")), F.avg((F.col("amount") <= value).cast("int"))
        checks.append(((below <= p + error) & (upto >= p - error)).alias(f"{name}_holds"))
    return tx.agg(F.count(F.lit(1)).alias("row_count"), *checks).withColumn(
        "categories", F.lit(state.merchant_stats.count()).cast("bigint")
    )


# ---- stored layout ------------------------------------------------------------------------------


def history_bucketed(spark, d):
    """Customer history over a table stored by customer and time."""
    root = scratch_path(spark, "bucketed")
    layout.write_bucketed(timed(spark, d), root)
    return history_columns(features.with_customer_history(layout.read_bucketed(spark, root)))


def join_bucketed(spark, d):
    """The customer join of two tables stored by customer."""
    left, right = scratch_path(spark, "tx_bucketed"), scratch_path(spark, "customers_bucketed")
    layout.write_bucketed(timed(spark, d), left)
    layout.write_bucketed(retail.good_customers(spark, d), right, order=("customer_id",))
    joined = layout.read_bucketed(spark, left).join(layout.read_bucketed(spark, right), "customer_id")
    return joined.select(
        "customer_id", "transaction_id", "amount", "merchant_category", "is_fraud", "c_acctbal", "c_mktsegment"
    )


STATE_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in [
        stream_history,
        stream_late_labels,
        stream_rejects,
        stream_folded,
        shuffled_rows,
        batch_contract,
        serving_history,
        serving_history_split,
        artifact_versions,
        snapshot_profile,
        snapshot_merchants,
        stored_quantiles,
        stored_preprocessing,
        history_bucketed,
        join_bucketed,
    ]
}
