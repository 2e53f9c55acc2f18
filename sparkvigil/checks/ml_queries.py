"""Registered queries over a full training run, and over intake and artefacts.

A model's numbers have no SQL counterpart. These queries therefore return keys and sizes that SQL can
work out, and next to them whether the model's output holds what its definition promises: each is
computed from the rows, by another way than the library's own where there is one.
"""

from __future__ import annotations

from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkvigil.operators import artifacts, evaluation, features, models, sampling, scoring, training
from sparkvigil.session import scratch_path, stage
from sparkvigil.sources import retail, tables
from sparkvigil.sources.commits import file_system, hadoop_path
from sparkvigil.sources.schemas import FEATURES

# Bound on the rows of each class that the registered queries fit their models on; the published job
# takes 250,000. What the queries return does not depend on it: sizes follow it, promises hold for any.
FIT_ROWS = 1_000
CLOSE = 1e-9

_runs: dict[tuple, training.Run] = {}


def training_run(spark: SparkSession, d: str) -> training.Run:
    """The published parameters on the whole tables, fitted on ``FIT_ROWS`` rows a class, once per
    session and state of the tables' files."""
    key = (spark.sparkContext.applicationId, d, *(state_of_files(spark, f"{d}/{t}.parquet") for t in ("events", "customer")))
    if key not in _runs:
        _runs[key] = training.train_run(
            retail.transactions(spark, d), retail.customers(spark, d), target_rows=FIT_ROWS
        )
    return _runs[key]


def state_of_files(spark: SparkSession, path: str) -> tuple:
    """Names, sizes and times of the files of a table."""
    found = file_system(spark, path).listStatus(hadoop_path(spark, path))
    return tuple(sorted((f.getPath().getName(), f.getLen(), f.getModificationTime()) for f in found))


def mixed_batch(spark: SparkSession, d: str) -> DataFrame:
    """The batch upload with missing, text, unknown and numeric customer ids and mixed letter case."""
    tid, own = F.col("transaction_id").cast("long"), F.col("customer_id")
    customer = (
        F.when(tid % 5 == 0, F.lit(None))
        .when(tid % 5 == 1, F.concat(F.lit("C-"), own))
        .when(tid % 5 == 2, F.lit("N/A"))
        .otherwise(own)
    )
    category = F.when(tid % 3 == 0, F.upper("merchant_category")).when(
        tid % 3 == 1, F.initcap("merchant_category")
    )
    return retail.batch_text(retail.transactions(spark, d)).withColumns(
        {
            "customer_id": customer,
            "merchant_category": F.coalesce(category, F.col("merchant_category")),
        }
    )


def good_batch(spark: SparkSession, d: str) -> DataFrame:
    return tables.split_rejects(tables.parse_batch(mixed_batch(spark, d)))[0]


def stored_batch(spark: SparkSession, d: str) -> DataFrame:
    """The good rows, written once: looking up history reads them more than once."""
    return stage(good_batch(spark, d), "batch")


def close(a: Column, b: Column) -> Column:
    return F.abs(a - b) <= CLOSE


def in_unit(p: Column) -> Column:
    return F.coalesce((p >= 0) & (p <= 1), F.lit(False))


def score_batch(spark, d):
    """Every good row of a batch with any customer id, scored by a trained model."""
    out = scoring.score_batch(good_batch(spark, d), training_run(spark, d).scorer, models.GRADIENT_BOOSTED)
    fraud, p = F.col("prediction") == "FRAUD", F.col("confidence")
    ladder = F.expr(
        "CASE WHEN prediction <> 'FRAUD' THEN 'LEGIT' WHEN confidence >= 0.9D THEN 'CRITICAL'"
        " WHEN confidence >= 0.7D THEN 'HIGH' WHEN confidence >= 0.5D THEN 'MEDIUM' ELSE 'LOW' END"
    )
    return out.select(
        "transaction_id",
        "customer_id",
        "amount",
        "merchant_category",
        "hour",
        in_unit(p).alias("probability_holds"),
        (fraud == (p > 0.5)).alias("prediction_holds"),
        (F.col("risk_level") == ladder).alias("level_holds"),
    )


def serving_features(spark, d):
    """History and category statistics of batch rows, looked up or default."""
    rows = scoring.with_serving_features(stored_batch(spark, d), training_run(spark, d).scorer)
    rounded = [F.round(c, 6).alias(c) for c in ("merchant_fraud_rate", "merchant_fraud_volatility")]
    return rows.select(
        "transaction_id",
        "customer_transaction_count",
        "customer_fraud_count",
        F.round("customer_fraud_rate", 6).alias("customer_fraud_rate"),
        *rounded,
    )


def compare_models_ml(spark, d):
    """Votes of all models per transaction against their own rows."""
    scorer = training_run(spark, d).scorer
    scored = stage(
        scoring.score(retail.transactions(spark, d).drop("is_fraud"), scorer).select("transaction_id", "scores"),
        "compared",
    )
    votes = scoring.with_vote(scoring.model_agreement(scored, ["transaction_id"], len(scorer.models)))
    long = scoring.score_all_models(scored, [F.col("transaction_id").alias("id")])
    again = long.groupBy("id").agg(
        F.sum("prediction").alias("flags"),
        F.avg("fraud_probability").alias("mean"),
        F.max("fraud_probability").alias("top"),
        F.max_by("model", F.struct("fraud_probability")).alias("any_leader"),
        F.map_from_entries(F.collect_list(F.struct("model", "fraud_probability"))).alias("by_model"),
    )
    decision = F.expr("CASE WHEN flags >= 2 THEN 'block' WHEN flags = 1 THEN 'review' ELSE 'approve' END")
    return votes.join(again, F.col("id") == F.col("transaction_id")).select(
        "transaction_id",
        "models_total",
        (F.col("models_flagging") == F.col("flags")).alias("flags_hold"),
        (F.col("decision") == decision).alias("decision_holds"),
        close(F.col("mean_confidence"), F.col("mean")).alias("mean_holds"),
        (F.col("by_model")[F.col("most_confident_model")] == F.col("top")).alias("leader_holds"),
    )


def feature_importance(spark, d):
    """Ranks and shares of every feature of the tree models."""
    table = stage(models.feature_importance(spark, training_run(spark, d).trained.models), "importance")
    totals = table.groupBy("model").agg(
        F.sum("importance").alias("total"),
        F.countDistinct("feature").alias("features"),
        F.sort_array(F.collect_list(F.struct("importance_rank", "importance"))).alias("ranked"),
    )
    falling = F.forall(
        F.sequence(F.lit(1), F.size("ranked") - 1),
        lambda i: F.element_at("ranked", i)["importance"] >= F.element_at("ranked", i + 1)["importance"],
    )
    return table.join(totals, "model").select(
        "model",
        "importance_rank",
        F.col("feature").isin(FEATURES).alias("feature_known"),
        F.col("features").cast("int").alias("features"),
        close(F.col("total"), F.lit(1.0)).alias("total_holds"),
        falling.alias("order_holds"),
    )


def scenario_scores(spark, d):
    scores = scoring.scenario_scores(spark, training_run(spark, d).scorer)
    p = F.col("fraud_probability")
    return scores.select(
        "scenario",
        "model",
        in_unit(p).alias("probability_holds"),
        ((F.col("prediction") == 1) == (p > 0.5)).alias("prediction_holds"),
    )


def train_evaluate(spark, d):
    """The run's metrics against counts over its scored test rows, and Spark's own evaluator."""
    run = training_run(spark, d)
    scored = run.scored
    label, flag = F.col("label") == 1, F.col("prediction") == 1
    counts = scored.groupBy("model").agg(
        F.count(F.lit(1)).alias("test_rows"),
        F.avg(F.when(label == flag, 1.0).otherwise(0.0)).alias("right"),
        F.avg(F.when(flag, F.when(label, 1.0).otherwise(0.0))).alias("precise"),
        F.avg(F.when(label, F.when(flag, 1.0).otherwise(0.0))).alias("found"),
    )
    areas = [
        (
            name,
            BinaryClassificationEvaluator(rawPredictionCol="fraud_probability", labelCol="label", numBins=0).evaluate(
                scored.filter(F.col("model") == name)
            ),
        )
        for name in run.scorer.models
    ]
    table = evaluation.with_quality_band(run.metrics).join(counts, "model")
    table = table.join(F.broadcast(spark.createDataFrame(areas, "model string, area double")), "model")
    p, r = F.coalesce("precise", F.lit(0.0)), F.coalesce("found", F.lit(0.0))
    f1 = F.coalesce(F.try_divide(2 * p * r, p + r), F.lit(0.0))
    return table.select(
        "model",
        "test_rows",
        close(F.col("accuracy"), F.col("right")).alias("accuracy_holds"),
        close(F.col("precision_fraud"), p).alias("precision_holds"),
        close(F.col("recall_fraud"), r).alias("recall_holds"),
        close(F.col("f1_fraud"), f1).alias("f1_holds"),
        close(F.col("auc_roc"), F.col("area")).alias("auc_holds"),
    )


def run_summary(spark, d):
    run = training_run(spark, d)
    best = run.metrics.agg(F.max("f1_weighted").alias("f1"), F.max("auc_roc").alias("auc"))
    return training.run_summary(run).crossJoin(F.broadcast(best)).select(
        "incomplete_rows",
        "original_rows",
        "after_capping_rows",
        "after_balancing_rows",
        "test_rows",
        "feature_count",
        "model_count",
        ((F.col("best_f1") == F.col("f1")) & (F.col("best_auc") == F.col("auc"))).alias("best_holds"),
    )


def amount_quantiles_approx(spark, d):
    """Each quartile's rank error against the counts below and at it."""
    tx = retail.transactions(spark, d)
    row = features.amount_quantiles(tx, rel_err=0.05).first()
    parts = []
    for name, p in (("q25", 0.25), ("q50", 0.5), ("q75", 0.75)):
        below, upto = F.avg((F.col("amount") < row[name]).cast("int")), F.avg((F.col("amount") <= row[name]).cast("int"))
        parts.append(F.struct(F.lit(name).alias("quartile"), ((below <= p + 0.05) & (upto >= p - 0.05)).alias("rank_holds")))
    return tx.agg(F.array(*parts).alias("parts")).select(F.inline("parts"))


def balance_native(spark, d):
    """Spark's sampling: which rows, and how many."""
    tx = retail.transactions(spark, d)
    out = stage(sampling.balance(tx, "is_fraud", FIT_ROWS, method="native"), "balanced")
    strange = out.join(tx, ["transaction_id", "is_fraud"], "left_anti").count()
    legit = F.count_if(F.col("is_fraud") == 0)
    fraud = F.count_if(F.col("is_fraud") == 1)
    repeated = out.filter("is_fraud = 0").groupBy("transaction_id").count().filter("count > 1").count()
    return out.agg(
        F.lit(strange).cast("long").alias("rows_from_elsewhere"),
        F.lit(repeated).cast("long").alias("legit_repeated"),
        (F.abs(legit - FIT_ROWS) <= 6 * FIT_ROWS**0.5).alias("legit_size_holds"),
        (fraud <= FIT_ROWS).alias("fraud_bound_holds"),
        (fraud >= FIT_ROWS - 6 * FIT_ROWS**0.5).alias("fraud_size_holds"),
    )


def split_native(spark, d):
    """Spark's split: every row on one side, and the sizes."""
    tx = retail.transactions(spark, d)
    train, test = (stage(part, "part") for part in sampling.split(tx, method="native"))
    both = train.join(test, "transaction_id", "left_semi").count()
    sides = train.select("transaction_id").union(test.select("transaction_id"))
    lost = tx.join(sides, "transaction_id", "left_anti").count()
    total, kept = tx.count(), train.count()
    return spark.createDataFrame(
        [(total, kept + test.count(), both, lost, abs(kept - 0.8 * total) <= 6 * (0.16 * total) ** 0.5)],
        "rows bigint, split_rows bigint, on_both_sides bigint, lost bigint, share_holds boolean",
    )


def artifacts_round_trip(spark, d):
    """A saved and restored scorer on raw batch rows against the one in memory."""
    run, root = training_run(spark, d), scratch_path(spark, "artifacts")
    training.save_run(run, root, models.merchant_categories(retail.transactions(spark, d)))
    restored = artifacts.load_artifacts(spark, root)
    batch = stored_batch(spark, d)
    one, two = (
        stage(scoring.score_all_models(scoring.score(batch, s), ["transaction_id", "customer_transaction_count"]), "scored")
        for s in (run.scorer, restored)
    )
    key = ["transaction_id", "model"]
    other = two.select(*key, *[F.col(c).alias(f"{c}_2") for c in one.columns if c not in key])
    same = [F.col(c).eqNullSafe(F.col(f"{c}_2")) for c in one.columns if c not in key]
    all_same = same[0]
    for s in same[1:]:
        all_same = all_same & s
    return one.join(other, key, "full_outer").agg(
        F.count(F.lit(1)).alias("scores"), F.count_if(~all_same).alias("differences")
    )


def model_registry(spark, d):
    """The registry row's names, weights and per-model metrics of a training run."""
    run = training_run(spark, d)
    row = models.model_registry(run.metrics, evaluation.best_model(run.metrics), run.fraud_weight)
    flat = row.select(
        F.explode("all_models").alias("model"),
        "metrics",
        F.size("feature_columns").alias("feature_count"),
        F.round(F.col("class_weights")["1.0"], 6).alias("fraud_weight"),
        F.col("training_date").try_cast("timestamp").isNotNull().alias("date_holds"),
    )
    found = flat.join(run.metrics.withColumnRenamed("model", "name"), F.col("model") == F.col("name"))
    kept = F.col("metrics")[F.col("model")]
    holds = close(kept["accuracy"], F.col("accuracy")) & close(kept["auc_roc"], F.col("auc_roc"))
    return found.select("model", "feature_count", "fraud_weight", "date_holds", holds.alias("metrics_hold"))


def processed_table(spark, d):
    """The fifteen processed columns, the scaled vector as numbers, after a round trip."""
    feats = stage(features.feature_table(retail.transactions(spark, d), retail.customers(spark, d)), "features")
    legit, fraud = sampling.two_class_counts(feats)
    scaler = models.fit_scaler(models.assemble(feats))
    path = scratch_path(spark, "processed")
    tables.write_processed(training.processed_table(feats, scaler, "ratio", legit / fraud), path)
    table = tables.read_processed(spark, path)
    view = features.training_view(table)
    if view.columns != ["features", "label", "class_weight"] or len(table.columns) != 15:
        raise ValueError("the processed table does not have its columns")
    scaled = vector_to_array("features_scaled")
    plain = table.withColumns({f"scaled_{f}": F.round(scaled[i], 6) for i, f in enumerate(FEATURES)})
    return (
        tables.drop_vectors(plain)
        .withColumns(
            {
                c: F.round(c, 6)
                for c in ("customer_fraud_rate", "merchant_fraud_rate", "merchant_fraud_volatility", "class_weight")
            }
        )
    )


def schema_overview(spark, d):
    """Columns of the transactions with their types."""
    return tables.schema_overview(retail.transactions(spark, d))


def kept_stages(spark, d):
    """Scoring with its intermediate vectors kept: they lead to the same probabilities."""
    scorer = training_run(spark, d).scorer
    rows = scoring.score(stored_batch(spark, d), scorer, keep_stages=True)
    first = F.col("scores")[0]
    return rows.select(
        "transaction_id",
        F.size(vector_to_array("features_raw")).alias("raw_features"),
        (vector_to_array("features_raw")[0] == F.col("amount")).alias("amount_first"),
        close(vector_to_array("probability_0")[1], first["fraud_probability"]).alias("probability_holds"),
    )


def csv_intake(spark, d):
    """Transaction files with doubled quotes, line breaks in quotes, short and surplus lines."""
    tid = F.col("transaction_id")
    name = F.when(tid % 50 == 3, F.concat(F.lit('the "best" '), "merchant_category")).when(
        tid % 50 == 5, F.concat("merchant_category", F.lit("\nnext line"))
    )
    name = F.coalesce(name, F.col("merchant_category"))
    quoted = F.concat(F.lit('"'), F.replace(name, F.lit('"'), F.lit('""')), F.lit('"'))
    start = [tid.cast("string"), F.col("customer_id").cast("string"), F.col("transaction_timestamp").cast("string")]
    amount = F.when(tid % 50 == 17, "").otherwise(F.col("amount").cast("string"))
    whole = [*start, amount, quoted, F.col("is_fraud").cast("string")]
    line = (
        F.when(tid % 50 == 9, F.concat_ws(",", *start[:2]))
        .when(tid % 50 == 13, F.concat_ws(",", *whole, F.lit("surplus")))
        .otherwise(F.concat_ws(",", *whole))
    )
    header = "transaction_id,customer_id,transaction_timestamp,amount,merchant_category,is_fraud"
    # The first row of every partition, and so of every file, brings the header.
    is_first = F.monotonically_increasing_id() % (1 << 33) == 0
    lines = retail.transactions(spark, d).repartition(3).select(line.alias("line"), is_first.alias("is_first"))
    path = scratch_path(spark, "intake")
    headed = F.when(F.col("is_first"), F.array(F.lit(header), F.col("line"))).otherwise(F.array("line"))
    lines.select(F.explode(headed).alias("value")).write.text(path)
    read = tables.read_transactions(spark, path, multiline=True)
    good = F.col("reject_reason").isNull()
    return read.select(
        "transaction_id", F.when(good, F.col("merchant_category")).alias("merchant_category"), "reject_reason"
    )


ML_QUERIES = {
    f.__name__: f
    for f in [
        score_batch,
        serving_features,
        compare_models_ml,
        feature_importance,
        scenario_scores,
        train_evaluate,
        run_summary,
        amount_quantiles_approx,
        balance_native,
        split_native,
        artifacts_round_trip,
        model_registry,
        processed_table,
        schema_overview,
        kept_stages,
        csv_intake,
    ]
}
