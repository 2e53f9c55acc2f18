from __future__ import annotations

from dataclasses import replace

import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from sparkvigil.checks.queries import BALANCE_ROWS
from sparkvigil.operators import artifacts, evaluation, features, models, sampling, scoring, training
from sparkvigil.session import scratch_path, stage
from sparkvigil.sources import retail, tables
from sparkvigil.sources.schemas import FEATURES
from sparkvigil.streaming.scoring import read_scored, score_stream

SF_DIR = "/root/testdata/sf0.001"
# Short fits: these tests check the plan around the models; the registered queries use the full ones.
QUICK_PARAMS = {
    models.RANDOM_FOREST: {"numTrees": 10, "maxDepth": 4, "minInstancesPerNode": 10, "seed": 42},
    models.GRADIENT_BOOSTED: {"maxIter": 3, "maxDepth": 3, "stepSize": 0.05, "seed": 42},
    models.LOGISTIC: {"maxIter": 20, "regParam": 0.01, "elasticNetParam": 0.5},
}


@pytest.fixture(scope="module")
def run(spark):
    return training.train_run(
        retail.transactions(spark, SF_DIR),
        retail.customers(spark, SF_DIR),
        params=QUICK_PARAMS,
        target_rows=BALANCE_ROWS,
    )


@pytest.fixture(scope="module")
def feats(spark):
    tx, customers = retail.transactions(spark, SF_DIR), retail.customers(spark, SF_DIR)
    return stage(features.feature_table(tx, customers), "test_features")


def test_run_trains_every_model(run):
    assert set(run.scorer.models) == set(models.MODEL_PARAMS)
    assert {s for _, s, _ in run.trained.status} == {"trained"}
    assert run.counts["original"] == run.counts["after_capping"]
    assert run.metrics.count() == 3


def test_failing_model_is_reported_and_skipped(spark, feats):
    data = models.standardize(feats).select(
        F.col("features_scaled").alias("features"), F.col("target").alias("label")
    )
    params = {models.LOGISTIC: {"maxIter": 2}, models.GRADIENT_BOOSTED: {"maxIter": 1, "maxBins": 1}}
    trained = models.train_models(data, params, weight_col=None)
    assert list(trained.models) == [models.LOGISTIC]
    status = {r.model: r.status for r in trained.status_frame(spark).collect()}
    assert status == {models.LOGISTIC: "trained", models.GRADIENT_BOOSTED: "failed"}


def test_metrics_agree_with_spark_evaluators(run, feats):
    scored = scoring.with_scores(feats, run.scorer)
    long = stage(scoring.score_all_models(scored, [F.col("target").alias("label")]), "long")
    mine = {r.model: r for r in evaluation.evaluate(long).collect()}
    for name, row in mine.items():
        own = long.filter(F.col("model") == name).withColumn("prediction", F.col("prediction").cast("double"))
        multi = lambda metric: MulticlassClassificationEvaluator(metricName=metric, metricLabel=1.0).evaluate(own)
        assert row.f1_weighted == pytest.approx(multi("f1"), abs=1e-12)
        assert row.precision_fraud == pytest.approx(multi("precisionByLabel"), abs=1e-12)
        assert row.recall_fraud == pytest.approx(multi("recallByLabel"), abs=1e-12)
        assert row.accuracy == pytest.approx(multi("accuracy"), abs=1e-12)
        auc = BinaryClassificationEvaluator(rawPredictionCol="fraud_probability", numBins=0).evaluate(own)
        assert row.auc_roc == pytest.approx(auc, abs=1e-12)


def test_scaler_and_sql_zscore_agree(feats):
    ml = models.standardize(feats).select("transaction_id", vector_to_array("features_scaled").alias("v"))
    sql = models.zscores(feats, FEATURES).select("transaction_id", F.array(*FEATURES).alias("w"))
    gap = F.aggregate(F.zip_with("v", "w", lambda a, b: F.abs(a - b)), F.lit(0.0), lambda s, x: s + x)
    assert ml.join(sql, "transaction_id").agg(F.max(gap)).first()[0] < 1e-9


def test_null_feature_is_an_error(spark, feats):
    broken = feats.limit(5).withColumn("amount", F.lit(None).cast("double"))
    with pytest.raises(Exception, match="null"):
        models.assemble(broken).collect()


def test_saved_artifacts_score_the_same(spark, run, feats):
    root = scratch_path(spark, "artifacts")
    categories = models.merchant_categories(retail.transactions(spark, SF_DIR))
    for _ in range(2):  # the second save replaces the first
        training.save_run(run, root, categories)
    loaded = artifacts.load_artifacts(spark, root)
    info = artifacts.model_info(spark, root).first()
    assert set(loaded.models) == set(run.scorer.models)
    assert type(artifacts.best_model(spark, root)) is type(run.scorer.models[info["best_model_name"]])
    assert loaded.state.lower_bound == run.scorer.state.lower_bound
    assert artifacts.saved_categories(spark, root).count() == 5
    assert (loaded.convention, loaded.apply_cap) == (run.scorer.convention, run.scorer.apply_cap)
    # Raw rows: what they need of the customers' history must have been saved too.
    batch, _ = tables.split_rejects(tables.parse_batch(retail.batch_text(retail.transactions(spark, SF_DIR))))
    keep = ["transaction_id", *FEATURES]
    one = scoring.score_all_models(scoring.score(batch, run.scorer), keep)
    two = scoring.score_all_models(scoring.score(batch, loaded), keep)
    assert one.exceptAll(two).count() == two.exceptAll(one).count() == 0
    assert one.filter("customer_transaction_count <> 10").count() > 0


def test_importances(spark, run):
    table = models.feature_importance(spark, run.trained.models)
    assert {r.model for r in table.collect()} == {models.RANDOM_FOREST, models.GRADIENT_BOOSTED}
    assert table.count() == 16
    top = models.feature_importance(spark, run.trained.models, top=3, positive_only=True)
    assert top.filter("importance <= 0 or importance_rank > 3").count() == 0


def test_importances_with_other_features_get_numbered_names(spark):
    from pyspark.ml.classification import RandomForestClassifier
    from pyspark.ml.linalg import Vectors

    rows = [(float(i % 2), Vectors.dense([0.0, float(i % 2)])) for i in range(20)]
    model = RandomForestClassifier(numTrees=1, featureSubsetStrategy="all", bootstrap=False).fit(
        spark.createDataFrame(rows, ["label", "features"])
    )
    rows = models.feature_importance(spark, {"small": model}).collect()
    assert [(r.importance_rank, r.feature) for r in rows] == [(1, "feature_1"), (2, "feature_0")]


def test_serving_features_fall_back(spark, run):
    batch = spark.createDataFrame(
        [("1", -1, "2024-01-15 14:30:00", 50.0, "grocery"), ("2", -1, "2024-01-15 03:00:00", 9e9, "unheard of")],
        "transaction_id string, customer_id long, transaction_timestamp string, amount double, merchant_category string",
    )
    a, b = scoring.with_serving_features(batch, run.scorer).orderBy("transaction_id").collect()
    assert (a.customer_fraud_rate, a.customer_transaction_count, a.customer_fraud_count) == (0.02, 10, 0)
    assert (a.merchant_fraud_rate, a.merchant_fraud_volatility) == (0.008, 0.01)
    assert b.merchant_fraud_rate == 0.015
    assert (b.amount, b.amount_original) == (run.scorer.state.upper_bound, 9e9)
    uncapped = scoring.with_serving_features(batch, replace(run.scorer, apply_cap=False))
    assert uncapped.agg(F.max("amount")).first()[0] == 9e9


def test_given_features_win(spark, run):
    cases = scoring.with_serving_features(tables.diagnostic_cases(spark), run.scorer)
    rows = {r.case: r for r in cases.collect()}
    assert (rows["suspicious"].customer_fraud_count, rows["normal"].customer_fraud_count) == (2, 0)
    assert rows["suspicious"].customer_transaction_count == 10
    assert rows["suspicious"].hour == 3 and rows["normal"].merchant_fraud_rate == 0.008


def test_diagnostic_cases_per_model(spark, run):
    scored = scoring.score(tables.diagnostic_cases(spark), run.scorer)
    check = scoring.discrimination_check(scored)
    assert {(r.normal_cases, r.suspicious_cases) for r in check.collect()} == {(1, 1)}


def test_large_batches_get_the_same_history(spark, run):
    from sparkvigil.plans.skew import skew_join, snapshot_join

    tx = retail.transactions(spark, SF_DIR)
    small = snapshot_join(tx, run.scorer.profile, ["customer_id"])
    large = skew_join(tx, run.scorer.profile, ["customer_id"], "left", 40, 0)
    assert small.exceptAll(large).count() == large.exceptAll(small).count() == 0
    assert snapshot_join(tx, run.scorer.profile, ["customer_id"], max_rows=10).count() == tx.count()


def test_serving_uses_known_history(spark, run):
    known = run.scorer.profile.orderBy("customer_id").first()
    batch = spark.createDataFrame(
        [("1", known.customer_id, "2024-02-15 14:30:00", 50.0, "travel")],
        "transaction_id string, customer_id long, transaction_timestamp string, amount double, merchant_category string",
    )
    [row] = scoring.with_serving_features(batch, run.scorer).collect()
    assert row.customer_transaction_count == known.customer_transaction_count + 1
    assert row.customer_fraud_count == known.customer_fraud_count


def test_every_batch_row_is_scored_or_rejected(spark, run):
    parsed = tables.parse_batch(retail.batch_text(retail.transactions(spark, SF_DIR)))
    good, rejects = tables.split_rejects(parsed)
    result = scoring.score_batch(good, run.scorer, models.LOGISTIC)
    assert result.count() + rejects.count() == parsed.count()
    assert result.filter("confidence < 0 or confidence > 1 or confidence is null").count() == 0


def test_stages_stay_visible(spark, run, feats):
    out = scoring.with_scores(feats.limit(3), run.scorer, keep_stages=True)
    for name in ("features_raw", "features", "prediction_0", "probability_2"):
        assert name in out.columns
    assert "features_raw" not in scoring.with_scores(feats, run.scorer).columns


def test_one_pass_over_the_input_for_all_models(run, feats):
    plan = scoring.with_scores(feats, run.scorer)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "Exchange" not in plan


def test_agreement_within_the_row(spark):
    df = spark.createDataFrame(
        [(1, [("b", 1, 0.8), ("a", 1, 0.8), ("c", 0, 0.2)]), (2, [("b", 0, 0.1), ("a", 0, 0.3), ("c", 1, 0.5)])],
        "id long, scores array<struct<model string, prediction int, fraud_probability double>>",
    )
    out = scoring.with_vote(scoring.model_agreement(df, ["id"], 3)).orderBy("id").collect()
    assert [(r.models_flagging, r.most_confident_model, r.decision) for r in out] == [
        (2, "a", "block"), (1, "c", "review"),
    ]
    assert out[0].mean_confidence == pytest.approx(0.6)
    assert scoring.one_model(df, 2).orderBy("id").first().fraud_probability == 0.2


def test_scenarios_under_every_model(spark, run):
    assert scoring.scenario_scores(spark, run.scorer).count() == 12


def test_category_pipeline_keeps_unseen(spark):
    seen = spark.createDataFrame([("a",), ("a",), ("b",)], "merchant_category string")
    fitted = models.category_pipeline().fit(seen)
    other = spark.createDataFrame([("zzz",)], "merchant_category string")
    assert fitted.transform(other).first().merchant_category_index == 2.0


def test_training_view(run, feats):
    table = training.processed_table(feats, run.scorer.scaler, "ratio", 30.0)
    assert len(table.columns) == 15
    assert features.training_view(table).columns == ["features", "label", "class_weight"]


def test_native_balancing_run(spark):
    run = training.train_run(
        retail.transactions(spark, SF_DIR),
        params={models.LOGISTIC: {"maxIter": 3}},
        target_rows=200,
        weighting="ratio",
        balance_method="native",
        include_current=False,
    )
    [row] = training.run_summary(run).collect()
    assert row.model_count == 1 and row.best_by_f1 == models.LOGISTIC


def test_stream_equals_batch_in_several_micro_batches(spark, run):
    tx = retail.transactions(spark, SF_DIR).drop("is_fraud")
    source = scratch_path(spark, "arrivals")
    for part in range(3):
        rows = tx.filter(F.col("transaction_id") % 3 == part).coalesce(1)
        rows.write.mode("append").parquet(source)
    stream = spark.readStream.schema(tx.schema).option("maxFilesPerTrigger", 1).parquet(source)
    score = lambda df: scoring.score_batch(df, run.scorer, models.RANDOM_FOREST)
    sink, checkpoint = scratch_path(spark, "sink"), scratch_path(spark, "checkpoint")
    for _ in range(2):  # the second start finds nothing new
        score_stream(stream, score, sink, checkpoint).awaitTermination()
    want = score(tx)
    got = read_scored(spark, sink, want)
    assert got.count() == want.count()
    assert got.exceptAll(want).count() == 0


def test_a_new_checkpoint_keeps_what_was_scored(spark, run):
    tx = retail.transactions(spark, SF_DIR).drop("is_fraud")
    score = lambda df: scoring.score_batch(df, run.scorer, models.LOGISTIC)
    sink, source = scratch_path(spark, "sink"), scratch_path(spark, "arrivals")
    assert read_scored(spark, sink, score(tx)).count() == 0
    for n, name in ((20, "first"), (3, "second")):
        tx.limit(n).repartition(2).write.parquet(f"{source}/{name}")
        stream = spark.readStream.schema(tx.schema).option("maxFilesPerTrigger", 1).parquet(f"{source}/{name}")
        score_stream(stream, score, sink, scratch_path(spark, "checkpoint")).awaitTermination()
    assert read_scored(spark, sink, score(tx)).count() == 23


def test_any_customer_id_is_scored(spark, run):
    rows = [(None, "1", "Travel"), ("C-17", "2", "TRAVEL"), ("N/A", "3", "travel"), ("999999999999999999999", "4", None)]
    batch = spark.createDataFrame(
        [(*r, "2024-02-15 14:30:00", 50.0) for r in rows],
        "customer_id string, transaction_id string, merchant_category string, transaction_timestamp string, amount double",
    )
    found = scoring.with_serving_features(batch, run.scorer).orderBy("transaction_id").collect()
    assert {r.customer_transaction_count for r in found} == {10}
    assert len({r.merchant_fraud_rate for r in found[:3]}) == 1
    assert scoring.score_batch(batch, run.scorer, models.LOGISTIC).count() == 4


def test_mixed_case_categories_share_statistics(spark, make_tx):
    tx = make_tx([(1, i, i, 5.0, name, i % 2) for i, name in enumerate(["Gaming", "gaming", "GAMING", "Travel"])])
    stats = features.merchant_stats(tx)
    assert {r.merchant_category for r in stats.collect()} == {"gaming", "travel"}
    rates = features.with_merchant_stats(tx, stats).filter("lower(merchant_category) = 'gaming'")
    assert rates.select("merchant_fraud_rate").distinct().count() == 1


def test_incomplete_rows_do_not_end_a_run(spark):
    tx = retail.transactions(spark, SF_DIR).withColumns(
        {
            "amount": F.when(F.col("transaction_id") == 5, F.lit(None)).when(F.col("transaction_id") == 6, float("nan")).otherwise(F.col("amount")),
            "transaction_timestamp": F.when(F.col("transaction_id") != 7, F.col("transaction_timestamp")),
        }
    )
    found = training.train_run(tx, params={models.LOGISTIC: {"maxIter": 3}}, target_rows=200)
    assert training.run_summary(found).first().incomplete_rows == 3


def test_split_keeps_test_rows_out_of_the_fit(spark):
    tx = retail.transactions(spark, SF_DIR)
    train, test = sampling.split(tx)
    state = features.fit_preprocessing(train)
    assert state.upper_bound <= train.agg(F.max("amount")).first()[0]
    assert test.count() > 0


def test_a_fit_has_parts_by_its_rows(spark, monkeypatch):
    """A small sample in many pieces is not one task for every piece in every pass of a fit."""
    seen = []

    class Estimator:
        def __init__(self, **settings):
            pass

        def fit(self, train):
            seen.append((train.rdd.getNumPartitions(), train.count()))

    monkeypatch.setitem(models.ESTIMATORS, "counted", Estimator)
    train = spark.range(0, 90, 1, 60).selectExpr("id AS features", "id % 2 AS label")
    models.train_models(train, {"counted": {}}, None)
    monkeypatch.setattr(models, "FIT_PART_ROWS", 30)
    models.train_models(train, {"counted": {}}, None)
    assert seen == [(1, 90), (3, 90)]


def test_scoring_deals_rows_out_evenly(spark, run, make_tx, monkeypatch):
    monkeypatch.setattr(scoring, "SCORE_ROWS", 10)
    rows = make_tx([(1, i, i, 5.0, "gaming", None) for i in range(40)]).coalesce(1).drop("is_fraud")
    assert scoring.score(rows, run.scorer).rdd.getNumPartitions() == 4


def test_side_of_a_row_is_stored_with_it(spark):
    """A stored side is taken as it is; nothing hashes the key again."""
    marked = spark.createDataFrame([(1, "test"), (2, "test"), (3, "train")], "transaction_id int, split string")
    train, test = sampling.split(marked)
    assert [r[0] for r in train.collect()] == [3] and sorted(r[0] for r in test.collect()) == [1, 2]
