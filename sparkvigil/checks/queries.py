"""Every registered query: (spark, folder of the test tables) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkvigil.checks.ml_queries import ML_QUERIES
from sparkvigil.checks.rule_scores import with_rule_prediction, with_rule_scores
from sparkvigil.functions import clock, rules, text
from sparkvigil.operators import (
    analytics,
    evaluation,
    features,
    models,
    reports,
    sampling,
    scoring,
)
from sparkvigil.session import scratch_path, stage
from sparkvigil.sources import retail, tables
from sparkvigil.sources.schemas import FEATURES
from sparkvigil.streaming.scoring import read_scored, score_stream

# Bound on the rows of each class that the registered queries fit their models on.
BALANCE_ROWS = 1_000
SAMPLE_ROWS = 500
# Small enough that the test customers count as hot, so the splitting plans are exercised.
HOT_ROWS = 80

_stored: dict[tuple[str, str, str], object] = {}


def once(name: str, build: Callable[[SparkSession, str], object]):
    """Build a stored table or a trained run once per session and folder, as a user of it would."""

    def get(spark: SparkSession, sf_dir: str):
        key = (spark.sparkContext.applicationId, sf_dir, name)
        if key not in _stored:
            _stored[key] = build(spark, sf_dir)
        return _stored[key]

    return get


def rounded(df: DataFrame, *columns: str, digits: int = 6) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in columns})


# ---- inputs -------------------------------------------------------------------------------------


def timed(spark: SparkSession, d: str) -> DataFrame:
    return features.with_time_features(retail.transactions(spark, d))


def build_features(spark: SparkSession, d: str) -> DataFrame:
    return features.feature_table(retail.transactions(spark, d), retail.customers(spark, d))


feature_store = once("features", lambda s, d: stage(build_features(s, d), "features"))


def rule_scored(spark: SparkSession, d: str) -> DataFrame:
    return with_rule_scores(timed(spark, d))


def scored_long(spark: SparkSession, d: str) -> DataFrame:
    return scoring.score_all_models(
        rule_scored(spark, d), ["transaction_id", F.col("is_fraud").alias("label")]
    )


def batch_upload(spark: SparkSession, d: str) -> DataFrame:
    return retail.batch_text(retail.transactions(spark, d))


def score_rows(raw: DataFrame) -> DataFrame:
    """Batch text to report rows under rule_a."""
    good, _ = tables.split_rejects(tables.parse_batch(raw))
    return scoring.batch_result(with_rule_prediction(features.with_time_features(good)))


def batch_result(spark: SparkSession, d: str) -> DataFrame:
    return score_rows(batch_upload(spark, d))


# ---- sources and sinks --------------------------------------------------------------------------


def join_customers(spark, d):
    return _joined(spark, d)


def join_customers_split(spark, d):
    return _joined(spark, d, max_group_rows=HOT_ROWS, broadcast_rows=0)


def _joined(spark, d, **options):
    joined = features.join_customers(
        retail.transactions(spark, d), retail.good_customers(spark, d), **options
    )
    return joined.select(
        "customer_id", "transaction_id", "amount", "merchant_category", "is_fraud", "c_acctbal", "c_mktsegment"
    )


def csv_transactions(spark, d):
    """Transactions and customers through their CSV files, then joined."""
    tx_path, customer_path = scratch_path(spark, "tx_csv"), scratch_path(spark, "customers_csv")
    tables.write_csv(retail.transactions(spark, d), tx_path)
    tables.write_csv(retail.good_customers(spark, d), customer_path)
    good, _ = tables.split_rejects(tables.read_transactions(spark, tx_path))
    joined = features.join_customers(good, tables.read_customers(spark, customer_path))
    return joined.select(
        "customer_id", "transaction_id", "amount", "merchant_category", "is_fraud",
        clock.timestamp_text(F.col("transaction_timestamp")).alias("transaction_time"),
    )


def csv_batch(spark, d):
    """A batch file written, read back, scored, and its report written and read back."""
    batch_path, report_path = scratch_path(spark, "batch_csv"), scratch_path(spark, "report_csv")
    tables.write_csv(batch_upload(spark, d), batch_path)
    tables.write_csv(
        reports.summary_report(score_rows(tables.read_csv_text(spark, batch_path))), report_path
    )
    report = tables.read_csv_text(spark, report_path)
    return report.filter(F.col(tables.CORRUPT).isNull()).drop(tables.CORRUPT)


def processed_round_trip(spark, d):
    path = scratch_path(spark, "processed")
    tables.write_processed(feature_store(spark, d), path)
    return _round_features(tables.read_processed(spark, path))


def preview(spark, d):
    shown = tables.preview(retail.transactions(spark, d), ["transaction_id"], 50)
    return shown.drop("transaction_timestamp")


def row_count(spark, d):
    return tables.row_count(_joined(spark, d))


def preprocessing_state(spark, d):
    """Fitted constants through their JSON file."""
    base = features.stage_base(retail.transactions(spark, d), retail.customers(spark, d))
    legit, fraud = sampling.two_class_counts(base, "is_fraud")
    path = scratch_path(spark, "config")
    models.preprocessing_state(spark, features.fit_preprocessing(base), legit / fraud).write.json(path)
    config = spark.read.schema(models.CONFIG_SCHEMA).json(path)
    return config.select(
        *[F.col("percentiles")[i].alias(f"q{q}") for i, q in enumerate((25, 50, 75))],
        "lower_bound",
        "upper_bound",
        F.round(F.col("class_weights")["1.0"], 6).alias("fraud_weight"),
        F.size("feature_columns").alias("feature_count"),
        "target_ratio",
    )


def merchant_categories(spark, d):
    path = scratch_path(spark, "categories")
    models.merchant_categories(retail.transactions(spark, d)).write.json(path)
    return spark.read.schema("merchant_category string").json(path)


# ---- features -----------------------------------------------------------------------------------


def time_features(spark, d):
    return timed(spark, d).select(
        "transaction_id",
        "hour",
        "day_of_week",
        clock.timestamp_text(F.col("transaction_datetime")).alias("transaction_time"),
    )


def dow_conventions(spark, d):
    when = F.col("transaction_datetime")
    return timed(spark, d).select(
        "transaction_id",
        clock.day_of_week(when, "sunday1").alias("sunday1"),
        clock.day_of_week(when, "monday1").alias("monday1"),
        clock.day_name(clock.day_of_week(when, "sunday1"), "sunday1").alias("day_name"),
        clock.day_name(clock.day_of_week(when, "monday1"), "monday1").alias("day_name_monday1"),
    )


def amount_quantiles(spark, d):
    return features.amount_quantiles(retail.transactions(spark, d))



def amount_category(spark, d):
    tx = retail.transactions(spark, d)
    percentiles = features.quantiles(tx, "amount", features.QUARTILES)
    return features.with_amount_category(tx, percentiles).select(
        "transaction_id", "amount", "amount_category"
    )


def _history(spark, d, **options):
    out = features.with_customer_history(timed(spark, d), **options)
    return rounded(
        out.select(
            "customer_id",
            "transaction_id",
            "customer_fraud_rate",
            "customer_transaction_count",
            "customer_fraud_count",
        ),
        "customer_fraud_rate",
    )


def customer_history(spark, d):
    return _history(spark, d)


def customer_history_5(spark, d):
    return _history(spark, d, frame=5)


def customer_history_no_leak(spark, d):
    return _history(spark, d, include_current=False)


def customer_history_split(spark, d):
    return _history(spark, d, frame=5, max_group_rows=HOT_ROWS)


def customer_profile(spark, d):
    return rounded(features.customer_profile(timed(spark, d), frame=20), "customer_fraud_rate")


def merchant_stats(spark, d):
    return rounded(
        features.merchant_stats(retail.transactions(spark, d)),
        "merchant_fraud_rate",
        "merchant_fraud_volatility",
    )


def with_merchant_stats(spark, d):
    tx = retail.transactions(spark, d)
    out = features.with_merchant_stats(tx, features.merchant_stats(tx))
    return rounded(
        out.select(
            "transaction_id", "merchant_category", "merchant_fraud_rate", "merchant_fraud_volatility"
        ),
        "merchant_fraud_rate",
        "merchant_fraud_volatility",
    )


def outlier_bounds(spark, d):
    return features.outlier_bounds(retail.transactions(spark, d))


def outlier_count(spark, d):
    tx = retail.transactions(spark, d)
    lower, upper = features.quantiles(tx, "amount", features.CAP_PROBABILITIES)
    return features.outlier_count(tx, lower, upper)


def cap_outliers(spark, d):
    tx = retail.transactions(spark, d)
    lower, upper = features.quantiles(tx, "amount", features.CAP_PROBABILITIES)
    return features.cap_outliers(tx, lower, upper).select(
        "transaction_id", "amount", "amount_original", "was_outlier"
    )


def _round_features(df):
    return rounded(df, "customer_fraud_rate", "merchant_fraud_rate", "merchant_fraud_volatility")


def feature_table(spark, d):
    return _round_features(build_features(spark, d))


def zscore_features(spark, d):
    out = models.zscores(feature_store(spark, d), FEATURES)
    return rounded(out.select("transaction_id", *FEATURES), *FEATURES)


def standardized_features(spark, d):
    from pyspark.ml.functions import vector_to_array

    out = models.standardize(feature_store(spark, d)).select(
        "transaction_id", vector_to_array("features_scaled").alias("v")
    )
    return out.select(
        "transaction_id", *[F.round(F.col("v")[i], 6).alias(f) for i, f in enumerate(FEATURES)]
    )


def category_index(spark, d):
    return models.category_index(retail.transactions(spark, d))


def category_onehot(spark, d):
    out = models.category_onehot(retail.transactions(spark, d))
    return out.select(
        "transaction_id",
        "merchant_category",
        "category_index",
        F.concat_ws(
            ",", F.transform("category_onehot", lambda x: x.cast("int").cast("string"))
        ).alias("onehot"),
    )


def category_encoded_ml(spark, d):
    tx = retail.transactions(spark, d)
    out = models.category_pipeline().fit(tx).transform(tx)
    return out.select("merchant_category", "merchant_category_index").distinct()


# ---- sampling -----------------------------------------------------------------------------------


def class_counts(spark, d):
    return sampling.class_counts(retail.transactions(spark, d))


def label_distribution(spark, d):
    return sampling.label_distribution(retail.transactions(spark, d))


def class_weights(spark, d):
    return rounded(
        sampling.class_weights(retail.transactions(spark, d), "is_fraud"), "class_weight"
    )


def _balanced(spark, d, method):
    tx = retail.transactions(spark, d)
    return sampling.balance(tx, "is_fraud", BALANCE_ROWS, method=method).select(
        "transaction_id", "is_fraud", "amount"
    )


def balance_hash(spark, d):
    return _balanced(spark, d, "hash")



def split_hash(spark, d):
    return sampling.with_split(retail.transactions(spark, d)).select("transaction_id", "split")



def sample_n_hash(spark, d):
    return analytics.sample_for_scatter(feature_store(spark, d), SAMPLE_ROWS)


# ---- exploration --------------------------------------------------------------------------------


def describe_amount(spark, d):
    return rounded(analytics.describe_amount(feature_store(spark, d)), "mean", "stddev")


def describe_rates(spark, d):
    return rounded(
        analytics.describe_rates(feature_store(spark, d)), "mean", "stddev", "min", "max"
    )


def feature_describe(spark, d):
    return analytics.feature_describe(feature_store(spark, d))


def amount_stats(spark, d):
    return rounded(
        analytics.amount_stats(feature_store(spark, d)), "mean_amount", "median_amount"
    )


def amount_category_counts(spark, d):
    return analytics.amount_category_counts(feature_store(spark, d))


def txn_by_hour(spark, d):
    return analytics.txn_by_hour(feature_store(spark, d))


def txn_by_dow(spark, d):
    return analytics.txn_by_dow(feature_store(spark, d))


def fraud_rate_by_hour(spark, d):
    return rounded(analytics.fraud_rate_by_hour(feature_store(spark, d)), "fraud_rate")


def fraud_rate_by_dow(spark, d):
    return rounded(analytics.fraud_rate_by_dow(feature_store(spark, d)), "fraud_rate")


def fraud_overview(spark, d):
    return rounded(
        analytics.fraud_overview(feature_store(spark, d)), "fraud_rate_pct", "legit_per_fraud"
    )


def target_distribution(spark, d):
    return analytics.target_distribution(feature_store(spark, d))


def missing_values(spark, d):
    """Typed batch rows, whose spoilt fields are missing."""
    return analytics.missing_values(tables.parse_batch(batch_upload(spark, d)))


def fraud_by_amount_range(spark, d):
    return rounded(analytics.fraud_by_amount_range(feature_store(spark, d)), "fraud_rate")


def fraud_by_txn_bin(spark, d):
    return rounded(
        analytics.fraud_by_txn_bin(feature_store(spark, d)), "bin_low", "bin_high", "fraud_rate"
    )


def top_merchants(spark, d):
    return analytics.top_merchants(feature_store(spark, d))


def top_risk_merchants(spark, d):
    return rounded(analytics.top_risk_merchants(feature_store(spark, d)), "fraud_rate")


def merchant_risk_profile(spark, d):
    return rounded(
        analytics.merchant_risk_profile(feature_store(spark, d)),
        "merchant_fraud_rate",
        "merchant_fraud_volatility",
        "observed_fraud_rate",
    )


def correlation_matrix(spark, d):
    return rounded(analytics.correlation_matrix(feature_store(spark, d)), "correlation")


def histogram_amount(spark, d):
    return rounded(analytics.histogram(feature_store(spark, d), "amount"), "bin_low", "bin_high")


def histogram_rate(spark, d):
    return rounded(
        analytics.histogram(feature_store(spark, d), "customer_fraud_rate"), "bin_low", "bin_high"
    )


BOX_COLUMNS = ["min", "q25", "median", "q75", "max", "lower_fence", "upper_fence"]


def box_stats_amount(spark, d):
    return rounded(analytics.box_stats(feature_store(spark, d), "amount"), *BOX_COLUMNS)


def box_stats_rate(spark, d):
    return rounded(analytics.box_stats(feature_store(spark, d), "customer_fraud_rate"), *BOX_COLUMNS)


# ---- batch scoring and reports ------------------------------------------------------------------


def score_batch_rule(spark, d):
    return batch_result(spark, d)


def batch_rejects(spark, d):
    _, rejects = tables.split_rejects(tables.parse_batch(batch_upload(spark, d)))
    return rejects.select("transaction_id", "customer_id", "merchant_category", "reject_reason")


def merchant_prior(spark, d):
    return scoring.with_merchant_prior(retail.transactions(spark, d)).select(
        "transaction_id", "merchant_category", "merchant_prior_rate"
    )


def risk_factors(spark, d):
    history = features.with_customer_history(timed(spark, d), include_current=False)
    return scoring.explode_factors(scoring.with_risk_factors(with_rule_prediction(history)))


def _bands(spark, d, name, rule):
    scored = with_rule_prediction(timed(spark, d))
    return scored.select("transaction_id", "prediction", "fraud_probability", rule.alias(name))


def probability_band(spark, d):
    return _bands(spark, d, "band", rules.probability_band(F.col("fraud_probability")))


def verdict(spark, d):
    rule = rules.verdict(F.col("prediction"), F.col("fraud_probability"))
    return _bands(spark, d, "verdict", rule)


def batch_overview(spark, d):
    return rounded(reports.batch_overview(batch_upload(spark, d)), "total_amount", digits=2)


def batch_kpis(spark, d):
    return rounded(
        reports.batch_kpis(batch_result(spark, d)),
        "fraud_rate_pct",
        "high_risk_pct",
        "mean_confidence_pct",
    )


def batch_rate_by_hour(spark, d):
    return rounded(reports.batch_rate_by_hour(batch_result(spark, d)), "fraud_rate")


def batch_rate_by_merchant(spark, d):
    return rounded(reports.batch_rate_by_merchant(batch_result(spark, d)), "fraud_rate")


def risk_level_distribution(spark, d):
    return reports.risk_level_distribution(batch_result(spark, d))


def repeat_offenders(spark, d):
    return reports.repeat_offenders(batch_result(spark, d))


def high_risk_rows(spark, d):
    return reports.high_risk_rows(batch_result(spark, d))


def high_value_frauds(spark, d):
    return reports.high_value_frauds(batch_result(spark, d))


def late_night_frauds(spark, d):
    return reports.late_night_frauds(batch_result(spark, d))


def summary_report(spark, d):
    return reports.summary_report(batch_result(spark, d))


def full_report(spark, d):
    return reports.full_report(batch_result(spark, d))


def high_risk_report(spark, d):
    return reports.high_risk_report(batch_result(spark, d))


def detailed_results(spark, d):
    return reports.detailed_results(batch_result(spark, d))


def high_risk_table(spark, d):
    return reports.high_risk_table(batch_result(spark, d))


# ---- evaluation and model comparison ------------------------------------------------------------


def confusion_matrix(spark, d):
    return evaluation.confusion_matrix(scored_long(spark, d))


def classification_metrics(spark, d):
    metrics = evaluation.classification_metrics(evaluation.confusion_matrix(scored_long(spark, d)))
    return rounded(metrics, *[m for m in evaluation.METRICS if m != "auc_roc"])


def auc_roc(spark, d):
    return rounded(evaluation.auc_roc(scored_long(spark, d)), "auc_roc")


def quality_band(spark, d):
    metrics = evaluation.classification_metrics(evaluation.confusion_matrix(scored_long(spark, d)))
    return evaluation.with_quality_band(metrics).select("model", "quality")


def metrics_long(spark, d):
    return rounded(evaluation.metrics_long(evaluation.evaluate(scored_long(spark, d))), "value")


def metrics_wide(spark, d):
    long = evaluation.metrics_long(evaluation.evaluate(scored_long(spark, d)))
    return evaluation.metrics_wide(long)


def best_model(spark, d):
    best = evaluation.best_model(evaluation.evaluate(scored_long(spark, d)))
    return rounded(best, "best_f1", "best_auc")


def score_all_models(spark, d):
    return scoring.score_all_models(rule_scored(spark, d), ["transaction_id"])


def model_agreement(spark, d):
    agreement = scoring.model_agreement(rule_scored(spark, d), ["transaction_id"], 3)
    return rounded(agreement, "mean_confidence")


def vote_decision(spark, d):
    agreement = scoring.model_agreement(rule_scored(spark, d), ["transaction_id"], 3)
    return scoring.with_vote(agreement).select("transaction_id", "models_flagging", "decision")


def discrimination_check(spark, d):
    """Small daytime purchases as the normal cases, large night-time ones as the suspicious."""
    case = F.when((F.col("amount") <= 100) & F.col("hour").between(8, 20), "normal").when(
        (F.col("amount") >= 2000) & (F.col("hour") < 6), "suspicious"
    )
    cases = rule_scored(spark, d).withColumn("case", case).filter(F.col("case").isNotNull())
    return scoring.discrimination_check(cases)


# ---- machine learning ---------------------------------------------------------------------------


def scaled_features(spark, d):
    feats = feature_store(spark, d)
    scorer = scoring.Scorer({}, models.fit_scaler(models.assemble(feats)), None)
    out = scoring.scaled_features(tables.scenarios_df(spark), scorer, "scenario")
    return rounded(out, "scaled_value")


# ---- streaming ----------------------------------------------------------------------------------


def score_stream_query(spark, d):
    """The events as four files, scored one file at a time, with a second stream into the same sink."""
    sink, source = scratch_path(spark, "stream_sink"), scratch_path(spark, "stream_source")
    events = spark.read.schema(retail.EVENT_SCHEMA).parquet(f"{d}/events.parquet")
    first = F.pmod(F.xxhash64("event_id"), F.lit(2)) == 0
    for name, part in (("one", events.filter(first)), ("two", events.filter(~first))):
        part.repartition(2).write.parquet(f"{source}/{name}")
        raw = retail.batch_text(retail.as_transactions(retail.event_stream(spark, f"{source}/{name}")))
        score_stream(raw, score_rows, sink, scratch_path(spark, "stream_checkpoint")).awaitTermination()
    return read_scored(spark, sink, batch_result(spark, d))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in [
        join_customers,
        join_customers_split,
        csv_transactions,
        csv_batch,
        processed_round_trip,
        preview,
        row_count,
        preprocessing_state,
        merchant_categories,
        time_features,
        dow_conventions,
        amount_quantiles,
        amount_category,
        customer_history,
        customer_history_5,
        customer_history_no_leak,
        customer_history_split,
        customer_profile,
        merchant_stats,
        with_merchant_stats,
        outlier_bounds,
        outlier_count,
        cap_outliers,
        feature_table,
        zscore_features,
        standardized_features,
        category_index,
        category_onehot,
        category_encoded_ml,
        class_counts,
        label_distribution,
        class_weights,
        balance_hash,
        split_hash,
        sample_n_hash,
        describe_amount,
        describe_rates,
        feature_describe,
        amount_stats,
        amount_category_counts,
        txn_by_hour,
        txn_by_dow,
        fraud_rate_by_hour,
        fraud_rate_by_dow,
        fraud_overview,
        target_distribution,
        missing_values,
        fraud_by_amount_range,
        fraud_by_txn_bin,
        top_merchants,
        top_risk_merchants,
        merchant_risk_profile,
        correlation_matrix,
        histogram_amount,
        histogram_rate,
        box_stats_amount,
        box_stats_rate,
        score_batch_rule,
        batch_rejects,
        merchant_prior,
        risk_factors,
        probability_band,
        verdict,
        batch_overview,
        batch_kpis,
        batch_rate_by_hour,
        batch_rate_by_merchant,
        risk_level_distribution,
        repeat_offenders,
        high_risk_rows,
        high_value_frauds,
        late_night_frauds,
        summary_report,
        full_report,
        high_risk_report,
        detailed_results,
        high_risk_table,
        confusion_matrix,
        classification_metrics,
        auc_roc,
        quality_band,
        metrics_long,
        metrics_wide,
        best_model,
        score_all_models,
        model_agreement,
        vote_decision,
        discrimination_check,
        scaled_features,
    ]
}
QUERIES["score_stream"] = score_stream_query
QUERIES |= ML_QUERIES
