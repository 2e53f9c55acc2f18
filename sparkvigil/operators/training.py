"""The training job: features, balance, split, fit, evaluate, persist."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkvigil.operators import artifacts, evaluation, features, models, sampling
from sparkvigil.operators.scoring import SCORE_ROWS, Scorer, score_all_models, with_scores
from sparkvigil.plans.skew import MAX_GROUP_ROWS, spread
from sparkvigil.session import stage


@dataclass
class Run:
    """What one training run leaves behind."""

    scorer: Scorer
    trained: models.Trained
    metrics: DataFrame
    fraud_weight: float
    counts: dict
    scored: DataFrame


def complete():
    """Whether a transaction has what training needs; never null."""
    return (
        F.col("transaction_timestamp").isNotNull()
        & F.col("is_fraud").isNotNull()
        & F.coalesce(F.col("amount").isNotNull() & ~F.isnan("amount"), F.lit(False))
    )


def processed_table(
    feats: DataFrame, scaler, weighting: str, fraud_weight: float
) -> DataFrame:
    """The fifteen processed columns: features, scaled vector, target and class weight."""
    scaled = sampling.with_class_weight(
        models.standardize(feats, scaler), weighting, fraud_weight=fraud_weight
    )
    return scaled.select(*features.PROCESSED_COLUMNS, "features_scaled", "target", "class_weight")


def train_run(
    tx: DataFrame,
    customers: DataFrame | None = None,
    params: dict | None = None,
    target_rows: int = sampling.TARGET_ROWS,
    weighting: str = "none",
    balance_method: str = "hash",
    include_current: bool = True,
    rel_err: float = 0.0,
    seed: int = sampling.SEED,
    max_group_rows: int = MAX_GROUP_ROWS,
) -> Run:
    """Train and evaluate every classifier without leaking test rows into the fit.

    Rows are split by key first. Bounds, quartiles, category statistics and the scaler are learnt on
    the training part, which alone is balanced; the test part keeps its natural class mix. Rows
    without a time, an amount or a label cannot be used; they are counted and left out. The side of a
    row is stored with it: the hash of its key is worked out once, not in every pass.
    """
    base = features.stage_base(tx, customers, max_group_rows, lambda df: sampling.with_split(df, seed=seed))
    whole = complete()
    incomplete = base.filter(~whole).count()
    if incomplete:
        base = stage(base.filter(whole), "complete")
    state = features.fit_preprocessing(base.filter(F.col("split") == "train"), rel_err)
    feats = features.apply_preprocessing(
        base, state, include_current=include_current, max_group_rows=max_group_rows
    ).select(*features.PROCESSED_COLUMNS, F.col("is_fraud").cast("double").alias("target"), "split")
    feats = stage(feats, "features")

    train, test = sampling.split(feats)
    legit, fraud = sampling.two_class_counts(train)
    balanced = sampling.balance(train, target=target_rows, seed=seed, method=balance_method)
    scaler = models.fit_scaler(models.assemble(train))
    processed = stage(processed_table(balanced, scaler, weighting, legit / fraud), "processed")
    trained = models.train_models(
        features.training_view(processed), params, None if weighting == "none" else "class_weight"
    )
    profile = stage(
        features.customer_profile(
            features.with_time_features(base), max_group_rows=max_group_rows
        ),
        "profile",
    )
    scorer = Scorer(trained.models, scaler, state, profile)
    test_rows = test.count()
    even = spread(test, test_rows, SCORE_ROWS)
    scored = score_all_models(with_scores(even, scorer), [F.col("target").alias("label")])
    scored = stage(scored, "scored")
    metrics = stage(evaluation.evaluate(scored), "metrics")
    counts = {
        "incomplete": incomplete,
        "original": base.count(),
        "after_capping": feats.count(),
        "after_balancing": processed.count(),
        "test": test_rows,
    }
    return Run(scorer, trained, metrics, legit / fraud, counts, scored)


def run_summary(run: Run) -> DataFrame:
    """One row: sizes, feature and model counts, and the best models."""
    counts = [F.lit(n).cast("long").alias(f"{k}_rows") for k, n in run.counts.items()]
    return evaluation.best_model(run.metrics).select(
        *counts,
        F.lit(len(models.FEATURES)).alias("feature_count"),
        F.lit(len(run.trained.models)).alias("model_count"),
        "best_by_f1",
        "best_f1",
        "best_by_auc",
        "best_auc",
    )


def save_run(run: Run, root: str, categories: DataFrame) -> int:
    """Persist the artefacts of a run as the next version below one root."""
    spark = run.metrics.sparkSession
    best = evaluation.best_model(run.metrics)
    return artifacts.save_artifacts(
        root,
        run.scorer,
        models.preprocessing_state(spark, run.scorer.state, run.fraud_weight),
        models.model_registry(run.metrics, best, run.fraud_weight),
        categories,
        best.first()["best_by_f1"],
    )
