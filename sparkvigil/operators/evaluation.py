"""Metrics of one or many scorers over ``model, label, prediction, fraud_probability`` rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkvigil.functions import rules
from sparkvigil.plans.ordered import running_totals
from sparkvigil.plans.skew import MAX_GROUP_ROWS
from sparkvigil.session import stage

METRICS = ["f1_weighted", "f1_fraud", "precision_fraud", "recall_fraud", "accuracy", "auc_roc"]


def confusion_matrix(scored: DataFrame) -> DataFrame:
    """tn, fp, fn, tp per model, 0 where a cell is empty."""

    def cell(label: int, prediction: int) -> Column:
        return F.count_if((F.col("label") == label) & (F.col("prediction") == prediction))

    return scored.groupBy("model").agg(
        cell(0, 0).alias("tn"), cell(0, 1).alias("fp"), cell(1, 0).alias("fn"), cell(1, 1).alias("tp")
    )


def _ratio(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, part / whole).otherwise(0.0)


def classification_metrics(confusion: DataFrame) -> DataFrame:
    """Accuracy, fraud precision and recall, F1 of the fraud class and F1 weighted over classes."""
    tn, fp, fn, tp = [F.col(c).cast("double") for c in ("tn", "fp", "fn", "tp")]
    # F1 of a class is 2*hits / (2*hits + misses of either kind).
    f1_fraud = _ratio(2 * tp, 2 * tp + fp + fn)
    f1_legit = _ratio(2 * tn, 2 * tn + fp + fn)
    rows = tn + fp + fn + tp
    return confusion.select(
        "model",
        _ratio(f1_fraud * (tp + fn) + f1_legit * (tn + fp), rows).alias("f1_weighted"),
        f1_fraud.alias("f1_fraud"),
        _ratio(tp, tp + fp).alias("precision_fraud"),
        _ratio(tp, tp + fn).alias("recall_fraud"),
        _ratio(tn + tp, rows).alias("accuracy"),
    )


def auc_roc(scored: DataFrame, max_group_rows: int = MAX_GROUP_ROWS) -> DataFrame:
    """Exact area under the ROC curve per model; ties count half, null without both classes.

    Rows are combined per distinct score first. Every fraud row then beats the legitimate rows below
    its score, which is a running total along the score.
    """
    by_score = stage(
        scored.filter(F.col("label").isin(0, 1))
        .groupBy("model", "fraud_probability")
        .agg(
            F.count_if(F.col("label") == 1).alias("frauds"),
            F.count_if(F.col("label") == 0).alias("legits"),
        ),
        "scores",
    )
    ranked = running_totals(
        by_score,
        ["model"],
        [F.col("fraud_probability")],
        {"legits_upto": F.col("legits")},
        max_group_rows=max_group_rows,
    )
    beaten = F.col("frauds") * (F.col("legits_upto") - F.col("legits") / 2)
    return (
        ranked.groupBy("model")
        .agg(
            F.sum(beaten).alias("_beaten"),
            F.sum("frauds").cast("double").alias("_frauds"),
            F.sum("legits").cast("double").alias("_legits"),
        )
        .select(
            "model",
            F.try_divide(F.col("_beaten"), F.col("_frauds") * F.col("_legits")).alias("auc_roc"),
        )
    )


def evaluate(scored: DataFrame) -> DataFrame:
    """One row per model with every metric."""
    return classification_metrics(confusion_matrix(scored)).join(auc_roc(scored), "model")


def with_quality_band(metrics: DataFrame) -> DataFrame:
    return metrics.withColumn("quality", rules.quality_band(F.col("f1_weighted")))


def metrics_long(metrics: DataFrame) -> DataFrame:
    """(model, metric, value)."""
    return metrics.unpivot("model", METRICS, "metric", "value")


def metrics_wide(long: DataFrame) -> DataFrame:
    """One row per model, one column per metric, rounded to 4 digits."""
    return long.groupBy("model").pivot("metric", METRICS).agg(F.bround(F.first("value"), 4))


def best_model(metrics: DataFrame) -> DataFrame:
    """The best names by weighted F1 and by AUC; the first name in order wins a tie."""

    def winner(metric: str) -> Column:
        return F.min_by("model", F.struct(-F.coalesce(F.col(metric), F.lit(-1.0)), F.col("model")))

    return metrics.agg(
        winner("f1_weighted").alias("best_by_f1"),
        F.max("f1_weighted").alias("best_f1"),
        winner("auc_roc").alias("best_by_auc"),
        F.max("auc_roc").alias("best_auc"),
    )
