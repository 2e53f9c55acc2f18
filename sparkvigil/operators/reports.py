"""Reports over batch results (the eleven columns of ``batch_result``)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkvigil.functions import clock, rules, text
from sparkvigil.sources.schemas import BATCH_RESULT_COLUMNS

# Fixed value: default confidence of an alert.
ALERT_THRESHOLD = 0.8
SUMMARY_COLUMNS = BATCH_RESULT_COLUMNS[:4] + ["prediction", "confidence"]


def is_fraud() -> Column:
    return F.col("prediction") == "FRAUD"


def _alert(threshold: float) -> Column:
    return is_fraud() & (F.col("confidence") >= threshold)


def batch_overview(batch: DataFrame) -> DataFrame:
    """Records, columns and total amount of an uploaded batch."""
    return batch.agg(
        F.count(F.lit(1)).alias("total_records"),
        F.lit(len(batch.columns)).alias("column_count"),
        F.sum(F.col("amount").try_cast("double")).alias("total_amount"),
    )


def batch_kpis(result: DataFrame, threshold: float = ALERT_THRESHOLD) -> DataFrame:
    total = F.count(F.lit(1))
    share = lambda cond: F.coalesce(F.try_divide(F.count_if(cond) * 100.0, total), F.lit(0.0))
    return result.agg(
        total.alias("total_transactions"),
        F.count_if(is_fraud()).alias("fraud_count"),
        share(is_fraud()).alias("fraud_rate_pct"),
        share(_alert(threshold)).alias("high_risk_pct"),
        F.coalesce(F.avg("confidence") * 100.0, F.lit(0.0)).alias("mean_confidence_pct"),
    )


def _rate_by(result: DataFrame, column: str) -> DataFrame:
    """Both counts in one pass; the rate is in percent."""
    total = F.count(F.lit(1))
    return (
        result.filter(F.col(column).isNotNull())
        .groupBy(column)
        .agg(
            total.alias("total"),
            F.count_if(is_fraud()).alias("fraud_count"),
            (F.count_if(is_fraud()) * 100.0 / total).alias("fraud_rate"),
        )
    )


def batch_rate_by_hour(result: DataFrame) -> DataFrame:
    return _rate_by(result, "hour")


def batch_rate_by_merchant(result: DataFrame, k: int = 10) -> DataFrame:
    rates = _rate_by(result, "merchant_category")
    return rates.orderBy(F.col("fraud_rate").desc(), "merchant_category").limit(k)


def fraud_rows(result: DataFrame) -> DataFrame:
    return result.filter(is_fraud())


def risk_level_distribution(result: DataFrame) -> DataFrame:
    return fraud_rows(result).groupBy("risk_level").agg(F.count(F.lit(1)).alias("row_count"))


def high_risk_rows(result: DataFrame, threshold: float = ALERT_THRESHOLD) -> DataFrame:
    return result.filter(_alert(threshold))


def repeat_offenders(result: DataFrame, k: int = 5) -> DataFrame:
    """Customers with more than one flagged transaction, most flagged first."""
    return (
        fraud_rows(result)
        .filter(F.col("customer_id").isNotNull())
        .groupBy("customer_id")
        .agg(F.count(F.lit(1)).alias("fraud_count"))
        .filter(F.col("fraud_count") > 1)
        .orderBy(F.col("fraud_count").desc(), "customer_id")
        .limit(k)
    )


def high_value_frauds(result: DataFrame, above: float = rules.HIGH_VALUE_AMOUNT) -> DataFrame:
    rows = fraud_rows(result).filter(F.col("amount") > above)
    return rows.select("transaction_id", "customer_id", "amount", "merchant_category")


def late_night_frauds(result: DataFrame) -> DataFrame:
    return fraud_rows(result).filter(clock.late_night(F.col("hour")))


def _formatted(result: DataFrame) -> DataFrame:
    return result.withColumns(
        {"amount": text.money(F.col("amount")), "confidence": text.percent(F.col("confidence"))}
    )


def summary_report(result: DataFrame) -> DataFrame:
    return _formatted(result).select(*SUMMARY_COLUMNS)


def full_report(result: DataFrame) -> DataFrame:
    return _formatted(result).select(*BATCH_RESULT_COLUMNS)


def detailed_results(result: DataFrame) -> DataFrame:
    """The full report with marked labels, as shown on screen."""
    marked = text.marked_label(F.col("prediction"))
    return full_report(result).withColumn("prediction", marked)


def high_risk_table(result: DataFrame, threshold: float = ALERT_THRESHOLD) -> DataFrame:
    """The six columns of the alert table."""
    return high_risk_report(result, threshold).select(
        "transaction_id", "customer_id", "amount", "merchant_category", "confidence", "risk_level"
    )


def high_risk_report(result: DataFrame, threshold: float = ALERT_THRESHOLD) -> DataFrame:
    return full_report(high_risk_rows(result, threshold))
