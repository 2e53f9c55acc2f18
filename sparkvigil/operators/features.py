"""Feature engineering: time, history, merchant, amount, and the feature table."""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkvigil.functions import amounts, clock
from sparkvigil.plans.ordered import running_totals
from sparkvigil.plans.quantiles import exact_quantiles
from sparkvigil.plans.skew import BROADCAST_ROWS, MAX_GROUP_ROWS, lookup_join, skew_join
from sparkvigil.session import stage
from sparkvigil.sources.schemas import TRANSACTION_SCHEMA

# History frame, amount quartiles, capping quantiles.
HISTORY_ROWS = 100
QUARTILES = [0.25, 0.5, 0.75]
CAP_PROBABILITIES = [0.005, 0.995]


@dataclass
class Preprocessing:
    """What is learnt from a table before its rows can become features."""

    percentiles: list[float]
    lower_bound: float
    upper_bound: float
    merchant_stats: DataFrame = field(repr=False)


def with_time_features(
    df: DataFrame,
    ts: str = "transaction_timestamp",
    convention: str = "sunday1",
    formats: tuple[str, ...] = (),
) -> DataFrame:
    """``transaction_datetime``, ``hour`` 0-23 and ``day_of_week`` 1-7."""
    when = clock.parsed_timestamp(ts, formats)
    df = df.withColumn("transaction_datetime", when)
    return df.withColumns(
        {
            "hour": F.hour("transaction_datetime"),
            "day_of_week": clock.day_of_week(F.col("transaction_datetime"), convention),
        }
    )


def join_customers(
    tx: DataFrame,
    customers: DataFrame,
    max_group_rows: int = MAX_GROUP_ROWS,
    broadcast_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """Transactions of known customers; a customer listed twice yields its transactions twice."""
    return skew_join(tx, customers, ["customer_id"], "inner", max_group_rows, broadcast_rows)


def quantiles(
    df: DataFrame, column: str, probabilities: list[float], rel_err: float = 0.0
) -> list[float]:
    """Quantiles of one column: exact, or within ``rel_err`` ranks by a mergeable sketch."""
    if rel_err > 0:
        return df.approxQuantile(column, probabilities, rel_err)
    return exact_quantiles(df, [column], probabilities)[(None, column)]


def amount_quantiles(df: DataFrame, rel_err: float = 0.0) -> DataFrame:
    """One row with the quartiles of the amount."""
    values = quantiles(df, "amount", QUARTILES, rel_err)
    return df.sparkSession.createDataFrame([tuple(values)], "q25 double, q50 double, q75 double")


def outlier_bounds(
    df: DataFrame, probabilities: list[float] | None = None, rel_err: float = 0.0
) -> DataFrame:
    """One row with the capping bounds of the amount."""
    values = quantiles(df, "amount", probabilities or CAP_PROBABILITIES, rel_err)
    return df.sparkSession.createDataFrame([tuple(values)], "lower_bound double, upper_bound double")


def with_amount_category(
    df: DataFrame, percentiles: list[float], null_as_last: bool = False
) -> DataFrame:
    q25, q50, q75 = [F.lit(p) for p in percentiles]
    category = amounts.amount_category(F.col("amount"), q25, q50, q75, null_as_last)
    return df.withColumn("amount_category", category)


def outlier_count(df: DataFrame, lower: float, upper: float) -> DataFrame:
    outside = amounts.is_outlier(F.col("amount"), F.lit(lower), F.lit(upper))
    return df.agg(F.count_if(outside).alias("outlier_count"))


def cap_outliers(df: DataFrame, lower: float, upper: float) -> DataFrame:
    """``amount`` within the bounds, ``amount_original`` as it was, ``was_outlier`` 0/1."""
    original = F.col("amount_original")
    low, high = F.lit(lower), F.lit(upper)
    return df.withColumn("amount_original", F.col("amount")).withColumns(
        {
            "amount": amounts.capped(original, low, high),
            "was_outlier": F.when(amounts.is_outlier(original, low, high), 1).otherwise(0),
        }
    )


def with_customer_history(
    df: DataFrame,
    frame: int = HISTORY_ROWS,
    include_current: bool = True,
    max_group_rows: int = MAX_GROUP_ROWS,
) -> DataFrame:
    """Fraud rate of the customer's previous ``frame`` rows and running counts.

    ``include_current=False`` ends the running counts one row earlier, so that no row sees its own
    label. Rows are ordered by time and transaction id. All three columns come from two running sums.
    """
    label = F.col("is_fraud").cast("long")
    known = F.when(label.isNotNull(), 1).otherwise(0).cast("long")
    out = running_totals(
        df,
        ["customer_id"],
        [F.col("transaction_datetime"), F.col("transaction_id")],
        {"_rows": F.lit(1).cast("long"), "_frauds": F.coalesce(label, F.lit(0)), "_known": known},
        lag=frame + 1,
        max_group_rows=max_group_rows,
    )
    own = F.coalesce(label, F.lit(0))
    frauds_before = F.col("_frauds") - own
    in_frame = F.col("_known") - known - F.col("_known_lag")
    rate = F.when(in_frame > 0, (frauds_before - F.col("_frauds_lag")) / in_frame).otherwise(0.0)
    return out.withColumns(
        {
            "customer_fraud_rate": rate,
            "customer_transaction_count": F.col("_rows") - (0 if include_current else 1),
            "customer_fraud_count": F.col("_frauds") if include_current else frauds_before,
        }
    ).drop("_rows", "_frauds", "_known", "_rows_lag", "_frauds_lag", "_known_lag")


def customer_profile(
    df: DataFrame, frame: int = HISTORY_ROWS, max_group_rows: int = MAX_GROUP_ROWS
) -> DataFrame:
    """Each customer's state after the newest row: what a following transaction would see."""
    label = F.col("is_fraud").cast("long")
    out = running_totals(
        df.select("customer_id", "transaction_datetime", "transaction_id", "is_fraud"),
        ["customer_id"],
        [F.col("transaction_datetime"), F.col("transaction_id")],
        {
            "_rows": F.lit(1).cast("long"),
            "_frauds": F.coalesce(label, F.lit(0)),
            "_known": F.when(label.isNotNull(), 1).otherwise(0).cast("long"),
        },
        lag=frame,
        max_group_rows=max_group_rows,
    )
    in_frame = F.col("_known") - F.col("_known_lag")
    rate = F.when(in_frame > 0, (F.col("_frauds") - F.col("_frauds_lag")) / in_frame).otherwise(0.0)
    newest = F.max_by(
        F.struct(
            rate.alias("customer_fraud_rate"),
            F.col("_rows").alias("customer_transaction_count"),
            F.col("_frauds").alias("customer_fraud_count"),
        ),
        F.struct("transaction_datetime", "transaction_id"),
    )
    return out.groupBy("customer_id").agg(newest.alias("s")).select("customer_id", "s.*")


def merchant_stats(df: DataFrame) -> DataFrame:
    """Mean and sample deviation of the label per category; 0 where there is only one row.

    Categories are one whatever their letter case; the key is in lower case.
    """
    return (
        df.filter(F.col("merchant_category").isNotNull())
        .groupBy(F.lower("merchant_category").alias("merchant_category"))
        .agg(
            F.avg("is_fraud").alias("merchant_fraud_rate"),
            F.coalesce(F.stddev_samp("is_fraud"), F.lit(0.0)).alias("merchant_fraud_volatility"),
        )
    )


def with_merchant_stats(
    df: DataFrame, stats: DataFrame, max_rows: int = BROADCAST_ROWS, stored: bool = False
) -> DataFrame:
    """Left join to the category statistics; 0 for a null or unknown category."""
    return join_merchant_stats(df, stats, max_rows, stored).fillna(
        0, subset=["merchant_fraud_rate", "merchant_fraud_volatility"]
    )


def join_merchant_stats(
    df: DataFrame, stats: DataFrame, max_rows: int = BROADCAST_ROWS, stored: bool = False
) -> DataFrame:
    """Left join to the category statistics in any letter case."""
    keyed = df.withColumn("_category", F.lower("merchant_category"))
    renamed = stats.withColumnRenamed("merchant_category", "_category")
    return lookup_join(keyed, renamed, ["_category"], max_rows, stored).drop("_category")


def fit_preprocessing(df: DataFrame, rel_err: float = 0.0) -> Preprocessing:
    """Learn quartiles, capping bounds and category statistics from a stored table."""
    values = quantiles(df, "amount", [*QUARTILES, *CAP_PROBABILITIES], rel_err)
    if any(v is None or math.isnan(v) for v in values):
        raise ValueError("no transaction has an amount")
    return Preprocessing(values[:3], values[3], values[4], stage(merchant_stats(df), "merchant_stats"))


def stage_base(
    tx: DataFrame,
    customers: DataFrame | None,
    max_group_rows: int = MAX_GROUP_ROWS,
    mark: Callable[[DataFrame], DataFrame] = lambda df: df,
) -> DataFrame:
    """The columns the features need, of known customers.

    The rows are written once, so that the fit and the feature pass read them instead of joining or
    parsing again; what ``mark`` adds to them is written too.
    """
    tx = tx.select(*TRANSACTION_SCHEMA.names)
    if customers is None:
        return stage(mark(tx), "transactions")
    keys = customers.select("customer_id")
    return stage(mark(join_customers(tx, keys, max_group_rows)), "joined")


def apply_preprocessing(
    df: DataFrame,
    state: Preprocessing,
    frame: int = HISTORY_ROWS,
    include_current: bool = True,
    convention: str = "sunday1",
    max_group_rows: int = MAX_GROUP_ROWS,
) -> DataFrame:
    """Every engineered column, from fitted state."""
    df = with_time_features(df, convention=convention)
    df = with_amount_category(df, state.percentiles)
    df = with_customer_history(df, frame, include_current, max_group_rows)
    df = with_merchant_stats(df, state.merchant_stats, stored=True)
    return cap_outliers(df, state.lower_bound, state.upper_bound)


def feature_table(
    tx: DataFrame,
    customers: DataFrame | None = None,
    state: Preprocessing | None = None,
    frame: int = HISTORY_ROWS,
    include_current: bool = True,
    max_group_rows: int = MAX_GROUP_ROWS,
) -> DataFrame:
    """Transactions to features: join, time, category, history, merchant statistics, cap.

    Without ``state`` it is learnt from the same rows.
    """
    base = stage_base(tx, customers, max_group_rows)
    state = state or fit_preprocessing(base)
    return apply_preprocessing(
        base, state, frame, include_current, max_group_rows=max_group_rows
    ).select(*PROCESSED_COLUMNS, F.col("is_fraud").cast("double").alias("target"))


# Columns of the processed table.
PROCESSED_COLUMNS = [
    "customer_id",
    "transaction_id",
    "amount",
    "merchant_category",
    "hour",
    "day_of_week",
    "amount_category",
    "customer_fraud_rate",
    "merchant_fraud_rate",
    "customer_transaction_count",
    "customer_fraud_count",
    "merchant_fraud_volatility",
]


def training_view(df: DataFrame) -> DataFrame:
    """``features, label, class_weight`` of a processed table."""
    return df.select(
        F.col("features_scaled").alias("features"), F.col("target").alias("label"), "class_weight"
    )
