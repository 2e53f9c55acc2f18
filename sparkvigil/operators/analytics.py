"""Exploratory aggregates over a labelled feature table (``target`` 0/1)."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkvigil.functions import amounts, clock, text
from sparkvigil.operators.sampling import sample_n
from sparkvigil.plans.quantiles import exact_quantiles, grouped_quantiles
from sparkvigil.sources.schemas import FEATURES

# Length of the top lists, reach of the box fences in quartile ranges.
TOP = 10
FENCE = 1.5


def _rows() -> Column:
    return F.count(F.lit(1))


def describe_columns(df: DataFrame, columns: list[str]) -> DataFrame:
    """count, mean, stddev, min, max per column, one pass."""
    stats = F.array(
        *[
            F.struct(
                F.lit(c).alias("column_name"),
                F.count(c).alias("n"),
                F.avg(c).alias("mean"),
                F.stddev_samp(c).alias("stddev"),
                F.min(c).cast("double").alias("min"),
                F.max(c).cast("double").alias("max"),
            )
            for c in columns
        ]
    )
    return df.agg(stats.alias("s")).select(F.inline("s"))


def describe_amount(df: DataFrame) -> DataFrame:
    return describe_columns(df, ["amount"])


def describe_rates(df: DataFrame) -> DataFrame:
    return describe_columns(df, ["customer_fraud_rate", "merchant_fraud_rate"])


def feature_describe(df: DataFrame, features: list[str] | None = None) -> DataFrame:
    """describe with interpolated quartiles for the features present, rounded to 4 digits.

    ``df`` should be a stored table: the quartiles take a few passes over it.
    """
    columns = [c for c in (features or FEATURES) if c in df.columns]
    quartiles = exact_quantiles(df, columns, [0.25, 0.5, 0.75], method="linear")
    rows = [(c, *quartiles[(None, c)]) for c in columns]
    lookup = df.sparkSession.createDataFrame(
        rows, "column_name string, q25 double, q50 double, q75 double"
    )
    joined = describe_columns(df, columns).join(F.broadcast(lookup), "column_name")
    rounded = ["mean", "stddev", "min", "q25", "q50", "q75", "max"]
    return joined.select("column_name", "n", *[F.bround(c, 4).alias(c) for c in rounded])


def amount_stats(df: DataFrame) -> DataFrame:
    """Mean, interpolated median, largest and smallest amount."""
    [median] = exact_quantiles(df, ["amount"], [0.5], method="linear")[(None, "amount")]
    return df.agg(
        F.avg("amount").alias("mean_amount"),
        F.lit(median).cast("double").alias("median_amount"),
        F.max("amount").alias("max_amount"),
        F.min("amount").alias("min_amount"),
    )


def counts_by(df: DataFrame, column: str) -> DataFrame:
    """Rows per value; null is not a value."""
    return df.filter(F.col(column).isNotNull()).groupBy(column).agg(_rows().alias("row_count"))


def fraud_rate_by(df: DataFrame, column: str) -> DataFrame:
    """Mean target per value; null is not a value."""
    return df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.avg("target").alias("fraud_rate"))


def amount_category_counts(df: DataFrame) -> DataFrame:
    return counts_by(df, "amount_category")


def txn_by_hour(df: DataFrame) -> DataFrame:
    return counts_by(df, "hour")


def _with_day_name(df: DataFrame, convention: str) -> DataFrame:
    return df.withColumn("day_name", clock.day_name(F.col("day_of_week"), convention))


def txn_by_dow(df: DataFrame, convention: str = "sunday1") -> DataFrame:
    return _with_day_name(counts_by(df, "day_of_week"), convention)


def fraud_rate_by_hour(df: DataFrame) -> DataFrame:
    return fraud_rate_by(df, "hour")


def fraud_rate_by_dow(df: DataFrame, convention: str = "sunday1") -> DataFrame:
    return _with_day_name(fraud_rate_by(df, "day_of_week"), convention)


def fraud_overview(df: DataFrame) -> DataFrame:
    """Rows, fraud and legitimate counts, fraud rate in percent, legitimate rows per fraud row."""
    fraud = F.coalesce(F.sum("target"), F.lit(0.0)).cast("long")
    return (
        df.agg(_rows().alias("total"), fraud.alias("fraud_count"), F.avg("target").alias("_rate"))
        .withColumn("legit_count", F.col("total") - F.col("fraud_count"))
        .select(
            "total",
            "fraud_count",
            "legit_count",
            (F.col("_rate") * 100).alias("fraud_rate_pct"),
            F.coalesce(
                F.try_divide(F.col("legit_count"), F.col("fraud_count")), F.lit(0.0)
            ).alias("legit_per_fraud"),
        )
    )


def target_distribution(df: DataFrame) -> DataFrame:
    return counts_by(df, "target").select(
        text.target_label(F.col("target")).alias("target_label"), "row_count"
    )


def missing_values(df: DataFrame) -> DataFrame:
    """Null or NaN count of every column that has any."""
    doubles = {name for name, kind in df.dtypes if kind in ("double", "float")}

    def missing(c: str) -> Column:
        return F.col(c).isNull() | F.isnan(c) if c in doubles else F.col(c).isNull()

    counts = df.agg(*[F.count_if(missing(c)).alias(c) for c in df.columns])
    return counts.unpivot([], df.columns, "column_name", "missing_count").filter("missing_count > 0")


def fraud_by_amount_range(df: DataFrame) -> DataFrame:
    ranged = df.withColumn("amount_range", amounts.amount_range(F.col("amount")))
    return fraud_rate_by(ranged, "amount_range")


def _with_extremes(df: DataFrame, column: str) -> DataFrame:
    """Every row with the column's minimum and maximum, a one-row broadcast."""
    value = F.col(column).cast("double")
    extremes = df.agg(F.min(value).alias("_low"), F.max(value).alias("_high"))
    return df.select("*", value.alias("_value")).crossJoin(F.broadcast(extremes))


def fraud_by_txn_bin(
    df: DataFrame, column: str = "customer_transaction_count", bins: int = 10
) -> DataFrame:
    """Mean target in equal-width right-closed bins; empty bins are absent.

    The lowest edge is moved down by 0.1 % of the range, so that the minimum lies inside.
    """
    low, high = F.col("_low"), F.col("_high")
    number = amounts.right_closed_bin(F.col("_value"), low, high, bins)
    step = (high - low) / F.lit(bins)
    return (
        _with_extremes(df, column)
        .select("target", "_low", "_high", number.alias("bin"))
        .filter(F.col("bin").isNotNull())
        .groupBy("bin", "_low", "_high")
        .agg(_rows().alias("row_count"), F.avg("target").alias("fraud_rate"))
        .select(
            "bin",
            F.when(F.col("bin") == 1, low - (high - low) * 0.001)
            .otherwise(low + (F.col("bin") - 1) * step)
            .alias("bin_low"),
            F.when(F.col("bin") == bins, high).otherwise(low + F.col("bin") * step).alias("bin_high"),
            "row_count",
            "fraud_rate",
        )
    )


def histogram(df: DataFrame, column: str, bins: int = 50) -> DataFrame:
    """Rows per equal-width bin [low, high); the maximum belongs to the last bin."""
    low, high = F.col("_low"), F.col("_high")
    number = amounts.left_closed_bin(F.col("_value"), low, high, bins)
    step = (high - low) / F.lit(bins)
    return (
        _with_extremes(df, column)
        .select("_low", "_high", number.alias("bin"))
        .filter(F.col("bin").isNotNull())
        .groupBy("bin", "_low", "_high")
        .agg(_rows().alias("row_count"))
        .select(
            "bin",
            (low + F.col("bin") * step).alias("bin_low"),
            (low + (F.col("bin") + 1) * step).alias("bin_high"),
            "row_count",
        )
    )


def box_stats(df: DataFrame, column: str, by: str = "target") -> DataFrame:
    """Minimum, interpolated quartiles, maximum and 1.5 IQR fences per label.

    ``df`` should be a stored table: the quartiles take a few passes over it.
    """
    found = grouped_quantiles(df, column, [0.0, 0.25, 0.5, 0.75, 1.0], by)
    low, q25, median, q75, high = [F.col("values")[i] for i in range(5)]
    reach = F.lit(FENCE) * (q75 - q25)
    return found.select(
        F.col(by).cast("double").alias(by),
        low.alias("min"),
        q25.alias("q25"),
        median.alias("median"),
        q75.alias("q75"),
        high.alias("max"),
        (q25 - reach).alias("lower_fence"),
        (q75 + reach).alias("upper_fence"),
    )


def sample_for_scatter(df: DataFrame, n: int = 5_000, key: str = "transaction_id") -> DataFrame:
    """The points of the transactions-versus-frauds scatter."""
    return sample_n(df, n, key).select(
        key, "customer_transaction_count", "customer_fraud_count", "target"
    )


def top_merchants(df: DataFrame, k: int = TOP) -> DataFrame:
    counts = counts_by(df, "merchant_category")
    return counts.orderBy(F.col("row_count").desc(), "merchant_category").limit(k)


def top_risk_merchants(df: DataFrame, k: int = TOP) -> DataFrame:
    rates = fraud_rate_by(df, "merchant_category")
    return rates.orderBy(F.col("fraud_rate").desc(), "merchant_category").limit(k)


def merchant_risk_profile(df: DataFrame) -> DataFrame:
    """Fitted rate and volatility (constant within a category) beside the observed rate."""
    return (
        df.filter(F.col("merchant_category").isNotNull())
        .groupBy("merchant_category")
        .agg(
            F.max("merchant_fraud_rate").alias("merchant_fraud_rate"),
            F.max("merchant_fraud_volatility").alias("merchant_fraud_volatility"),
            F.avg("target").alias("observed_fraud_rate"),
        )
    )


def correlation_matrix(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Pearson correlation of every pair, null for a constant column.

    Two passes over the columns: means, then sums of products around them. Where values are missing a
    pair only counts the rows that have both.
    """
    names = columns or [*FEATURES, "target"]
    first = df.agg(
        F.count(F.lit(1)).alias("rows"),
        *[F.count(c).alias(f"n_{c}") for c in names],
        *[F.avg(c).alias(f"mean_{c}") for c in names],
        *[(F.min(c) < F.max(c)).alias(f"varies_{c}") for c in names],
    ).first()
    if any(first[f"mean_{c}"] is not None and math.isnan(first[f"mean_{c}"]) for c in names):
        # NaN is a missing value here.
        values = [F.col(c).cast("double") for c in names]
        known = [F.when(~F.isnan(v), v).alias(c) for v, c in zip(values, names)]
        return correlation_matrix(df.select(*known), names)
    varying = [c for c in names if first[f"varies_{c}"]]
    pairs = [(a, b) for i, a in enumerate(varying) for b in varying[i + 1 :]]
    found = {(c, c): 1.0 for c in varying}
    if pairs and all(first[f"n_{c}"] == first["rows"] for c in varying):
        found |= _centred_correlations(df, varying, pairs, first)
    elif pairs:
        row = df.agg(*[F.corr(a, b) for a, b in pairs]).first()
        found |= {p: None if v is None or math.isnan(v) else v for p, v in zip(pairs, row)}
    rows = [(a, b, found.get((a, b), found.get((b, a)))) for a in names for b in names]
    return df.sparkSession.createDataFrame(
        rows, "feature_a string, feature_b string, correlation double"
    )


def _centred_correlations(df, names, pairs, first):
    """Correlation per pair from sums of products of the deviations from the mean."""
    squares = [(c, c) for c in names]
    off = df.select(*[(F.col(c) - F.lit(first[f"mean_{c}"])).alias(c) for c in names])
    sums = off.agg(
        *[F.sum(c).alias(f"sum_{c}") for c in names],
        *[F.sum(F.col(a) * F.col(b)).alias(f"{a}*{b}") for a, b in [*squares, *pairs]],
    ).first()

    def joint(a: str, b: str) -> float:
        return sums[f"{a}*{b}"] - sums[f"sum_{a}"] * sums[f"sum_{b}"] / first["rows"]

    spreads = {c: math.sqrt(max(joint(c, c), 0.0)) for c in names}
    return {
        (a, b): joint(a, b) / (spreads[a] * spreads[b]) if spreads[a] * spreads[b] else None
        for a, b in pairs
    }
