"""Risk rules on top of a prediction and a fraud probability."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from sparkvigil.functions.clock import unusual_hour

# Prior fraud rate per merchant category and the rate of any other category.
MERCHANT_PRIOR = {
    "electronics": 0.03,
    "travel": 0.04,
    "entertainment": 0.025,
    "clothing": 0.02,
    "grocery": 0.008,
    "restaurant": 0.01,
    "home": 0.015,
    "health": 0.012,
    "automotive": 0.02,
    "jewelry": 0.05,
    "other": 0.015,
}
DEFAULT_MERCHANT_RATE = 0.015

# History features of a customer or merchant without history.
DEFAULT_CUSTOMER_RATE = 0.02
DEFAULT_CUSTOMER_COUNT = 10
DEFAULT_CUSTOMER_FRAUDS = 0
DEFAULT_VOLATILITY = 0.01

# Categories, texts and marks of the report.
HIGH_RISK_MERCHANTS = ["electronics", "travel", "jewelry"]
RISK_MARKS = {"CRITICAL": "🔴", "HIGH": "🟠", "MEDIUM": "🟡", "LOW": "🔵", "LEGIT": "✅"}
HIGH_VALUE_AMOUNT = 1000.0
EXCEPTIONAL_AMOUNT = ("💰 Exceptionally high amount (>$5000)", "high")
VERY_HIGH_AMOUNT = ("💰 Very high amount (>$2000)", "high")
HIGH_AMOUNT = ("💰 High amount (>$1000)", "medium")
RISKY_MERCHANT = ("🏪 High-risk merchant category", "high")
UNUSUAL_TIME = ("⏰ Unusual transaction time", "medium")
PREVIOUS_FRAUDS = ("👤 Customer has %d previous frauds", "high")
CONFIDENT_MODEL = ("🤖 High model confidence in fraud", "high")


def merchant_prior(category: Column) -> Column:
    """Prior fraud rate of a category in any letter case."""
    rates = F.create_map(*[F.lit(x) for pair in MERCHANT_PRIOR.items() for x in pair])
    return F.coalesce(F.try_element_at(rates, F.lower(category)), F.lit(DEFAULT_MERCHANT_RATE))


def risk_level(prediction: Column, probability: Column) -> Column:
    return (
        F.when(~F.coalesce(prediction == 1, F.lit(False)), "LEGIT")
        .when(probability >= 0.9, "CRITICAL")
        .when(probability >= 0.7, "HIGH")
        .when(probability >= 0.5, "MEDIUM")
        .otherwise("LOW")
    )


def risk_mark(level: Column) -> Column:
    marks = F.create_map(*[F.lit(x) for pair in RISK_MARKS.items() for x in pair])
    return F.element_at(marks, level)


def probability_band(probability: Column) -> Column:
    return F.when(probability > 0.8, "high").when(probability > 0.5, "medium").otherwise("low")


def verdict(prediction: Column, probability: Column) -> Column:
    return (
        F.when((prediction == 1) & (probability > 0.7), "HIGH RISK")
        .when(prediction == 1, "SUSPICIOUS")
        .otherwise("LEGITIMATE")
    )


def vote_decision(flagging_models: Column) -> Column:
    """block when two or more models flag, review for one, approve for none."""
    return (
        F.when(flagging_models >= 2, "block").when(flagging_models == 1, "review").otherwise("approve")
    )


def quality_band(f1: Column) -> Column:
    return F.when(f1 > 0.7, "good").when(f1 > 0.5, "acceptable").otherwise("needs improvement")


def risk_factors(
    amount: Column,
    merchant: Column,
    hour: Column,
    customer_fraud_count: Column,
    prediction: Column,
    probability: Column,
) -> Column:
    """Array of (factor, level) in the order amount, merchant, hour, history, model."""

    def factor(entry: tuple[str, str], *values: Column) -> Column:
        text, level = entry
        shown = F.format_string(text, *values) if values else F.lit(text)
        return F.struct(shown.alias("factor"), F.lit(level).alias("level"))

    by_amount = (
        F.when(amount > 5000, factor(EXCEPTIONAL_AMOUNT))
        .when(amount > 2000, factor(VERY_HIGH_AMOUNT))
        .when(amount > 1000, factor(HIGH_AMOUNT))
    )
    by_merchant = F.when(F.lower(merchant).isin(*HIGH_RISK_MERCHANTS), factor(RISKY_MERCHANT))
    by_hour = F.when(unusual_hour(hour), factor(UNUSUAL_TIME))
    frauds = customer_fraud_count.cast("long")
    by_history = F.when(frauds > 0, factor(PREVIOUS_FRAUDS, frauds))
    by_model = F.when((prediction == 1) & (probability > 0.7), factor(CONFIDENT_MODEL))
    return F.array_compact(F.array(by_amount, by_merchant, by_hour, by_history, by_model))
