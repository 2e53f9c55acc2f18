"""Three fixed scoring rules that stand in for models where an exact answer is wanted."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkvigil.operators.scoring import score_struct


def _points(condition: Column, points: float) -> Column:
    return F.when(condition, points).otherwise(0.0)


def rule_columns() -> dict[str, tuple[Column, Column]]:
    """(prediction, fraud_probability) per rule from amount, hour and merchant category."""
    amount, hour, merchant = F.col("amount"), F.col("hour"), F.col("merchant_category")
    a = F.least(
        F.lit(1.0),
        F.lit(0.15)
        + _points(amount >= 2400, 0.5)
        + _points(hour < 6, 0.3)
        + _points(merchant == "gaming", 0.1),
    )
    b = (
        F.lit(0.1)
        + _points(amount >= 2400, 0.6)
        + _points(merchant.isin("electronics", "travel"), 0.2)
    )
    c = F.lit(0.06) + _points(hour < 6, 0.45) + _points(amount >= 1000, 0.3)
    return {"rule_a": (a >= 0.4, a), "rule_b": (b >= 0.55, b), "rule_c": (c >= 0.5, c)}


def with_rule_scores(df: DataFrame) -> DataFrame:
    """``scores`` with one element per rule."""
    parts = [score_struct(name, p, probability) for name, (p, probability) in rule_columns().items()]
    return df.withColumn("scores", F.array(*parts))


def with_rule_prediction(df: DataFrame, rule: str = "rule_a") -> DataFrame:
    """``prediction`` and ``fraud_probability`` of one rule."""
    prediction, probability = rule_columns()[rule]
    return df.withColumns({"prediction": prediction.cast("int"), "fraud_probability": probability})
