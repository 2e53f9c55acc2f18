"""Declared schemas; nothing is inferred."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

CUSTOMER_SCHEMA = T.StructType([T.StructField("customer_id", T.LongType())])

TRANSACTION_SCHEMA = T.StructType(
    [
        T.StructField("customer_id", T.LongType()),
        T.StructField("transaction_id", T.LongType()),
        T.StructField("transaction_timestamp", T.TimestampNTZType()),
        T.StructField("amount", T.DoubleType()),
        T.StructField("merchant_category", T.StringType()),
        T.StructField("is_fraud", T.IntegerType()),
    ]
)

# Column order of the batch file, which carries no label.
BATCH_SCHEMA = T.StructType(
    [
        T.StructField("customer_id", T.StringType()),
        T.StructField("transaction_id", T.StringType()),
        T.StructField("transaction_timestamp", T.TimestampNTZType()),
        T.StructField("amount", T.DoubleType()),
        T.StructField("merchant_category", T.StringType()),
    ]
)
BATCH_REQUIRED = ["amount", "merchant_category", "transaction_timestamp"]
NO_CUSTOMER = "N/A"

# Position i of the feature vector is FEATURES[i].
FEATURES = [
    "amount",
    "hour",
    "day_of_week",
    "customer_fraud_rate",
    "merchant_fraud_rate",
    "customer_transaction_count",
    "customer_fraud_count",
    "merchant_fraud_volatility",
]

# Columns of the batch result.
BATCH_RESULT_COLUMNS = [
    "transaction_id",
    "customer_id",
    "amount",
    "merchant_category",
    "transaction_time",
    "hour",
    "day_of_week",
    "prediction",
    "confidence",
    "risk_level",
    "risk_emoji",
]


def require_columns(df: DataFrame, needed: list[str]) -> DataFrame:
    """``df`` itself, or an error that lists every missing column."""
    missing = [c for c in needed if c not in df.columns]
    if missing:
        raise ValueError(f"missing required columns: {', '.join(missing)}")
    return df
