"""The retail test tables seen as card transactions and their customers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

EVENT_SCHEMA = T.StructType(
    [
        T.StructField("event_id", T.LongType()),
        T.StructField("ts", T.TimestampNTZType()),
        T.StructField("user_id", T.LongType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("props", T.StringType()),
    ]
)
CUSTOMER_TABLE_SCHEMA = T.StructType(
    [
        T.StructField("c_custkey", T.LongType()),
        T.StructField("c_acctbal", T.DoubleType()),
        T.StructField("c_mktsegment", T.StringType()),
    ]
)

CATEGORY_OF_EVENT = {
    "click": "groceries",
    "view": "fashion",
    "purchase": "electronics",
    "signup": "travel",
}


def as_transactions(events: DataFrame) -> DataFrame:
    """Events as labelled transactions; works on a stream as well."""
    category = F.lit("gaming")
    for event, name in CATEGORY_OF_EVENT.items():
        category = F.when(F.col("event_type") == event, name).otherwise(category)
    amount = F.round(F.col("value") * 20, 2)
    k = F.get_json_object("props", "$.k").try_cast("int")
    fraud = (k >= 99) | ((amount >= 2400) & (F.hour("ts") < 6))
    return events.select(
        F.col("user_id").alias("customer_id"),
        F.col("event_id").alias("transaction_id"),
        F.col("ts").alias("transaction_timestamp"),
        amount.alias("amount"),
        category.alias("merchant_category"),
        F.when(fraud, 1).otherwise(0).alias("is_fraud"),
    )


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_transactions(spark.read.schema(EVENT_SCHEMA).parquet(f"{sf_dir}/events.parquet"))


def event_stream(spark: SparkSession, folder: str, files: int = 1) -> DataFrame:
    """A folder of event files as a stream of at most ``files`` files at a time."""
    return spark.readStream.schema(EVENT_SCHEMA).option("maxFilesPerTrigger", files).parquet(folder)


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = spark.read.schema(CUSTOMER_TABLE_SCHEMA).parquet(f"{sf_dir}/customer.parquet")
    return table.select(F.col("c_custkey").alias("customer_id"), "c_acctbal", "c_mktsegment")


def good_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers in good standing: an inner join with them drops the others' transactions."""
    return customers(spark, sf_dir).filter(F.col("c_acctbal") >= 0)


def batch_text(tx: DataFrame) -> DataFrame:
    """Transactions as the text columns of a batch file, some rows spoilt on purpose."""
    tid = F.col("transaction_id")
    return tx.select(
        F.col("customer_id").cast("string").alias("customer_id"),
        tid.cast("string").alias("transaction_id"),
        F.when(tid % 50 == 7, "not-a-time")
        .otherwise(F.col("transaction_timestamp").cast("string"))
        .alias("transaction_timestamp"),
        F.when(tid % 50 == 11, "n/a").otherwise(F.col("amount").cast("string")).alias("amount"),
        "merchant_category",
    )
