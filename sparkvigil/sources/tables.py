"""CSV, Parquet and literal-row tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkvigil.functions.clock import parsed_timestamp
from sparkvigil.sources.schemas import (
    BATCH_REQUIRED,
    BATCH_SCHEMA,
    CUSTOMER_SCHEMA,
    FEATURES,
    NO_CUSTOMER,
    TRANSACTION_SCHEMA,
    require_columns,
)


# Holds the text of a line that is not a whole record.
CORRUPT = "_corrupt_record"
# What a training row cannot be used without.
TRAINING_REQUIRED = ("transaction_timestamp", "amount", "is_fraud")


def read_csv_text(spark: SparkSession, path: str | list[str], multiline: bool = False) -> DataFrame:
    """Every column as text by its header name, and ``_corrupt_record``; no types are guessed.

    All files must have the same header: one with other or differently ordered columns is an error.
    Quotes inside a quoted field are doubled. A line with too few or too many fields fills
    ``_corrupt_record``. Line breaks inside quotes need ``multiline``, which keeps Spark from
    splitting a file between tasks; without it, such lines are too short and count as corrupt.
    """
    reader = spark.read.option("header", True).option("escape", '"').option("multiLine", multiline)
    names = reader.csv(path).columns
    schema = T.StructType([T.StructField(n, T.StringType()) for n in [*names, CORRUPT]])
    return (
        reader.schema(schema)
        .option("enforceSchema", False)
        .option("columnNameOfCorruptRecord", CORRUPT)
        .csv(path)
    )


def _malformed(df: DataFrame) -> Column:
    """The reject reason of a line that is not a whole record."""
    if CORRUPT not in df.columns:
        return F.lit(None).cast("string")
    return F.when(F.col(CORRUPT).isNotNull(), "malformed_line")


def typed(
    df: DataFrame, schema: T.StructType, formats: tuple[str, ...] = (), required: tuple[str, ...] = ()
) -> DataFrame:
    """Columns of ``schema`` by name with ``reject_reason``, null for a row that parses.

    A line that is not a whole record is one reason; otherwise a field that holds text but cannot be
    read as its type, or a ``required`` one without a value, names the row's reason, the first such
    field in schema order.
    """
    require_columns(df, schema.names)
    values, reasons = [], [_malformed(df)]
    for f in schema.fields:
        raw = F.col(f.name)
        if isinstance(f.dataType, T.TimestampNTZType):
            value = parsed_timestamp(raw, formats)
        elif isinstance(f.dataType, T.StringType):
            value = raw.cast("string")
        else:
            value = raw.try_cast(f.dataType)
        values.append(value.alias(f.name))
        reasons.append(F.when(raw.isNotNull() & value.isNull(), f"bad_{f.name}"))
        if f.name in required:
            reasons.append(F.when(raw.isNull(), f"missing_{f.name}"))
    return df.select(*values, F.coalesce(*reasons).alias("reject_reason"))


def split_rejects(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows that parsed, rows that did not with their ``reject_reason``)."""
    good = df.filter(F.col("reject_reason").isNull()).drop("reject_reason")
    return good, df.filter(F.col("reject_reason").isNotNull())


def read_customers(spark: SparkSession, path: str, multiline: bool = False) -> DataFrame:
    """The customer key; a key that is not a number cannot match and is dropped."""
    return split_rejects(typed(read_csv_text(spark, path, multiline), CUSTOMER_SCHEMA))[0]


def read_transactions(
    spark: SparkSession, path: str, formats: tuple[str, ...] = (), multiline: bool = False
) -> DataFrame:
    """Labelled transactions with ``reject_reason``; see ``split_rejects``."""
    text = read_csv_text(spark, path, multiline)
    return typed(text, TRANSACTION_SCHEMA, formats, TRAINING_REQUIRED)


def parse_batch(raw: DataFrame, formats: tuple[str, ...] = ()) -> DataFrame:
    """Typed batch rows with ``reject_reason``.

    The three required columns must exist and hold a readable time and a number. Without an id
    column the row number in file order is used (unique, consecutive within one file split), without
    a customer column 'N/A'.
    """
    require_columns(raw, BATCH_REQUIRED)
    timestamp = parsed_timestamp("transaction_timestamp", formats)
    amount = F.col("amount").try_cast("double")
    reason = F.coalesce(
        _malformed(raw),
        F.when(timestamp.isNull(), "bad_transaction_timestamp").when(
            amount.isNull() | F.isnan(amount), "bad_amount"
        ),
    ).alias("reject_reason")
    return raw.select(
        _optional(raw, "customer_id", F.lit(NO_CUSTOMER)),
        _optional(raw, "transaction_id", F.monotonically_increasing_id()),
        timestamp.alias("transaction_timestamp"),
        amount.alias("amount"),
        F.col("merchant_category").cast("string").alias("merchant_category"),
        reason,
    )


def _optional(df: DataFrame, name: str, default: Column) -> Column:
    return (F.col(name) if name in df.columns else default).cast("string").alias(name)


def files_with_open_quotes(spark: SparkSession, path: str) -> tuple[list[str], list[str]]:
    """(files in which every line closes its quotes, the others).

    A field that goes on over a line break leaves its first line with an odd number of quotes, doubled
    ones counting twice. The lines are read as text, which splits files of any size.
    """
    lines = spark.read.text(path)
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    found = lines.filter(quotes % 2 == 1).select(F.col("_metadata.file_path").alias("file")).distinct()
    open_files = {r["file"] for r in found.collect()}  # a part of the files, which are listed anyway
    every = sorted(r["file"] for r in lines.select(F.col("_metadata.file_path").alias("file")).distinct().collect())
    return [f for f in every if f not in open_files], sorted(open_files)


def read_batch(
    spark: SparkSession, path: str, formats: tuple[str, ...] = (), multiline: bool | None = None
) -> DataFrame:
    """An uploaded batch of any size.

    Only files with line breaks inside quotes are read whole, by one task each; all others are split.
    The rows are the same as if all files were read whole. ``multiline`` True or False skips the look
    at the lines.
    """
    if multiline is not None:
        return parse_batch(read_csv_text(spark, path, multiline), formats)
    closed, opened = files_with_open_quotes(spark, path)
    if not closed or not opened:
        return parse_batch(read_csv_text(spark, path, bool(opened)), formats)
    names = read_csv_text(spark, path).columns  # the same header everywhere, or an error when rows are read
    parts = [read_csv_text(spark, closed, False), read_csv_text(spark, opened, True)]
    if any(part.columns != names for part in parts):
        raise ValueError("the header of the files is not the same")
    return parse_batch(parts[0].unionByName(parts[1]), formats)


def batch_template(spark: SparkSession) -> DataFrame:
    """The three sample rows of the batch file format."""
    # Fixed values.
    rows = [
        ("1001", "50001", "2024-01-15 14:30:00", 150.0, "electronics"),
        ("1002", "50002", "2024-01-15 22:15:00", 2500.0, "travel"),
        ("1003", "50003", "2024-01-16 09:45:00", 45.5, "grocery"),
    ]
    text = T.StructType(
        [
            T.StructField(f.name, T.StringType())
            if isinstance(f.dataType, T.TimestampNTZType)
            else f
            for f in BATCH_SCHEMA.fields
        ]
    )
    return spark.createDataFrame(rows, text)


def write_csv(df: DataFrame, path: str) -> None:
    """CSV with header; one file per partition, so nothing passes through one task."""
    df.write.mode("overwrite").option("header", True).option("escape", '"').csv(path)


def write_processed(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def read_processed(spark: SparkSession, path: str, limit: int | None = None) -> DataFrame:
    """The processed table, or its first ``limit`` rows."""
    df = spark.read.parquet(path)
    return df if limit is None else df.limit(limit)


def preview(df: DataFrame, order_by: list[str], rows: int = 50) -> DataFrame:
    """The first rows in a stated order (a top-k, not a sort of the table)."""
    return df.orderBy(*order_by).limit(rows)


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("row_count"))


def drop_vectors(df: DataFrame) -> DataFrame:
    """Without the vector columns, which plain file formats and displays cannot hold."""
    from pyspark.ml.linalg import VectorUDT

    return df.drop(*[f.name for f in df.schema.fields if isinstance(f.dataType, VectorUDT)])


def schema_overview(df: DataFrame) -> DataFrame:
    """Position, name and type of every column, and whether it is one of the model features."""
    rows = [(i, name, kind, name in FEATURES) for i, (name, kind) in enumerate(df.dtypes)]
    return df.sparkSession.createDataFrame(
        rows, "position int, column_name string, data_type string, is_feature boolean"
    )


def scenarios_df(spark: SparkSession) -> DataFrame:
    """Four hand-written transactions with complete feature values."""
    # Fixed values, features in model order.
    rows = [
        ("Normal Transaction", "grocery", 50.0, 14, 3, 0.01, 0.01, 100, 0, 0.005),
        ("Slightly Suspicious", "electronics", 500.0, 22, 6, 0.05, 0.03, 10, 1, 0.02),
        ("Highly Suspicious", "jewelry", 5000.0, 3, 7, 0.3, 0.05, 3, 2, 0.04),
        ("Your Test Case", "electronics", 150.0, 14, 4, 0.02, 0.03, 10, 0, 0.01),
    ]
    return spark.createDataFrame(
        rows,
        "scenario string, merchant_category string, amount double, hour int, day_of_week int, "
        "customer_fraud_rate double, merchant_fraud_rate double, customer_transaction_count bigint, "
        "customer_fraud_count bigint, merchant_fraud_volatility double",
    )


def diagnostic_cases(spark: SparkSession) -> DataFrame:
    """One transaction every model should pass and one every model should flag."""
    # Fixed values.
    rows = [("normal", "grocery", 50.0, 14, 4, 0), ("suspicious", "electronics", 5000.0, 3, 4, 2)]
    return spark.createDataFrame(
        rows,
        "case string, merchant_category string, amount double, hour int, day_of_week int, "
        "customer_fraud_count bigint",
    )

