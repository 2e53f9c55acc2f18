from __future__ import annotations

import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from sparkvigil.operators import models
from sparkvigil.session import scratch_path, stage
from sparkvigil.sources import tables
from sparkvigil.sources.schemas import BATCH_SCHEMA, require_columns


def write_text(spark, lines):
    path = scratch_path(spark, "text")
    spark.createDataFrame([("\n".join(lines),)], "line string").coalesce(1).write.text(path)
    return path


def test_template_round_trip(spark):
    path = scratch_path(spark, "template")
    tables.write_csv(tables.batch_template(spark).coalesce(1), path)
    good, rejects = tables.split_rejects(tables.read_batch(spark, path))
    assert good.columns == BATCH_SCHEMA.names and rejects.count() == 0
    rows = good.orderBy("transaction_id").collect()
    assert [r.amount for r in rows] == [150.0, 2500.0, 45.5]
    assert rows[0].transaction_timestamp.hour == 14


def test_bad_rows_are_rejected_with_a_reason(spark):
    path = write_text(
        spark,
        [
            "transaction_timestamp,amount,merchant_category",
            "2024-01-15 14:30:00,10.5,travel",
            "yesterday,10.5,travel",
            "2024-01-15 14:30:00,ten,travel",
            "2024-01-15 14:30:00,,travel",
        ],
    )
    batch = tables.read_batch(spark, path)
    good, rejects = tables.split_rejects(batch)
    assert good.count() == 1
    assert sorted(r.reject_reason for r in rejects.collect()) == [
        "bad_amount", "bad_amount", "bad_transaction_timestamp",
    ]
    first = good.first()
    assert (first.customer_id, first.transaction_id) == ("N/A", "0")
    assert batch.count() == good.count() + rejects.count()


def test_other_time_formats(spark):
    raw = spark.createDataFrame([("01/15/2024 08:00", "1", "a")], "transaction_timestamp string, amount string, merchant_category string")
    assert tables.parse_batch(raw).first().reject_reason == "bad_transaction_timestamp"
    assert tables.parse_batch(raw, ("MM/dd/yyyy HH:mm",)).first().transaction_timestamp.hour == 8


def test_missing_columns_are_all_named(spark):
    df = spark.createDataFrame([(1.0,)], "amount double")
    with pytest.raises(ValueError, match="merchant_category, transaction_timestamp"):
        tables.parse_batch(df)
    assert require_columns(df, ["amount"]) is df


def test_transactions_by_header_name(spark):
    path = write_text(
        spark,
        [
            "is_fraud,extra,amount,transaction_id,customer_id,merchant_category,transaction_timestamp",
            "1,x,9.5,7,3,travel,2024-01-15 14:30:00",
            "no,x,9.5,8,3,travel,2024-01-15 14:30:00",
        ],
    )
    good, rejects = tables.split_rejects(tables.read_transactions(spark, path))
    row = good.first()
    assert (row.customer_id, row.transaction_id, row.amount, row.is_fraud) == (3, 7, 9.5, 1)
    assert [r.reject_reason for r in rejects.collect()] == ["bad_is_fraud"]


def test_customers_keep_only_the_key(spark):
    path = write_text(spark, ["name,customer_id", "ann,5", "bob,x"])
    assert [tuple(r) for r in tables.read_customers(spark, path).collect()] == [(5,)]


def test_processed_table_with_vectors(spark):
    df = spark.createDataFrame([(i, Vectors.dense([i, 1.0])) for i in range(5)], ["id", "features"])
    path = scratch_path(spark, "processed")
    tables.write_processed(df, path)
    tables.write_processed(df, path)
    assert tables.read_processed(spark, path).count() == 5
    assert tables.read_processed(spark, path, limit=2).count() == 2
    assert tables.drop_vectors(tables.read_processed(spark, path)).columns == ["id"]


def test_preview_and_count(spark):
    df = spark.range(100)
    assert [r.id for r in tables.preview(df, ["id"], 3).collect()] == [0, 1, 2]
    assert tables.row_count(df).first().row_count == 100


def test_schema_overview(spark):
    df = spark.createDataFrame([(1.0, "x")], "amount double, note string")
    rows = [tuple(r) for r in tables.schema_overview(df).orderBy("position").collect()]
    assert rows == [(0, "amount", "double", True), (1, "note", "string", False)]


def test_categories_round_trip(spark):
    df = spark.createDataFrame([("a",), ("b",), ("a",)], "merchant_category string")
    path = scratch_path(spark, "categories")
    models.merchant_categories(df).write.json(path)
    assert {r[0] for r in spark.read.json(path).collect()} == {"a", "b"}


def test_staged_table_keeps_rows_and_schema(spark):
    df = spark.range(10).withColumn("t", F.lit("2024-01-01").cast("timestamp_ntz"))
    kept = stage(df, "kept")
    assert kept.dtypes == df.dtypes and kept.exceptAll(df).count() == 0


def test_scenarios(spark):
    assert tables.scenarios_df(spark).count() == 4


def text_files(spark, files):
    root = scratch_path(spark, "lines")
    for i, lines in enumerate(files):
        spark.createDataFrame([(line,) for line in lines], "v string").coalesce(1).write.text(f"{root}/part={i}")
    return f"{root}/part=*"


def test_headers_must_agree(spark):
    path = text_files(spark, [["amount,merchant_category", "1,a"], ["merchant_category,amount", "b,2"]])
    with pytest.raises(Exception, match="header"):
        tables.read_csv_text(spark, path).collect()


def test_quotes_line_breaks_and_ragged_lines(spark):
    head = "transaction_timestamp,amount,merchant_category"
    lines = [head, '2024-01-01 00:00:00,1,"home ""and"" garden"', '2024-01-01 00:00:00,2,"a', 'b"', "2024-01-01 00:00:00,3", "2024-01-01 00:00:00,4,c,d"]
    rows = tables.read_batch(spark, text_files(spark, [lines])).orderBy("amount").collect()
    assert [(r.amount, r.merchant_category, r.reject_reason) for r in rows] == [
        (1.0, 'home "and" garden', None), (2.0, "a\nb", None),
        (3.0, None, "malformed_line"), (4.0, "c", "malformed_line"),
    ]


def test_training_rows_need_their_values(spark):
    head = "customer_id,transaction_id,transaction_timestamp,amount,merchant_category,is_fraud"
    rows = tables.read_transactions(spark, text_files(spark, [[head, "1,1,,5,a,0", "1,2,2024-01-01 00:00:00,5,a,", "1,3,2024-01-01 00:00:00,5,a,1"]]))
    assert {r.transaction_id: r.reject_reason for r in rows.collect()} == {
        1: "missing_transaction_timestamp", 2: "missing_is_fraud", 3: None,
    }
