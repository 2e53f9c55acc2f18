"""Every registered query against its SQL counterpart on the smallest tables."""

from __future__ import annotations

import math
import os

import duckdb
import pytest

import __spark_entry__ as entry_point

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
    "labels conversations"
).split()
SQL_TYPES = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}

QUERIES = entry_point.queries()
ORACLES = entry_point.oracle_sql()


@pytest.fixture(scope="module")
def sql():
    connection = duckdb.connect()
    for t in TABLES:
        connection.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_DIR}/{t}.parquet')")
    return connection


def sort_key(row):
    return tuple((v is not None, str(type(v)), v) for v in row)


def plain(value):
    return None if isinstance(value, float) and math.isnan(value) else value


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, sql, name):
    df = QUERIES[name](spark, SF_DIR)
    columns = sorted(df.columns)
    got = sorted((tuple(plain(r[c]) for c in columns) for r in df.collect()), key=sort_key)
    cursor = sql.execute(ORACLES[name])
    described = {d[0]: str(d[1]) for d in cursor.description}
    order = [list(described).index(c) for c in columns]
    want = sorted((tuple(plain(r[i]) for i in order) for r in cursor.fetchall()), key=sort_key)
    assert sorted(described) == columns
    assert {c: SQL_TYPES[t] for c, t in df.dtypes} == described
    assert got == want


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_runs(spark, name):
    assert QUERIES[name](spark, SF_DIR).count() > 0


def test_entry(spark):
    df = entry_point.entry(spark)
    assert df.count() > 0 and "customer_fraud_rate" in df.columns
