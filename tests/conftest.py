from __future__ import annotations

import datetime as dt

import pytest

from sparkvigil.session import build_session


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests", spark__master="local[4]", spark__sql__shuffle__partitions="4"
    )
    session.sparkContext.setLogLevel("ERROR")
    return session


START = dt.datetime(2024, 1, 15, 9, 0, 0)


@pytest.fixture(scope="session")
def make_tx(spark):
    """Rows of (customer, id, minute, amount, category, label) as timed transactions."""
    from sparkvigil.operators.features import with_time_features
    from sparkvigil.sources.schemas import TRANSACTION_SCHEMA

    def build(rows):
        full = [
            (c, i, None if m is None else START + dt.timedelta(minutes=m), a, cat, y)
            for c, i, m, a, cat, y in rows
        ]
        return with_time_features(spark.createDataFrame(full, TRANSACTION_SCHEMA))

    return build
