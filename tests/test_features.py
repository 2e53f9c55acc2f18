from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from sparkvigil.operators import features
from sparkvigil.sources.schemas import TRANSACTION_SCHEMA

HISTORY = ["customer_fraud_rate", "customer_transaction_count", "customer_fraud_count"]


def history(df, **options):
    rows = features.with_customer_history(df, **options).orderBy("transaction_id").collect()
    return [tuple(r[c] for c in HISTORY) for r in rows]


def test_first_row_has_no_history(make_tx):
    assert history(make_tx([(1, 1, 0, 5.0, "a", 1)])) == [(0.0, 1, 1)]


def test_three_rows(make_tx):
    tx = make_tx([(1, i, i, 5.0, "a", y) for i, y in enumerate([1, 0, 1])])
    assert history(tx) == [(0.0, 1, 1), (1.0, 2, 1), (0.5, 3, 2)]
    assert history(tx, include_current=False) == [(0.0, 0, 0), (1.0, 1, 1), (0.5, 2, 1)]


def test_frame_forgets_after_100_rows(make_tx):
    tx = make_tx([(1, i, i, 5.0, "a", int(i == 0)) for i in range(103)])
    rates = [h[0] for h in history(tx)]
    assert rates[100] == 0.01 and rates[101] == 0.0 and rates[102] == 0.0


def test_equal_times_are_ordered_by_id(make_tx):
    rows = [(1, 2, 0, 5.0, "a", 0), (1, 1, 0, 5.0, "a", 1)]
    assert history(make_tx(rows)) == history(make_tx(rows[::-1])) == [(0.0, 1, 1), (1.0, 2, 1)]


def test_null_label_counts_as_row_only(make_tx):
    tx = make_tx([(1, i, i, 5.0, "a", y) for i, y in enumerate([1, None, 0, 1])])
    assert history(tx) == [(0.0, 1, 1), (1.0, 2, 1), (1.0, 3, 1), (0.5, 4, 2)]


@pytest.mark.parametrize("frame", [1, 3, 7, 40])
@pytest.mark.parametrize("limit", [5, 17])
def test_hot_customers_are_split_exactly(make_tx, frame, limit):
    """One customer with a third of the rows, one with exact copies, one null, many ordinary ones."""
    rng = random.Random(frame * 100 + limit)
    rows = []
    for i in range(240):
        c = 1 if i % 3 == 0 else None if i % 7 == 0 else 100 + i % 40
        minute = rng.randrange(60) if rng.random() < 0.9 else None
        rows.append((c, i, minute, 1.0, "a", rng.choice([0, 1, 1, None])))
    rows += [(7, 5000, 30, 1.0, "a", 1)] * 25
    df = make_tx(rows)
    plain = features.with_customer_history(df, frame)
    split = features.with_customer_history(df, frame, max_group_rows=limit)
    assert plain.exceptAll(split).count() == 0
    assert split.exceptAll(plain).count() == 0


def test_history_does_not_depend_on_partitioning(make_tx):
    rng = random.Random(3)
    df = make_tx([(i % 4, i, rng.randrange(99), 1.0, "a", i % 2) for i in range(200)])
    assert history(df) == history(df.repartition(7, F.rand(1)))


def test_profile_is_the_state_after_the_newest_row(make_tx):
    tx = make_tx([(1, i, i, 5.0, "a", y) for i, y in enumerate([1, 1, 0, 0])])
    [row] = features.customer_profile(tx, frame=3).collect()
    assert row["customer_fraud_rate"] == pytest.approx(1 / 3)
    assert (row["customer_transaction_count"], row["customer_fraud_count"]) == (4, 2)


def test_join_drops_orphans_and_repeats_duplicates(spark, make_tx):
    tx = make_tx([(1, 1, 0, 5.0, "a", 0), (2, 2, 0, 5.0, "a", 0), (3, 3, 0, 5.0, "a", 0)])
    customers = spark.createDataFrame([(1,), (2,), (2,)], "customer_id long")
    for limit, small in [(1, 0), (1, 100), (5_000_000, 0)]:  # split, broadcast, plain
        joined = features.join_customers(tx, customers, limit, small)
        assert sorted(r.transaction_id for r in joined.collect()) == [1, 2, 2]


def test_split_join_equals_plain_join(spark, make_tx):
    tx = make_tx([(None if i % 5 == 0 else i % 3, i, i, 1.0, "a", 0) for i in range(60)])
    customers = spark.createDataFrame([(0, "x"), (1, "y"), (1, "z")], "customer_id long, name string")
    plain = features.join_customers(tx, customers)
    split = features.join_customers(tx, customers, max_group_rows=4, broadcast_rows=0)
    assert plain.exceptAll(split).count() == split.exceptAll(plain).count() == 0


def test_merchant_stats_edges(make_tx):
    tx = make_tx(
        [(1, 1, 0, 1.0, "once", 1), (1, 2, 1, 1.0, "twice", 0), (1, 3, 2, 1.0, "twice", 1), (1, 4, 3, 1.0, None, 1)]
    )
    stats = features.merchant_stats(tx)
    for limit in (100, 0):  # broadcast, and the split join
        out = features.with_merchant_stats(tx, stats, max_rows=limit).orderBy("transaction_id").collect()
        assert [r.merchant_fraud_rate for r in out] == [1.0, 0.5, 0.5, 0.0]
        assert out[0].merchant_fraud_volatility == 0.0
        assert out[1].merchant_fraud_volatility == pytest.approx(0.5**0.5)


def test_capping_edges(make_tx):
    tx = make_tx([(1, i, i, a, "a", 0) for i, a in enumerate([9.0, 10.0, 20.0, 21.0, None])])
    out = features.cap_outliers(tx, 10.0, 20.0).orderBy("transaction_id").collect()
    assert [r.amount for r in out] == [10.0, 10.0, 20.0, 20.0, None]
    assert [r.was_outlier for r in out] == [1, 0, 0, 1, 0]
    assert out[0].amount_original == 9.0
    assert features.outlier_count(tx, 10.0, 20.0).first()[0] == 2


def test_null_amount_category(make_tx):
    tx = make_tx([(1, 1, 0, None, "a", 0), (1, 2, 0, 3.0, "a", 0)])
    get = lambda **o: [
        r.amount_category
        for r in features.with_amount_category(tx, [1.0, 2.0, 3.0], **o).orderBy("transaction_id").collect()
    ]
    assert get() == [None, "large"]
    assert get(null_as_last=True) == ["very_large", "large"]


def test_day_conventions(spark):
    df = spark.createDataFrame([("2024-01-14 23:00:00",), ("2024-01-15 06:30:00",), ("soon",)], "t string")
    for convention, want in [("sunday1", [1, 2, None]), ("monday1", [7, 1, None])]:
        out = features.with_time_features(df, "t", convention).collect()
        assert [r.day_of_week for r in out] == want
        assert [r.hour for r in out] == [23, 6, None]


def test_no_amount_at_all_is_an_error(make_tx):
    with pytest.raises(ValueError):
        features.fit_preprocessing(make_tx([(1, 1, 0, None, "a", 0)]))


def test_time_zone_does_not_matter(spark, make_tx):
    text = spark.createDataFrame([("2024-03-10 02:30:00",)], "transaction_timestamp string")
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        for zone in ("UTC", "America/New_York"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            [row] = features.with_time_features(text).collect()
            assert (row.hour, row.day_of_week) == (2, 1)
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_feature_table_over_split_customers(spark, make_tx):
    rng = random.Random(5)
    rows = [(i % 3, i, i, float(rng.randrange(1, 900)), "ab"[i % 2], int(i % 11 == 0)) for i in range(120)]
    tx = make_tx(rows).select(*TRANSACTION_SCHEMA.names)
    customers = spark.createDataFrame([(0,), (1,)], "customer_id long")
    # A deviation may differ in its last bit with the order of summation.
    tidy = {"merchant_fraud_volatility": F.round("merchant_fraud_volatility", 12)}
    plain = features.feature_table(tx, customers).withColumns(tidy)
    split = features.feature_table(tx, customers, max_group_rows=9).withColumns(tidy)
    assert plain.count() == 80
    assert plain.exceptAll(split).count() == split.exceptAll(plain).count() == 0
