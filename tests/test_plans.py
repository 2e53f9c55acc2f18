from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from sparkvigil.operators import sampling
from sparkvigil.plans import ordered, quantiles
from sparkvigil.plans.ordered import running_totals
from sparkvigil.plans.skew import hot_groups, skew_join


def values_frame(spark, values, groups=None):
    groups = groups or [0.0] * len(values)
    return spark.createDataFrame(list(zip(groups, values)), "g double, v double").repartition(3)


SHAPES = {
    "uniform": lambda r: [r.random() for _ in range(500)],
    "heavy_tail": lambda r: [10 ** r.uniform(-6, 12) for _ in range(500)],
    "few_values": lambda r: [float(r.randrange(3)) for _ in range(500)],
    "hot_value": lambda r: [7.0] * 300 + [r.random() * 100 for _ in range(200)],
    "constant": lambda r: [4.5] * 50,
    "single": lambda r: [1.25],
    "huge": lambda r: [-1.7e308, 1.7e308, 0.0, 5e-324] + [r.uniform(-1e300, 1e300) for _ in range(100)],
    "negative": lambda r: [r.gauss(-5, 3) for _ in range(400)],
}
PROBABILITIES = [0.0, 0.005, 0.25, 0.5, 0.75, 0.995, 1.0]


def test_one_sketch_for_all_ranks_of_a_column(spark, monkeypatch):
    monkeypatch.setattr(quantiles, "LIST_ROWS", 10)
    made, sketch = [], F.percentile_approx
    monkeypatch.setattr(F, "percentile_approx", lambda *a: made.append(a) or sketch(*a))
    data = SHAPES["uniform"](random.Random(2))
    df = values_frame(spark, data).withColumn("w", -F.col("v"))
    got = quantiles.exact_quantiles(df, ["v", "w"], PROBABILITIES, "linear")
    assert len(made) == 2
    assert got[(None, "v")] == pytest.approx(list(np.quantile(data, PROBABILITIES)))
    assert got[(None, "w")] == pytest.approx(list(np.quantile([-x for x in data], PROBABILITIES)))


@pytest.mark.parametrize("shape", SHAPES)
@pytest.mark.parametrize("small", [True, False])
def test_exact_quantiles(spark, monkeypatch, shape, small):
    if small:  # force several refinement passes
        monkeypatch.setattr(quantiles, "LIST_ROWS", 10)
        monkeypatch.setattr(quantiles, "BINS", 4)
    data = SHAPES[shape](random.Random(1))
    df = values_frame(spark, data + [None, float("nan")])
    for method, numpy_method in [("linear", "linear"), ("disc", "inverted_cdf")]:
        got = quantiles.exact_quantiles(df, ["v"], PROBABILITIES, method)[(None, "v")]
        want = np.quantile(data, PROBABILITIES, method=numpy_method)
        np.testing.assert_allclose(got, want, rtol=1e-12)


def test_grouped_quantiles(spark, monkeypatch):
    monkeypatch.setattr(quantiles, "LIST_ROWS", 5)
    r = random.Random(2)
    data = [r.random() for _ in range(300)]
    groups = [float(i % 3 == 0) for i in range(300)]
    got = quantiles.exact_quantiles(values_frame(spark, data, groups), ["v"], [0.25, 0.5], "linear", "g")
    for g in (0.0, 1.0):
        mine = [v for v, k in zip(data, groups) if k == g]
        np.testing.assert_allclose(got[(g, "v")], np.quantile(mine, [0.25, 0.5]))


def test_quantiles_with_infinities(spark, monkeypatch):
    monkeypatch.setattr(quantiles, "LIST_ROWS", 2)
    inf = float("inf")
    data = [-inf] * 5 + [1.0, 2.0, 3.0] + [1.7976931348623157e308, inf, inf]
    got = quantiles.exact_quantiles(values_frame(spark, data), ["v"], [0.0, 0.5, 0.6, 0.8, 1.0])
    assert got[(None, "v")] == [-inf, 1.0, 2.0, 1.7976931348623157e308, inf]


def test_neighbouring_values_end(spark):
    data = [0.0, 5e-324] * 5000
    got = quantiles.exact_quantiles(values_frame(spark, data), ["v"], [0.25, 0.75])
    assert got[(None, "v")] == [0.0, 5e-324]


@pytest.mark.parametrize("limit", [1_000_000, 50])
def test_quantiles_of_many_groups(spark, limit):
    df = spark.range(6000).selectExpr("cast(id % 40 as int) AS g", "cast(id AS double) AS v")
    rows = quantiles.grouped_quantiles(df, "v", [0.0, 0.5, 1.0], "g", limit).collect()
    assert {r.g: list(r["values"]) for r in rows} == {g: [g, g + 2980.0, g + 5960.0] for g in range(40)}


def test_quantiles_of_nothing(spark):
    df = values_frame(spark, [None, None])
    assert quantiles.exact_quantiles(df, ["v"], [0.5])[(None, "v")] == [None]


def test_hot_groups_are_found_only_above_the_limit(spark):
    df = spark.createDataFrame([(1,)] * 10 + [(2,)] * 3 + [(None,)] * 8, "k int")
    assert hot_groups(df, ["k"], 30) is None
    hot = hot_groups(df, ["k"], 5)
    assert {(r.k, r._parts) for r in hot.collect()} == {(1, 2), (None, 2)}


def test_global_running_total_in_blocks(spark):
    df = spark.range(100).withColumn("x", F.col("id") % 7)
    for limit in (8, 1000):
        out = running_totals(df, [], [F.col("id").desc()], {"total": F.col("x")}, lag=3, max_group_rows=limit)
        rows = {r.id: (r.total, r.total_lag) for r in out.collect()}
        totals = {}
        total = 0
        for i in range(99, -1, -1):
            total += i % 7
            totals[i] = total
        assert rows == {i: (totals[i], totals.get(i + 3, 0)) for i in range(100)}


def test_left_skew_join_keeps_null_and_unmatched_keys(spark):
    left = spark.createDataFrame(
        [(1, i) for i in range(9)] + [(None, i) for i in range(9)] + [(3, 0)], "k int, i int"
    )
    right = spark.createDataFrame([(1, "one")], "k int, name string")
    for limit, small in [(4, 0), (4, 100), (1000, 0)]:
        rows = skew_join(left, right, ["k"], "left", limit, small).collect()
        assert sorted(r.name or "" for r in rows) == [""] * 10 + ["one"] * 9


@pytest.mark.parametrize("n", [0, 1, 40, 199, 200, 500])
def test_sample_has_exactly_n_rows(spark, n):
    df = spark.range(200).withColumnRenamed("id", "transaction_id")
    out = sampling.sample_n(df, n)
    assert out.count() == out.distinct().count() == min(n, 200)


def test_sample_of_copies_has_exactly_n_rows(spark):
    df = spark.createDataFrame([(1,)] * 30 + [(2,)] * 30, "transaction_id long")
    assert sampling.sample_n(df, 17).count() == 17


@pytest.fixture(scope="module")
def labelled(spark):
    return spark.range(4000).select(
        F.col("id").alias("transaction_id"), F.when(F.col("id") % 40 == 0, 1.0).otherwise(0.0).alias("target")
    )


@pytest.mark.parametrize("method", ["hash", "native"])
def test_balance_sizes(labelled, method):
    counts = {
        r.label: r.row_count
        for r in sampling.class_counts(sampling.balance(labelled, target=1000, method=method), "target").collect()
    }
    assert abs(counts[0.0] - 1000) < 120 and abs(counts[1.0] - 1000) < 120
    if method == "native":
        assert counts[1.0] <= 1000


def test_balance_leaves_large_enough_classes_alone(labelled):
    kept = sampling.balance(labelled, target=50, method="hash", cap_fraud=False).filter("target = 1")
    assert kept.count() == 100


@pytest.mark.parametrize("method", ["hash", "native"])
def test_fraud_rows_above_the_target_are_sampled_too(labelled, method):
    out = sampling.balance(labelled, target=50, method=method).filter("target = 1")
    assert 20 <= out.count() <= 80 and out.distinct().count() == out.count()


def test_hash_balance_does_not_depend_on_partitioning(labelled):
    one = sampling.balance(labelled, target=300)
    other = sampling.balance(labelled.repartition(5), target=300)
    assert one.exceptAll(other).count() == other.exceptAll(one).count() == 0


@pytest.mark.parametrize("method", ["hash", "native"])
def test_split_is_a_partition(labelled, method):
    train, test = sampling.split(labelled, method=method)
    assert train.count() + test.count() == 4000
    assert train.intersect(test).count() == 0
    assert abs(train.count() - 3200) < 150


def test_copies_stay_on_one_side(labelled):
    copies = labelled.unionByName(labelled)
    train, test = sampling.split(copies)
    assert train.join(test, "transaction_id", "left_semi").count() == 0


def test_no_fraud_is_an_error(labelled):
    none = labelled.filter("target = 0")
    for call in (sampling.balance, sampling.class_weights):
        with pytest.raises(ValueError, match="no fraud"):
            call(none)


def test_weighting_modes(labelled):
    weight = lambda *a, **k: {
        (r.target, r.class_weight)
        for r in sampling.with_class_weight(labelled, *a, **k).select("target", "class_weight").distinct().collect()
    }
    assert weight("none") == {(0.0, 1.0), (1.0, 1.0)}
    assert weight("post_balance") == {(0.0, 1.0), (1.0, 39.0)}
    assert weight("ratio", fraud_weight=5.0) == {(0.0, 1.0), (1.0, 5.0)}
    with pytest.raises(ValueError):
        weight("ratio")


def test_shuffle_keeps_rows(labelled):
    shuffled = sampling.shuffle_rows(labelled)
    assert shuffled.exceptAll(labelled).count() == 0 and shuffled.count() == 4000


def test_small_means_few_rows_and_few_bytes(spark, monkeypatch):
    from sparkvigil.plans import skew

    df = spark.createDataFrame([("x" * 100,)] * 10, "s string")
    assert skew.is_small(df, 10) and not skew.is_small(df, 9)
    monkeypatch.setattr(skew, "BROADCAST_BYTES", 500)
    assert not skew.is_small(df, 10)
    assert skew.is_small(df.limit(0), 0)


def test_partitions_grow_with_the_rows(spark):
    from sparkvigil.plans.skew import MAX_GROUP_ROWS, sized

    df = spark.range(10)
    assert sized(df, ["id"], 10) is df
    big = sized(df, ["id"], 50 * MAX_GROUP_ROWS)
    assert big.rdd.getNumPartitions() == 50


@pytest.mark.parametrize("lag", [None, 3])
def test_small_blocks_share_a_task(spark, monkeypatch, lag):
    """900 blocks of 2 rows are still cut, but in no more ranges than the session has partitions."""
    seen, real = {}, ordered.stage

    def recorded(df, name):
        if name == "blocks":
            seen["ranges"] = df.rdd.getNumPartitions()
        out = real(df, name)
        if name == "blocks":
            seen["largest"] = out.groupBy("k", "_block").count().agg(F.max("count")).first()[0]
        return out

    monkeypatch.setattr(ordered, "stage", recorded)
    df = spark.range(1800).selectExpr("id % 300 AS k", "id", "id % 7 AS x").repartition(3)
    whole = running_totals(df, ["k"], [F.col("id")], {"total": F.col("x")}, lag=lag)
    split = running_totals(df, ["k"], [F.col("id")], {"total": F.col("x")}, lag=lag, max_group_rows=2)
    columns = whole.columns
    assert sorted(split.select(*columns).collect()) == sorted(whole.collect())
    assert seen["ranges"] <= 4 and seen["largest"] <= 2
