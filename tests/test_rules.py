from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from sparkvigil.functions import amounts, clock, rules, text
from sparkvigil.operators import analytics, evaluation, reports, scoring


def column_of(spark, values, kind, expression):
    rows = list(enumerate(values))
    df = spark.createDataFrame(rows, f"i int, x {kind}").orderBy("i")
    return [r.out for r in df.select(expression(F.col("x")).alias("out")).collect()]


@pytest.mark.parametrize(
    "value", ["food_and-drink x", "they're 3com", "école d'été", "a  b\tc", "", "HELLO World", "x1y"]
)
def test_title_case_is_pythons(spark, value):
    assert column_of(spark, [value], "string", text.title_case) == [value.title()]


@pytest.mark.parametrize("value", [1234.5, 0.0, 0.005, 2.675, -3.14159, 1e9, 999.995])
def test_money_and_percent_are_pythons(spark, value):
    expected = "$" + f"{value:,.2f}"
    assert column_of(spark, [value], "double", text.money) == [expected]
    assert column_of(spark, [value], "double", text.percent) == [f"{value:.1%}"]


def test_percent_ties_round_half_even(spark):
    assert column_of(spark, [0.0625, 0.0005, 0.1875], "double", text.percent) == [
        f"{v:.1%}" for v in (0.0625, 0.0005, 0.1875)
    ]


def test_amount_ranges(spark):
    values = [0.0, 0.01, 100.0, 100.01, 500.0, 1000.0, 5000.0, 5000.01, None]
    want = [None, "<$100", "<$100", "$100-500", "$100-500", "$500-1000", "$1000-5000", ">$5000", None]
    assert column_of(spark, values, "double", amounts.amount_range) == want


def test_hours(spark):
    values = [5, 6, 22, 23]
    assert column_of(spark, values, "int", clock.unusual_hour) == [True, False, False, True]
    assert column_of(spark, values, "int", clock.late_night) == [True, False, True, True]


def test_day_name_outside_the_week(spark):
    assert column_of(spark, [0, 1, 7, 8, None], "int", clock.day_name) == [
        "Unknown", "Sunday", "Saturday", "Unknown", "Unknown",
    ]


def test_risk_levels(spark):
    df = spark.createDataFrame(
        [(1, 0.9), (1, 0.7), (1, 0.5), (1, 0.49), (0, 0.95), (None, 0.95)], "p int, q double"
    )
    level = rules.risk_level(F.col("p"), F.col("q"))
    rows = df.select(level.alias("l"), rules.risk_mark(level).alias("m")).collect()
    assert [r.l for r in rows] == ["CRITICAL", "HIGH", "MEDIUM", "LOW", "LEGIT", "LEGIT"]
    assert [r.m for r in rows][:2] == ["🔴", "🟠"]


def test_bands_and_verdicts(spark):
    assert column_of(spark, [0.81, 0.8, 0.51, 0.5], "double", rules.probability_band) == [
        "high", "medium", "medium", "low",
    ]
    fraud = lambda q: rules.verdict(F.lit(1), q)
    assert column_of(spark, [0.71, 0.7], "double", fraud) == ["HIGH RISK", "SUSPICIOUS"]
    assert column_of(spark, [0.99], "double", lambda q: rules.verdict(F.lit(0), q)) == ["LEGITIMATE"]
    assert column_of(spark, [3, 2, 1, 0], "int", rules.vote_decision) == [
        "block", "block", "review", "approve",
    ]
    assert column_of(spark, [0.71, 0.7, 0.5], "double", rules.quality_band) == [
        "good", "acceptable", "needs improvement",
    ]


def test_merchant_prior(spark):
    got = column_of(spark, ["Electronics", "JEWELRY", "gaming", None], "string", rules.merchant_prior)
    assert got == [0.03, 0.05, 0.015, 0.015]


def test_risk_factor_amounts(spark):
    none = F.lit(0)

    def levels(x):
        factors = rules.risk_factors(x, F.lit("home"), F.lit(12), none, none, F.lit(0.9))
        return F.transform(factors, lambda f: f["level"])

    got = column_of(spark, [1000.0, 1000.01, 2000.01, 5000.01], "double", levels)
    assert got == [[], ["medium"], ["high"], ["high"]]


def test_all_risk_factors(spark):
    df = spark.createDataFrame(
        [(6000.0, "Travel", 23, 2, 1, 0.71)],
        "amount double, merchant_category string, hour int, customer_fraud_count long, "
        "prediction int, fraud_probability double",
    )
    [row] = scoring.with_risk_factors(df).collect()
    assert [f.level for f in row.risk_factors] == ["high", "high", "medium", "high", "high"]
    assert row.risk_factors[3].factor == "👤 Customer has 2 previous frauds"


def test_risk_level_is_legit_only_without_fraud(spark):
    df = spark.range(200).select(
        (F.col("id") % 2).cast("int").alias("prediction"), (F.col("id") / 200).alias("q")
    )
    level = rules.risk_level(F.col("prediction"), F.col("q"))
    assert df.filter((level == "LEGIT") != (F.col("prediction") != 1)).count() == 0


RESULT = "transaction_id string, customer_id string, amount double, prediction string, confidence double"


def test_empty_batch_has_zero_rates(spark):
    [row] = reports.batch_kpis(spark.createDataFrame([], RESULT)).collect()
    assert (row.total_transactions, row.fraud_rate_pct, row.mean_confidence_pct) == (0, 0.0, 0.0)


def test_repeat_offenders_need_two(spark):
    rows = [("1", "a", 1.0, "FRAUD", 0.9), ("2", "a", 1.0, "FRAUD", 0.9), ("3", "b", 1.0, "FRAUD", 0.9)]
    out = reports.repeat_offenders(spark.createDataFrame(rows, RESULT)).collect()
    assert [(r.customer_id, r.fraud_count) for r in out] == [("a", 2)]


def test_overview_without_fraud(spark):
    df = spark.createDataFrame([(0.0,), (0.0,)], "target double")
    [row] = analytics.fraud_overview(df).collect()
    assert (row.legit_count, row.fraud_count, row.legit_per_fraud) == (2, 0, 0.0)


def test_equal_width_bins_follow_pandas(spark):
    import pandas as pd

    values = [1, 2, 3, 14, 14, 27, 40, 53, 66, 60, 7]
    df = spark.createDataFrame([(v, float(v % 2)) for v in values], "customer_transaction_count long, target double")
    got = {r.bin: (r.row_count, r.fraud_rate) for r in analytics.fraud_by_txn_bin(df).collect()}
    frame = pd.DataFrame({"x": values, "t": [float(v % 2) for v in values]})
    frame["bin"] = pd.cut(frame["x"], bins=10, labels=False) + 1
    want = {b: (len(g), g["t"].mean()) for b, g in frame.groupby("bin")}
    assert got == want


def test_correlation_matches_pandas_with_and_without_gaps(spark):
    import numpy as np
    import pandas as pd

    rng = np.random.default_rng(0)
    frame = pd.DataFrame(rng.normal(size=(200, 3)), columns=["a", "b", "c"])
    frame["b"] += frame["a"] + 1e6
    frame["k"] = 2.5
    for gaps in (False, True):
        if gaps:
            frame.loc[::7, "a"] = np.nan
        rows = [tuple(None if pd.isna(v) else float(v) for v in r) for r in frame.to_numpy()]
        df = spark.createDataFrame(rows, "a double, b double, c double, k double")
        got = {(r.feature_a, r.feature_b): r.correlation for r in analytics.correlation_matrix(df, list("abck")).collect()}
        want = frame.corr()
        for (x, y), value in got.items():
            if "k" in (x, y):
                assert value is None
            else:
                assert value == pytest.approx(want.loc[x, y], abs=1e-9)


def test_correlation_treats_nan_as_missing(spark):
    rows = [(1.0, 2.0), (2.0, 4.0), (float("nan"), 9.0), (3.0, 6.0)]
    df = spark.createDataFrame(rows, "a double, b double")
    got = {(r.feature_a, r.feature_b): r.correlation for r in analytics.correlation_matrix(df, ["a", "b"]).collect()}
    assert got[("a", "b")] == pytest.approx(1.0)


def test_metrics_of_an_all_fraud_scorer(spark):
    rows = [("m", y, 1, 0.9) for y in (0, 0, 1, 1)]
    df = spark.createDataFrame(rows, "model string, label int, prediction int, fraud_probability double")
    [m] = evaluation.evaluate(df).collect()
    assert (m.recall_fraud, m.precision_fraud, m.accuracy, m.auc_roc) == (1.0, 0.5, 0.5, 0.5)
    assert m.f1_weighted == pytest.approx(1 / 3) and m.f1_fraud == pytest.approx(2 / 3)


def test_one_class_has_no_auc(spark):
    df = spark.createDataFrame([("m", 0, 0.1), ("m", 0, 0.2)], "model string, label int, fraud_probability double")
    assert evaluation.auc_roc(df).first().auc_roc is None


def test_auc_in_blocks(spark):
    df = spark.range(300).select(
        F.lit("m").alias("model"),
        (F.xxhash64("id") % 2 == 0).cast("int").alias("label"),
        (F.pmod(F.xxhash64("id", F.lit(1)), F.lit(97)) / 97.0).alias("fraud_probability"),
    )
    plain = evaluation.auc_roc(df).first().auc_roc
    assert evaluation.auc_roc(df, max_group_rows=20).first().auc_roc == pytest.approx(plain, abs=1e-12)


def test_tie_for_best_model_goes_to_the_first_name(spark):
    df = spark.createDataFrame([("b", 0.5, 0.7), ("a", 0.5, 0.6)], "model string, f1_weighted double, auc_roc double")
    [row] = evaluation.best_model(df).collect()
    assert (row.best_by_f1, row.best_by_auc) == ("a", "b")
