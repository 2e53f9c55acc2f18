"""Scoring whole tables with one or many models in one plan."""

from __future__ import annotations

from dataclasses import dataclass, field, replace
from functools import reduce

from pyspark.ml.feature import StandardScalerModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkvigil.functions import amounts, clock, rules, text
from sparkvigil.operators.features import (
    Preprocessing,
    join_merchant_stats,
    with_time_features,
)
from sparkvigil.operators.models import assemble
from sparkvigil.plans.ordered import running_totals
from sparkvigil.plans.skew import MAX_GROUP_ROWS, snapshot_join, spread
from sparkvigil.session import stage
from sparkvigil.sources.schemas import BATCH_RESULT_COLUMNS, FEATURES
from sparkvigil.sources.tables import scenarios_df


LOOKED_UP = FEATURES[3:]
# Rows that one task scores: some hundred trees are walked for every row.
SCORE_ROWS = 50_000


@dataclass
class Scorer:
    """Fitted models with what their features need."""

    models: dict
    scaler: StandardScalerModel
    state: Preprocessing
    profile: DataFrame | None = field(default=None, repr=False)
    convention: str = "sunday1"
    apply_cap: bool = True


def with_merchant_prior(df: DataFrame) -> DataFrame:
    """``merchant_prior_rate`` from the fixed table, in any letter case."""
    return df.withColumn("merchant_prior_rate", rules.merchant_prior(F.col("merchant_category")))


def with_place(df: DataFrame, key: str, max_group_rows: int = MAX_GROUP_ROWS) -> DataFrame:
    """``_nth``: the row's number among the rows of its key by time and id, from 1; 1 without a key.

    Keys of very many rows are cut into blocks, as in every running total.
    """
    order = [F.col(c) for c in ("transaction_datetime", "transaction_id") if c in df.columns]
    one = F.lit(1).cast("long")
    placed = running_totals(
        df.filter(F.col(key).isNotNull()), [key], order, {"_nth": one}, max_group_rows=max_group_rows
    )
    return placed.unionByName(df.filter(F.col(key).isNull()).withColumn("_nth", one))


def with_serving_features(
    df: DataFrame, scorer: Scorer, max_group_rows: int = MAX_GROUP_ROWS, advance: bool = False
) -> DataFrame:
    """The eight features of unlabelled transactions.

    A feature the rows already carry wins. Otherwise history comes from the customer snapshot and
    category statistics from the fitted table; without history there, the fixed defaults apply. Each
    transaction counts as the next row of its customer; with ``advance`` the n-th one of a customer in
    the batch, by time, counts as the n-th row after the snapshot, as it does in training. That is for
    batches which are whole: the rows of a stream bring their own history (``history_stream``). An id
    that is not of the snapshot's type (text, missing) has no history there; categories match in any case.
    """
    if not {"hour", "day_of_week"} <= set(df.columns):
        df = with_time_features(df, convention=scorer.convention)
    df = df.withColumnsRenamed({c: f"_given_{c}" for c in LOOKED_UP if c in df.columns})
    place = F.lit(1)
    if scorer.profile is not None and "customer_id" in df.columns:
        kind = scorer.profile.schema["customer_id"].dataType
        keyed = df.withColumn("_customer", F.col("customer_id").try_cast(kind))
        if advance:
            # The join counts its rows before it reads them: the places are worked out once.
            keyed, place = stage(with_place(keyed, "_customer", max_group_rows), "placed"), F.col("_nth")
        profile = scorer.profile.withColumnRenamed("customer_id", "_customer")
        df = snapshot_join(keyed, profile, ["_customer"], max_group_rows).drop("_customer")
    df = join_merchant_stats(df, scorer.state.merchant_stats, stored=True)

    def looked_up(name: str, found: Column | None, default: Column) -> Column:
        choices = [F.col(f"_given_{name}")] if f"_given_{name}" in df.columns else []
        if name in df.columns:
            choices.append(F.col(name) if found is None else found)
        return F.coalesce(*choices, default)

    values = {
        "customer_fraud_rate": (None, F.lit(rules.DEFAULT_CUSTOMER_RATE)),
        "customer_transaction_count": (
            F.col("customer_transaction_count") + place,
            F.lit(rules.DEFAULT_CUSTOMER_COUNT),
        ),
        "customer_fraud_count": (None, F.lit(rules.DEFAULT_CUSTOMER_FRAUDS)),
        "merchant_fraud_rate": (None, rules.merchant_prior(F.col("merchant_category"))),
        "merchant_fraud_volatility": (None, F.lit(rules.DEFAULT_VOLATILITY)),
    }
    df = df.withColumns({name: looked_up(name, *choice) for name, choice in values.items()})
    df = df.drop("_nth", *[f"_given_{c}" for c in LOOKED_UP]).withColumn("amount_original", F.col("amount"))
    if scorer.apply_cap:
        low, high = F.lit(scorer.state.lower_bound), F.lit(scorer.state.upper_bound)
        df = df.withColumn("amount", amounts.capped(F.col("amount"), low, high))
    return df


def with_scores(df: DataFrame, scorer: Scorer, keep_stages: bool = False) -> DataFrame:
    """``scores``, an array of (model, prediction, fraud_probability), one element per model.

    All models read the same row, so a table is scanned once whatever the number of models. With
    ``keep_stages`` the assembled and scaled vectors and each model's own columns stay visible.
    """
    out = scorer.scaler.transform(assemble(df)).withColumnRenamed("features_scaled", "features")
    parts, stages = [], ["features_raw", "features"]
    for i, (name, model) in enumerate(scorer.models.items()):
        own = model.copy()
        own.setFeaturesCol("features")
        own.setPredictionCol(f"prediction_{i}")
        own.setProbabilityCol(f"probability_{i}")
        own.setRawPredictionCol(f"raw_prediction_{i}")
        out = own.transform(out)
        stages += [f"raw_prediction_{i}", f"probability_{i}", f"prediction_{i}"]
        parts.append(
            score_struct(
                name,
                F.col(f"prediction_{i}"),
                vector_to_array(F.col(f"probability_{i}"))[1],
            )
        )
    out = out.withColumn("scores", F.array(*parts))
    return out if keep_stages else out.drop(*stages)


def score_struct(name: str, prediction: Column, probability: Column) -> Column:
    return F.struct(
        F.lit(name).alias("model"),
        prediction.cast("int").alias("prediction"),
        probability.cast("double").alias("fraud_probability"),
    )


def score_all_models(scored: DataFrame, keep: list[str]) -> DataFrame:
    """``scores`` as rows: the kept columns with model, prediction and fraud_probability.

    The outer form keeps Catalyst from working the array out twice to test that it is not empty.
    """
    return scored.select(*keep, F.inline_outer("scores"))


def one_model(scored: DataFrame, position: int = 0) -> DataFrame:
    """``prediction`` and ``fraud_probability`` of the model at one position of ``scores``."""
    own = F.col("scores")[position]
    return scored.withColumns(
        {"prediction": own["prediction"], "fraud_probability": own["fraud_probability"]}
    )


def model_agreement(scored: DataFrame, keep: list[str], models: int) -> DataFrame:
    """How many of the models flag a transaction, their mean confidence, the most confident one.

    Worked out within the row; the first model name in order wins a tie.
    """
    scores = [F.col("scores")[i] for i in range(models)]
    add = lambda columns: reduce(lambda a, b: a + b, columns)
    order = [F.struct((-s["fraud_probability"]).alias("p"), s["model"].alias("model")) for s in scores]
    leader = F.least(*order) if models > 1 else order[0]
    return scored.select(
        *keep,
        add([F.when(s["prediction"] == 1, 1).otherwise(0) for s in scores]).alias("models_flagging"),
        F.lit(models).alias("models_total"),
        (add([s["fraud_probability"] for s in scores]) / F.lit(models)).alias("mean_confidence"),
        leader["model"].alias("most_confident_model"),
    )


def with_vote(agreement: DataFrame) -> DataFrame:
    return agreement.withColumn("decision", rules.vote_decision(F.col("models_flagging")))


def discrimination_check(scored: DataFrame, case: str = "case") -> DataFrame:
    """Per model: are all 'normal' cases passed and all 'suspicious' cases flagged?"""
    long = score_all_models(scored, [case])
    normal, suspicious = F.col(case) == "normal", F.col(case) == "suspicious"
    flagged = F.col("prediction") == 1
    per_model = long.groupBy("model").agg(
        F.count_if(normal).alias("normal_cases"),
        F.count_if(normal & flagged).alias("normal_flagged"),
        F.count_if(suspicious).alias("suspicious_cases"),
        F.count_if(suspicious & flagged).alias("suspicious_flagged"),
    )
    outcome = (
        F.when(F.col("suspicious_flagged") < F.col("suspicious_cases"), "suspicious not flagged")
        .when(F.col("normal_flagged") > 0, "normal flagged")
        .otherwise("distinguishes")
    )
    return per_model.withColumn("outcome", outcome)


def with_risk_factors(df: DataFrame, amount: str = "amount") -> DataFrame:
    """``risk_factors`` of scored rows that carry amount, category, hour and fraud history."""
    return df.withColumn(
        "risk_factors",
        rules.risk_factors(
            F.col(amount),
            F.col("merchant_category"),
            F.col("hour"),
            F.col("customer_fraud_count"),
            F.col("prediction"),
            F.col("fraud_probability"),
        ),
    )


def explode_factors(df: DataFrame, key: str = "transaction_id") -> DataFrame:
    """One row per risk factor; transactions without any have none."""
    return df.select(key, F.inline_outer("risk_factors")).filter(F.col("factor").isNotNull())


def batch_result(df: DataFrame, amount: str = "amount") -> DataFrame:
    """The eleven report columns of scored batch rows."""
    prediction, probability = F.col("prediction"), F.col("fraud_probability")
    level = rules.risk_level(prediction, probability)
    when = F.col("transaction_datetime")
    columns = {
        "transaction_id": F.col("transaction_id"),
        "customer_id": F.col("customer_id"),
        "amount": F.col(amount),
        "merchant_category": text.title_case(F.col("merchant_category")),
        "transaction_time": clock.timestamp_text(when),
        "hour": F.col("hour"),
        "day_of_week": clock.day_name(clock.day_of_week(when)),
        "prediction": text.fraud_label(prediction),
        "confidence": probability,
        "risk_level": level,
        "risk_emoji": rules.risk_mark(level),
    }
    return df.select(*[columns[c].alias(c) for c in BATCH_RESULT_COLUMNS])


def score(
    batch: DataFrame,
    scorer: Scorer,
    keep_stages: bool = False,
    max_group_rows: int = MAX_GROUP_ROWS,
    advance: bool = False,
) -> DataFrame:
    """Unlabelled transactions with features and ``scores``."""
    rows = spread(with_serving_features(batch, scorer, max_group_rows, advance), batch.count(), SCORE_ROWS)
    return with_scores(rows, scorer, keep_stages)


def score_batch(
    batch: DataFrame, scorer: Scorer, model: str, stored: bool = False, advance: bool = False
) -> DataFrame:
    """Parsed batch rows to report rows with one model; the plan does not depend on the row count.

    The parsed rows are written once: looking up history reads them more than once, and parsing text
    again would cost more than that. A ``stored`` table is read where it is.
    """
    batch = batch if stored else stage(batch, "batch")
    lowered = batch.withColumn("merchant_category", F.lower("merchant_category"))
    only = replace(scorer, models={model: scorer.models[model]})
    return batch_result(one_model(score(lowered, only, advance=advance)), "amount_original")


def scenario_scores(spark: SparkSession, scorer: Scorer) -> DataFrame:
    """The four fixed scenarios under every fitted model."""
    return score_all_models(with_scores(scenarios_df(spark), scorer), ["scenario"])


def scaled_features(df: DataFrame, scorer: Scorer, key: str) -> DataFrame:
    """(key, position, feature, raw and scaled value) of rows with complete features."""
    names = F.array(*[F.lit(f) for f in FEATURES])
    scaled = scorer.scaler.transform(assemble(df))
    values = F.arrays_zip(
        names.alias("feature"),
        vector_to_array("features_raw").alias("raw_value"),
        vector_to_array("features_scaled").alias("scaled_value"),
    )
    return scaled.select(key, F.posexplode(values).alias("position", "v")).select(
        key, "position", "v.feature", "v.raw_value", "v.scaled_value"
    )
