"""Class counts, weights, balancing, splitting and exact-size samples."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkvigil.functions.hashing import HASH_SPAN, key_fraction, key_hash
from sparkvigil.plans.quantiles import order_statistics, series_of
from sparkvigil.session import stage

# Rows per class after balancing, and the seed.
TARGET_ROWS = 250_000
SEED = 42


def class_counts(df: DataFrame, label: str = "is_fraud") -> DataFrame:
    """Rows per label value."""
    return df.groupBy(F.col(label).alias("label")).agg(F.count(F.lit(1)).alias("row_count"))


def label_distribution(
    df: DataFrame, label: str = "is_fraud", train: float = 0.8, seed: int = SEED
) -> DataFrame:
    """Rows per label of the full, training and test tables, in one pass."""
    marked = with_split(df, train, seed).select(F.col(label).alias("label"), "split")
    tables = F.explode(F.array(F.lit("full"), F.col("split")))
    return (
        marked.select("label", tables.alias("table_name"))
        .groupBy("table_name", "label")
        .agg(F.count(F.lit(1)).alias("row_count"))
    )


def two_class_counts(df: DataFrame, label: str = "target") -> tuple[int, int]:
    """(rows with label 0, rows with label 1) as numbers; no fraud at all is an error."""
    row = df.agg(
        F.count_if(F.col(label) == 0).alias("legit"), F.count_if(F.col(label) == 1).alias("fraud")
    ).first()
    if not row["fraud"]:
        raise ValueError("no fraud rows: nothing to balance or weight against")
    return row["legit"], row["fraud"]


def class_weights(df: DataFrame, label: str = "target") -> DataFrame:
    """One row per class: legitimate 1, fraud the ratio of legitimate to fraud rows."""
    legit, fraud = two_class_counts(df, label)
    return df.sparkSession.createDataFrame(
        [(0.0, 1.0), (1.0, legit / fraud)], "label double, class_weight double"
    )


def with_class_weight(
    df: DataFrame, weighting: str = "none", label: str = "target", fraud_weight: float | None = None
) -> DataFrame:
    """``class_weight`` by mode.

    ``none`` weighs all rows 1, ``post_balance`` uses the class ratio of ``df`` itself, ``ratio`` the
    given ``fraud_weight`` (the ratio before balancing).
    """
    if weighting == "none":
        return df.withColumn("class_weight", F.lit(1.0))
    if weighting == "post_balance":
        legit, fraud = two_class_counts(df, label)
        fraud_weight = legit / fraud
    elif weighting != "ratio" or fraud_weight is None:
        raise ValueError("weighting is none, post_balance, or ratio with a fraud_weight")
    return df.withColumn(
        "class_weight", F.when(F.col(label) == 0, 1.0).otherwise(F.lit(fraud_weight))
    )


def balance(
    df: DataFrame,
    label: str = "target",
    target: int = TARGET_ROWS,
    seed: int = SEED,
    method: str = "hash",
    key: str = "transaction_id",
    cap_fraud: bool = True,
) -> DataFrame:
    """Legitimate rows sampled down and fraud rows repeated up to about ``target`` rows each.

    More fraud rows than ``target`` are sampled down too, which bounds the rows a model is fitted on;
    ``cap_fraud=False`` keeps them all.

    ``hash`` decides by the key alone and gives the same rows on any cluster. ``native`` uses Spark's
    own sampling, and never returns more than ``target`` fraud rows.
    """
    legit, fraud = two_class_counts(df, label)
    legit_rows = df.filter(F.col(label) == 0)
    fraud_rows = df.filter(F.col(label) == 1)
    if method == "hash":
        if legit > target:
            legit_rows = legit_rows.filter(key_fraction(key, f"under{seed}") < target / legit)
        if fraud > target and cap_fraud:
            fraud_rows = fraud_rows.filter(key_fraction(key, f"under{seed}") < target / fraud)
        elif fraud < target:
            whole, part = divmod(target / fraud, 1)
            extra = F.when(key_fraction(key, f"over{seed}") < part, 1).otherwise(0)
            fraud_rows = fraud_rows.withColumn(
                "_copy", F.explode(F.sequence(F.lit(1), F.lit(int(whole)) + extra))
            ).drop("_copy")
    elif method == "native":
        if legit > target:
            legit_rows = legit_rows.sample(False, target / legit, seed)
        if fraud > target and cap_fraud:
            fraud_rows = fraud_rows.sample(False, target / fraud, seed)
        elif fraud < target:
            fraud_rows = at_most(fraud_rows.sample(True, target / fraud, seed), target, seed)
    else:
        raise ValueError(f"unknown balancing method {method!r}")
    return legit_rows.unionByName(fraud_rows)


def at_most(df: DataFrame, n: int, seed: int = SEED) -> DataFrame:
    """All rows, or exactly ``n`` of them, without sending them through one task."""
    numbered = stage(df.withColumn("_number", F.monotonically_increasing_id()), "sampled")
    return sample_n(numbered, n, "_number", seed).drop("_number")


def sample_n(
    df: DataFrame, n: int = 5_000, key: str = "transaction_id", seed: int = SEED
) -> DataFrame:
    """Exactly ``n`` rows (all if there are fewer): those with the smallest key hashes.

    One pass keeps the rows whose hash is small enough to be among them, with a wide margin; the n-th
    smallest hash is then looked up among those, and the sample is a filter, not a sort of the table.
    """
    total = df.count()
    if total <= n:
        return df
    if n <= 0:
        return df.limit(0)
    hashed = df.withColumn("_hash", key_hash(key, f"sample{seed}"))
    share = min((n + 10 * math.sqrt(n) + 100) / total, 1.0)
    near = stage(hashed.filter(F.col("_hash") < math.ceil(share * HASH_SPAN)), "sample")
    [series] = series_of(near, ["_hash"])
    if series.rows < n:  # repeated keys can leave too few below the margin
        near = hashed
        [series] = series_of(near, ["_hash"])
    edge = int(order_statistics(near, [(series, {n - 1})])[(None, "_hash", n - 1)])
    below = near.filter(F.col("_hash") < edge)
    ties = near.filter(F.col("_hash") == edge).orderBy(key).limit(n - below.count())
    return below.unionByName(ties).drop("_hash")


def with_split(
    df: DataFrame, train: float = 0.8, seed: int = SEED, key: str = "transaction_id"
) -> DataFrame:
    """``split`` is train or test by the key, so copies of a row never end up on both sides."""
    inside = key_fraction(key, f"split{seed}") < train
    return df.withColumn("split", F.when(inside, "train").otherwise("test"))


def split(
    df: DataFrame,
    train: float = 0.8,
    seed: int = SEED,
    method: str = "hash",
    key: str = "transaction_id",
) -> tuple[DataFrame, DataFrame]:
    """(train, test) by key hash, or by Spark's ``randomSplit`` with ``native``.

    Rows that carry a ``split`` (``with_split``) have their side already.
    """
    if method == "native":
        left, right = df.randomSplit([train, 1 - train], seed)
        return left, right
    marked = df if "split" in df.columns else with_split(df, train, seed, key)
    return (
        marked.filter(F.col("split") == "train").drop("split"),
        marked.filter(F.col("split") == "test").drop("split"),
    )


def shuffle_rows(df: DataFrame, seed: int = SEED) -> DataFrame:
    """Rows in random order. Neither splitting nor fitting needs it; it costs a full exchange."""
    return df.orderBy(F.rand(seed))
