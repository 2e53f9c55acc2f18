"""Quantile sketches of amounts that are stored by day and category and merged when they are needed.

The sketch is Spark's own KLL aggregate: a value's rank in it is off by a share of the rows that its
size ``K`` bounds, and merging sketches keeps that bound. A fit over years of days reads one small row
for every day and category.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkvigil.operators.features import CAP_PROBABILITIES, QUARTILES

# Size of a sketch, and the share of rows by which a rank is off at most: two and a half times the
# bound that holds for 99 % of sketches of that size.
K = 4096
RANK_ERROR = 0.0033

SKETCH = "sketch"


def amount_sketches(tx: DataFrame, k: int = K) -> DataFrame:
    """day, merchant_category (lower case), rows and sketch of the amounts of timed transactions."""
    whole = F.col("amount").isNotNull() & ~F.isnan("amount")
    return (
        tx.filter(whole)
        .groupBy(
            F.to_date("transaction_datetime").alias("day"),
            F.lower("merchant_category").alias("merchant_category"),
        )
        .agg(F.count(F.lit(1)).alias("rows"), F.kll_sketch_agg_double("amount", F.lit(k)).alias(SKETCH))
    )


def merged_sketches(sketches: DataFrame, *keys: str) -> DataFrame:
    """rows and sketch by some of the keys, or of all rows."""
    return sketches.groupBy(*keys).agg(F.sum("rows").alias("rows"), F.kll_merge_agg_double(SKETCH).alias(SKETCH))


def quantile_of(sketch: Column, probability: float) -> Column:
    return F.kll_sketch_get_quantile_double(sketch, F.lit(float(probability)))


def sketched_quantiles(sketches: DataFrame, probabilities: dict[str, float], *keys: str) -> DataFrame:
    """The keys, rows, and one column for every named probability."""
    merged = merged_sketches(sketches, *keys).filter(F.col("rows") > 0)
    return merged.select(*keys, "rows", *[quantile_of(F.col(SKETCH), p).alias(n) for n, p in probabilities.items()])


def preprocessing_quantiles(sketches: DataFrame) -> list[float]:
    """Quartiles and capping bounds of all sketched amounts."""
    names = {f"q{i}": p for i, p in enumerate([*QUARTILES, *CAP_PROBABILITIES])}
    row = sketched_quantiles(sketches, names).first()
    if row is None or row["rows"] is None or any(row[n] is None or math.isnan(row[n]) for n in names):
        raise ValueError("no transaction has an amount")
    return [row[n] for n in names]
