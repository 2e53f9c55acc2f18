"""What history and categories have been, as states that can be merged, and kept as versions.

A customer's state is its number of rows, its fraud count and its newest ``HISTORY_ROWS`` rows; a
category's is the number, sum and sum of squares of its labels. States of parts of a table merge, in
any order, to the state of the whole: a day's rows are added without reading earlier rows again.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window
from pyspark.sql import functions as F

from sparkvigil.operators.features import HISTORY_ROWS, Preprocessing
from sparkvigil.operators.sketches import amount_sketches, preprocessing_quantiles
from sparkvigil.session import stage
from sparkvigil.sources.commits import Versions, remove

# What the states are worked out from.
STATE_COLUMNS = ["customer_id", "transaction_datetime", "transaction_id", "is_fraud", "merchant_category", "amount"]
ENTRY = "struct<at:timestamp_ntz,id:bigint,label:bigint>"


# ---- customers ----------------------------------------------------------------------------------


def customer_state(tx: DataFrame, frame: int = HISTORY_ROWS) -> DataFrame:
    """customer_id, rows, frauds and newest (at, id, label), newest first, of timed transactions.

    Only ``frame`` rows a customer leave a task, however many a customer has: Spark limits the groups
    of a ranking before and after its exchange.
    """
    label = F.col("is_fraud").cast("long")
    by_time = Window.partitionBy("customer_id").orderBy(F.desc("transaction_datetime"), F.desc("transaction_id"))
    newest = (
        tx.select("customer_id", "transaction_datetime", "transaction_id", label.alias("label"))
        .withColumn("_nth", F.row_number().over(by_time))
        .filter(F.col("_nth") <= frame)
        .groupBy("customer_id")
        .agg(
            F.collect_list(
                F.struct(F.col("transaction_datetime").alias("at"), F.col("transaction_id").alias("id"), "label")
            ).alias("newest")
        )
    )
    totals = tx.groupBy("customer_id").agg(
        F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum(label), F.lit(0)).alias("frauds")
    )
    none = F.lit(0).cast("long")
    return merge_customer_states(
        totals.withColumn("newest", F.array().cast(f"array<{ENTRY}>")),
        newest.select("customer_id", none.alias("rows"), none.alias("frauds"), "newest"),
        frame=frame,
    )


def merge_customer_states(*states: DataFrame, frame: int = HISTORY_ROWS) -> DataFrame:
    """The state of all rows from states of disjoint parts; a group has one row for every part."""
    newest = F.sort_array(F.flatten(F.collect_list("newest")), asc=False)
    return (
        reduce(DataFrame.unionByName, states)
        .groupBy("customer_id")
        .agg(F.sum("rows").alias("rows"), F.sum("frauds").alias("frauds"), F.slice(newest, 1, frame).alias("newest"))
    )


def profile_of(state: DataFrame, frame: int = HISTORY_ROWS) -> DataFrame:
    """The customer profile: fraud rate of the newest rows with a label, and the two counts."""
    labels = F.filter(F.slice("newest", 1, frame)["label"], lambda x: x.isNotNull())
    total = F.aggregate(labels, F.lit(0).cast("long"), lambda a, x: a + x)
    return state.select(
        "customer_id",
        F.when(F.size(labels) > 0, total / F.size(labels)).otherwise(0.0).alias("customer_fraud_rate"),
        F.col("rows").alias("customer_transaction_count"),
        F.col("frauds").alias("customer_fraud_count"),
    )


# ---- categories ---------------------------------------------------------------------------------


def merchant_state(tx: DataFrame) -> DataFrame:
    """merchant_category (lower case), labels, total and squares of its labels."""
    label = F.col("is_fraud").cast("long")
    none = F.lit(0).cast("long")
    return (
        tx.filter(F.col("merchant_category").isNotNull())
        .groupBy(F.lower("merchant_category").alias("merchant_category"))
        .agg(
            F.count(label).alias("labels"),
            F.coalesce(F.sum(label), none).alias("total"),
            F.coalesce(F.sum(label * label), none).alias("squares"),
        )
    )


def merge_merchant_states(*states: DataFrame) -> DataFrame:
    merged = reduce(DataFrame.unionByName, states).groupBy("merchant_category")
    return merged.agg(*[F.sum(c).alias(c) for c in ("labels", "total", "squares")])


def merchant_stats_of(state: DataFrame) -> DataFrame:
    """Mean and sample deviation of the label per category; 0 where there is only one row."""
    n, total, squares = F.col("labels"), F.col("total"), F.col("squares")
    # Whole numbers up to here: n * squares - total * total is exact.
    spread = (n * squares - total * total).cast("double") / (n * (n - 1))
    return state.select(
        "merchant_category",
        F.try_divide(total, n).alias("merchant_fraud_rate"),
        F.when(n > 1, F.sqrt(spread)).otherwise(0.0).alias("merchant_fraud_volatility"),
    )


# ---- kept as versions ---------------------------------------------------------------------------


class SnapshotStore:
    """States of all parts added so far, below one root; each addition is a version of its own."""

    def __init__(self, spark: SparkSession, root: str, frame: int = HISTORY_ROWS) -> None:
        self.spark, self.root, self.frame = spark, root, frame
        self.versions = Versions(spark, root)

    def parts(self) -> list[str]:
        return (self.versions.content() or {"parts": []})["parts"]

    def add(self, part: str, tx: DataFrame) -> bool:
        """Merge the timed transactions of a part, such as a day's; False if the part is already in.

        The part's rows are written once, as four states are worked out from them, and those once; if
        another writer publishes first, they are merged with what is newest then.
        """
        if part in self.parts():
            return False
        tx = stage(tx.select(*STATE_COLUMNS), "part")
        own = {
            "customers": stage(customer_state(tx, self.frame), "customers"),
            "merchants": stage(merchant_state(tx), "merchants"),
            "sketches": stage(amount_sketches(tx), "sketches"),
        }
        while True:
            seen = self.versions.content()
            known = seen["parts"] if seen else []
            if part in known:
                return False
            folder = self.versions.new_folder()
            for name, state in own.items():
                self.merged(name, seen, state).write.parquet(f"{folder}/{name}")
            if self.versions.publish_after(seen["version"] if seen else None, folder, parts=[*known, part]):
                return True
            remove(self.spark, folder)

    def merged(self, name: str, seen: dict | None, state: DataFrame) -> DataFrame:
        if seen is None:
            return state
        before = self.spark.read.schema(state.schema).parquet(f"{seen['folder']}/{name}")
        if name == "customers":
            return merge_customer_states(before, state, frame=self.frame)
        return merge_merchant_states(before, state) if name == "merchants" else before.unionByName(state)

    def read(self, name: str) -> DataFrame:
        """The newest state of ``customers`` or ``merchants``, or the ``sketches``."""
        seen = self.versions.content()
        if seen is None:
            raise FileNotFoundError(f"no snapshot below {self.root}")
        return self.spark.read.parquet(f"{seen['folder']}/{name}")

    def profile(self) -> DataFrame:
        return profile_of(self.read("customers"), self.frame)

    def preprocessing(self) -> Preprocessing:
        """Fitted state from what is stored, without reading any transaction again."""
        values = preprocessing_quantiles(self.read("sketches"))
        stats = stage(merchant_stats_of(self.read("merchants")), "merchant_stats")
        return Preprocessing(values[:3], values[3], values[4], stats)


def by_day(column: Column | None = None) -> Column:
    """The day of a timed transaction, as a part's name."""
    return F.date_format(F.col("transaction_datetime") if column is None else column, "yyyy-MM-dd")
