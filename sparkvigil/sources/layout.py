"""Tables stored by customer: bucketed by the customer's id and sorted by time within a bucket.

A join of two such tables, and a window over one, read the buckets as they are: neither shuffles. The
files are plain Parquet below a folder; a session makes them a table again by naming the same layout.
A customer's rows are one bucket: for a customer of very many rows, ``with_customer_history`` cuts them.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession

from sparkvigil.plans.skew import MAX_GROUP_ROWS
from sparkvigil.sources.commits import Versions

BY = "customer_id"
TIME_ORDER = ("customer_id", "transaction_datetime", "transaction_id")


def bucket_count(rows: int, least: int, bucket_rows: int = MAX_GROUP_ROWS) -> int:
    """A power of two, so that tables of different sizes still fit together."""
    needed = max(least, -(-rows // bucket_rows), 1)
    return 1 << (needed - 1).bit_length()


def write_bucketed(
    df: DataFrame, root: str, order: tuple[str, ...] = TIME_ORDER, buckets: int | None = None
) -> int:
    """Store ``df`` below ``root`` as the next version, bucketed by customer and sorted by ``order``.

    Rows are dealt to the buckets by Spark's own bucket hash first, so each bucket is one sorted file.
    """
    spark = df.sparkSession
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    buckets = buckets or bucket_count(df.count(), least)
    versions = Versions(spark, root)
    folder, name = versions.new_folder(), f"layout_{uuid.uuid4().hex}"
    # Hashing to the same number of partitions gives every bucket to one task.
    dealt = df.repartition(buckets, BY)
    writer = dealt.write.format("parquet").bucketBy(buckets, BY).sortBy(*order).option("path", folder)
    writer.saveAsTable(name)
    spark.sql(f"DROP TABLE {name}")  # the files stay: the path was given
    return versions.publish(
        folder, buckets=buckets, order=list(order), schema=json.loads(df.schema.json())
    )


def read_bucketed(spark: SparkSession, root: str, version: int | None = None) -> DataFrame:
    """The stored table with its layout known to Spark."""
    found = Versions(spark, root).content(version)
    if found is None:
        raise FileNotFoundError(f"no stored table below {root}")
    name = f"layout_{found['folder'].rpartition('/')[2]}_{found['version']}"
    if not spark.catalog.tableExists(name):
        columns = ", ".join(f"`{f['name']}` {column_type(f)}" for f in found["schema"]["fields"])
        order = ", ".join(f"`{c}`" for c in found["order"])
        spark.sql(
            f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY (`{BY}`) SORTED BY ({order}) "
            f"INTO {found['buckets']} BUCKETS LOCATION '{found['folder']}'"
        )
    return spark.table(name)


def column_type(field: dict) -> str:
    from pyspark.sql.types import StructField

    return StructField.fromJson(field).dataType.simpleString()
