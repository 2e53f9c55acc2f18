"""Running totals along an order, for groups of any size."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkvigil.plans.skew import (
    MAX_GROUP_ROWS,
    TAG,
    hot_groups,
    is_small,
    null_safe_join,
    sized,
    split_hot,
)
from sparkvigil.session import stage


def running_totals(
    df: DataFrame,
    keys: list[str],
    order: list[Column],
    totals: dict[str, Column],
    lag: int | None = None,
    max_group_rows: int = MAX_GROUP_ROWS,
) -> DataFrame:
    """Add one inclusive running sum per entry of ``totals`` within ``keys`` along ``order``.

    With ``lag=k`` also ``<name>_lag``: the total ``k`` rows earlier, 0 before the start. A trailing
    frame of k rows is then a difference of two totals, whatever k is.

    Ordinary groups use one window (one exchange, one sort). Hot groups are range-partitioned by their
    order, cut into blocks of at most ``max_group_rows`` rows, summed inside each block, and shifted
    by the totals of the blocks before it. How many ranges there are follows the rows of the hot
    groups, not the number of blocks: small blocks share a task.
    """
    df = df.select("*", *[expr.alias(f"_in_{name}") for name, expr in totals.items()])
    names = list(totals)
    total = df.count()
    hot = hot_groups(df, keys, max_group_rows, total)
    if hot is None:
        out = _in_one_window(sized(df, keys, total), keys, order, names, lag)
    else:
        cold, rows = split_hot(df, keys, hot, stored=False)
        out = _in_one_window(sized(cold, keys, total), keys, order, names, lag).unionByName(
            _in_blocks(rows, hot, keys, order, names, lag)
        )
    return out.drop(*[f"_in_{name}" for name in names])


def _in_one_window(df, keys, order, names, lag):
    by_order = Window.partitionBy(*keys).orderBy(*order)
    upto = by_order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    out = df.select("*", *[_sum_over(name, upto).alias(name) for name in names])
    if lag is not None:
        out = out.select("*", *[_lagged(name, lag, by_order).alias(f"{name}_lag") for name in names])
    return out


def _in_blocks(rows, hot, keys, order, names, lag):
    size = hot.agg(F.sum("_parts").alias("blocks"), F.sum("_rows").alias("rows")).first()
    block_rows = -(-size["rows"] // size["blocks"])
    configured = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranges = min(size["blocks"], max(configured, -(-size["rows"] // MAX_GROUP_ROWS)))
    by_place = [*[F.col(k) for k in keys], *order, F.col(TAG)]
    ranged = rows.drop("_parts").repartitionByRange(ranges, *by_place).sortWithinPartitions(*by_place)
    # The number holds the range in its upper bits, the row's place in the range in the lower ones.
    number = F.col("_number")
    place = number.bitwiseAND(F.lit((1 << 33) - 1))
    block = number - place + F.floor(place / F.lit(block_rows))
    numbered = ranged.withColumn("_number", F.monotonically_increasing_id())
    cut = stage(numbered.withColumn("_block", block.cast("long")).drop("_number"), "blocks")

    # One row per (group, block): it grows with the table, if by one row in ``max_group_rows``.
    before = Window.partitionBy(*keys).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        cut.groupBy(*keys, "_block")
        .agg(
            F.count(F.lit(1)).alias("_block_rows"),
            *[F.sum(f"_in_{name}").alias(f"_sum_{name}") for name in names],
        )
        .select(
            *keys,
            "_block",
            "_block_rows",
            F.coalesce(F.sum("_block_rows").over(before), F.lit(0)).alias("_start"),
            *[
                F.coalesce(F.sum(f"_sum_{name}").over(before), F.lit(0)).alias(f"_off_{name}")
                for name in names
            ],
        )
    )

    offsets = stage(offsets, "offsets")
    local = Window.partitionBy(*keys, "_block").orderBy(*order, TAG)
    upto = local.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    summed = cut.select(
        "*",
        F.row_number().over(local).alias("_row"),
        *[_sum_over(name, upto).alias(f"_local_{name}") for name in names],
    )
    placed = null_safe_join(summed, offsets, [*keys, "_block"], small=is_small(offsets)).select(
        "*",
        (F.col("_start") + F.col("_row")).alias("_position"),
        *[(F.col(f"_local_{n}") + F.col(f"_off_{n}")).alias(n) for n in names],
    )
    helpers = [TAG, "_block", "_row", "_block_rows", "_start", "_position"]
    helpers += [f"{part}_{n}" for n in names for part in ("_local", "_off")]
    if lag is None:
        return placed.drop(*helpers)

    lagged = stage(
        placed.select("*", *[_lagged(n, lag, local).alias(f"{n}_lag") for n in names]), "lagged"
    )
    # Only the first rows of a block look back past its start, and what they need lies among the
    # last rows of an earlier block: both sets hold at most ``lag`` rows per block.
    crosses = (F.col("_row") <= lag) & (F.col("_position") > lag)
    heads = lagged.filter(crosses).drop(*[f"{n}_lag" for n in names])
    tails = lagged.filter(F.col("_block_rows") - F.col("_row") < lag).select(
        *keys,
        (F.col("_position") + lag).alias("_position"),
        *[F.col(n).alias(f"{n}_lag") for n in names],
    )
    crossed = null_safe_join(heads, tails, [*keys, "_position"])
    return lagged.filter(~crosses).unionByName(crossed).drop(*helpers)


def _sum_over(name, window):
    return F.coalesce(F.sum(f"_in_{name}").over(window), F.lit(0))


def _lagged(name, lag, window):
    return F.coalesce(F.lag(name, lag).over(window), F.lit(0))
