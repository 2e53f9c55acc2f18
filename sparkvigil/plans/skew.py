"""Hot-key detection and equi-joins that split hot keys."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkvigil.session import stage

# Rows one task may receive for a single key before that key is split.
MAX_GROUP_ROWS = 2_000_000
# Largest dimension that is broadcast; rows and bytes are counted before the hint is given.
BROADCAST_ROWS = 1_000_000
BROADCAST_BYTES = 64 * 1024 * 1024
# Most new rows whose keys are broadcast to cut down a snapshot.
SNAPSHOT_ROWS = 100_000

TAG = "_tag"


def null_safe_join(
    left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner", small: bool = False
) -> DataFrame:
    """Equi-join in which a null key equals a null key; a cross join for no keys.

    ``small`` broadcasts ``right``: only for tables whose row count is bounded by construction.
    """
    renamed = right.withColumnsRenamed({k: f"_right_{k}" for k in keys})
    match = reduce(
        lambda acc, k: acc & F.col(k).eqNullSafe(F.col(f"_right_{k}")), keys, F.lit(True)
    )
    joined = left.join(F.broadcast(renamed) if small else renamed, match, how)
    return joined.drop(*[f"_right_{k}" for k in keys])


def sized(df: DataFrame, keys: list[str], total: int) -> DataFrame:
    """``df`` hashed by ``keys`` into enough partitions for ``total`` rows.

    Adaptive execution merges small partitions but never cuts the big ones of a window or a join, so
    the session's partition count is only kept where it is enough.
    """
    configured = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    needed = -(-total // MAX_GROUP_ROWS)
    return df.repartition(needed, *keys) if keys and needed > configured else df


def spread(df: DataFrame, total: int, rows: int) -> DataFrame:
    """``df`` in even parts of about ``rows`` rows, for work that costs more than an exchange.

    Files that compress well come in few and uneven parts, whatever their number of rows.
    """
    return df.repartition(-(-total // rows)) if total > rows else df


def hot_groups(
    df: DataFrame,
    keys: list[str],
    max_group_rows: int = MAX_GROUP_ROWS,
    total: int | None = None,
) -> DataFrame | None:
    """Keys with more rows than one task should take, with ``_parts``, the pieces to cut them in.

    A plain row count rules hot keys out for small inputs. The counts per key are combined map-side.
    The result has at most one row for every ``max_group_rows`` rows of ``df``.
    """
    total = df.count() if total is None else total
    limit = max_group_rows
    if total <= limit:
        return None
    counts = (
        df.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("_rows"))
        .filter(F.col("_rows") > limit)
        .withColumn("_parts", F.ceil(F.col("_rows") / F.lit(limit)).cast("long"))
    )
    hot = stage(counts, "hot_groups")
    return None if hot.isEmpty() else hot


def split_hot(
    df: DataFrame, keys: list[str], hot: DataFrame, stored: bool = True
) -> tuple[DataFrame, DataFrame]:
    """(rows of ordinary keys, rows of hot keys).

    The hot rows carry ``_parts`` and ``_tag``, a row number that differs even between exact copies.
    They are written out once, so a re-run task sees the same value again; with ``stored=False`` the
    caller does that before the rows are read a second time.
    """
    small = is_small(hot)
    cold = null_safe_join(df, hot, keys, "left_anti", small=small)
    rows = null_safe_join(df, hot.drop("_rows"), keys, small=small)
    tagged = rows.withColumn(TAG, F.monotonically_increasing_id())
    return cold, stage(tagged, "hot_rows") if stored else tagged


def skew_join(
    left: DataFrame,
    right: DataFrame,
    keys: list[str],
    how: str = "inner",
    max_group_rows: int = MAX_GROUP_ROWS,
    broadcast_rows: int = BROADCAST_ROWS,
    total: int | None = None,
) -> DataFrame:
    """Inner or left equi-join on ``keys`` where a hot key of ``left`` goes to several tasks.

    Without hot keys this is Spark's own join, which picks broadcast or sort-merge. With hot keys a
    small ``right`` is broadcast. Otherwise a hot key is cut in ``_parts`` pieces by ``_tag``, and the
    few matching rows of ``right`` are repeated per piece.
    """
    if how == "inner":  # null keys match nothing: they must not count as a hot key
        left = left.filter(reduce(lambda a, k: a & F.col(k).isNotNull(), keys, F.lit(True)))
    total = left.count() if total is None else total
    hot = hot_groups(left, keys, max_group_rows, total)
    if hot is not None and is_small(right, broadcast_rows):
        return left.join(F.broadcast(right), keys, how)
    cold, rows = (left, None) if hot is None else split_hot(left, keys, hot)
    joined = _sized_join(cold, right, keys, how, total)
    if hot is None:
        return joined
    salted = rows.withColumn("_salt", F.pmod(F.col(TAG), F.col("_parts")))
    copies = (
        right.join(_hinted(hot.select(*keys, "_parts"), hot), keys, "inner")
        .withColumn("_salt", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_parts") - 1)))
        .drop("_parts")
    )
    pieces = salted.join(copies, [*keys, "_salt"], how).drop("_salt", "_parts", TAG)
    return joined.unionByName(pieces)


def _hinted(df: DataFrame, measured: DataFrame) -> DataFrame:
    """A broadcast hint if the stored table ``measured`` is small enough for it."""
    return F.broadcast(df) if is_small(measured) else df


def _sized_join(left, right, keys, how, total):
    """Spark picks broadcast or sort-merge; the shuffle is only sized by hand for a big right side."""
    wide = sized(left, keys, total)
    if wide is left or right.count() <= BROADCAST_ROWS:
        return left.join(right, keys, how)
    return wide.join(right, keys, how)


def is_small(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> bool:
    """Whether a table may be broadcast, by its counted rows and bytes.

    Arrays, maps and other nested values count with the length of their JSON form.
    """
    text = [
        F.octet_length(name) if kind in ("string", "binary") else F.length(F.to_json(F.struct(name)))
        for name, kind in df.dtypes
        if kind in ("string", "binary") or kind.startswith(("array", "map", "struct"))
    ]
    per_row = reduce(lambda a, b: a + F.coalesce(b, F.lit(0)), text, F.lit(16 * len(df.columns)))
    size = df.agg(F.count(F.lit(1)).alias("rows"), F.sum(per_row).alias("bytes")).first()
    return size["rows"] <= max_rows and (size["bytes"] or 0) <= BROADCAST_BYTES


def lookup_join(
    df: DataFrame,
    dimension: DataFrame,
    keys: list[str],
    max_rows: int = BROADCAST_ROWS,
    stored: bool = False,
) -> DataFrame:
    """Left join to a dimension with one row per key: broadcast if it is small, else split hot keys.

    The dimension is measured first; one that is not a stored table yet is written out for that.
    """
    if not stored:
        dimension = stage(dimension, "dimension")
    if is_small(dimension, max_rows):
        return df.join(F.broadcast(dimension), keys, "left")
    return skew_join(df, dimension, keys, "left", broadcast_rows=max_rows)


def snapshot_join(
    df: DataFrame,
    snapshot: DataFrame,
    keys: list[str],
    max_group_rows: int = MAX_GROUP_ROWS,
    max_rows: int = SNAPSHOT_ROWS,
) -> DataFrame:
    """Left join of new rows to a large snapshot with one row per key.

    A few new rows (a micro-batch) broadcast their keys, and the snapshot is filtered while it is
    scanned: what remains has at most one row per new row, so it is broadcast back and nothing is
    shuffled. More rows than that are joined with hot keys split.
    """
    total = df.count()
    if total > max_rows:
        return skew_join(df, snapshot, keys, "left", max_group_rows, total=total)
    wanted = F.broadcast(df.select(*keys).distinct())
    return df.join(F.broadcast(snapshot.join(wanted, keys, "left_semi")), keys, "left")
