"""Exact quantiles of any number of rows with bounded memory per task and on the driver."""

from __future__ import annotations

import math
import sys
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Bins per bracket and pass, and the bracket size at which the values themselves are listed.
BINS = 1024
LIST_ROWS = 4_000
# Relative accuracy asked of the first sketch, and how far its brackets reach beyond a rank.
SKETCH_ACCURACY = 10_000
SKETCH_ERROR = 3e-4
# Grouped quantiles: a group up to this size is left to the built-in exact percentile of one task;
# longer ones are narrowed by range, so many at a time.
GROUP_ROWS = 1_000_000
GROUPS_AT_A_TIME = 32


@dataclass
class Series:
    """One column within one group: its size and extremes."""

    group: object
    column: str
    rows: int
    low: float | None
    high: float | None


@dataclass
class Bracket:
    """Value range [low, high] that holds ``inside`` rows and has ``below`` rows under it."""

    series: Series
    low: float
    high: float
    below: int
    inside: int
    ranks: set[int] = field(default_factory=set)
    stuck: bool = False


def _value(column: str) -> Column:
    value = F.col(column).cast("double")
    return F.when(~F.isnan(value), value)


def series_of(
    df: DataFrame, columns: list[str], by: str | None = None, above: int = 0
) -> list[Series]:
    """Count, minimum and maximum of each column, in one pass.

    With ``by`` of each group of more than ``above`` rows, of which there are few for a large ``above``.
    """
    aggs = []
    for i, c in enumerate(columns):
        aggs += [
            F.count(_value(c)).alias(f"n{i}"),
            F.min(_value(c)).alias(f"lo{i}"),
            F.max(_value(c)).alias(f"hi{i}"),
        ]
    grouped = df.filter(F.col(by).isNotNull()).groupBy(by) if by else df.groupBy()
    counted = grouped.agg(F.count(F.lit(1)).alias("_size"), *aggs)
    rows = (counted.filter(F.col("_size") > above) if by else counted).collect()
    return [
        Series(r[by] if by else None, c, r[f"n{i}"], r[f"lo{i}"], r[f"hi{i}"])
        for r in rows
        for i, c in enumerate(columns)
    ]


def order_statistics(
    df: DataFrame, wanted: list[tuple[Series, set[int]]], by: str | None = None
) -> dict[tuple[object, str, int], float]:
    """The values at the given 0-based ranks, keyed by (group, column, rank).

    Whole columns start from a sketch: it gives a narrow bracket around each rank, and one pass of
    conditional counts proves which ranks lie in theirs. After that, each pass counts the rows of
    every open bracket in equal-width bins and keeps the bin that holds the rank, until the bracket
    is short enough to list. A pass is one scan of the columns asked for, with a map-side combine down
    to a few thousand counters.
    """
    found: dict[tuple[object, str, int], float] = {}
    open_ = [
        Bracket(s, s.low, s.high, 0, s.rows, set(ranks)) for s, ranks in wanted if s.rows and ranks
    ]
    if by is None:
        large = [b for b in open_ if b.inside > LIST_ROWS and b.low < b.high]
        open_ = [b for b in open_ if b not in large] + _sketched(df, large)
    while open_:
        for b in [b for b in open_ if b.low == b.high]:
            found.update({(b.series.group, b.series.column, r): b.low for r in b.ranks})
        open_ = [b for b in open_ if b.low < b.high]
        # A bracket that bins cannot narrow has ends next to each other: few values, to be listed.
        wide = [b for b in open_ if b.inside > LIST_ROWS and not b.stuck]
        if not wide:
            break
        open_ = [b for b in open_ if b.inside <= LIST_ROWS or b.stuck] + _refine(df, wide, by)
    for i, counted in _listed(df, open_, by).items():
        b = open_[i]
        position = b.below
        pending = sorted(b.ranks)
        for value, n in sorted(counted):
            while pending and pending[0] < position + n:
                found[(b.series.group, b.series.column, pending.pop(0))] = value
            position += n
    return found


def _sketched(df: DataFrame, brackets: list[Bracket]) -> list[Bracket]:
    """Brackets narrowed by a quantile sketch; ranks that it misses keep their wide bracket."""
    runs = [(b, run) for b in brackets for run in _neighbours(sorted(b.ranks))]
    if not runs:
        return brackets
    # One sketch a column, asked for the ends of all its brackets: rows cost by sketch, not by rank.
    spots: dict[str, list[float]] = {}
    for b, run in runs:
        low, high = run[0] / b.series.rows - SKETCH_ERROR, run[-1] / b.series.rows + SKETCH_ERROR
        spots.setdefault(b.series.column, []).extend([max(0.0, low), min(1.0, high)])
    sketches = [
        F.percentile_approx(_value(c), F.array(*[F.lit(x) for x in at]), SKETCH_ACCURACY).alias(f"s{i}")
        for i, (c, at) in enumerate(spots.items())
    ]
    found = {c: iter(values) for c, values in zip(spots, df.agg(*sketches).first(), strict=True)}
    ends = [(next(found[b.series.column]), next(found[b.series.column])) for b, _ in runs]
    counts = []
    for i, (b, _) in enumerate(runs):
        value, (low, high) = _value(b.series.column), ends[i]
        counts += [F.count_if(value < F.lit(low)), F.count_if((value >= F.lit(low)) & (value <= F.lit(high)))]
    seen = df.agg(*[c.alias(f"c{i}") for i, c in enumerate(counts)]).first()
    out = []
    for i, (b, run) in enumerate(runs):
        below, inside = seen[2 * i], seen[2 * i + 1]
        held = {r for r in run if below <= r < below + inside}
        if held:
            out.append(Bracket(b.series, ends[i][0], ends[i][1], below, inside, held))
        if missed := set(run) - held:
            out.append(Bracket(b.series, b.low, b.high, b.below, b.inside, missed))
    return out


def _neighbours(ranks: list[int]) -> list[list[int]]:
    """Runs of ranks that follow each other."""
    out: list[list[int]] = []
    for r in ranks:
        if out and r - out[-1][-1] <= 1:
            out[-1].append(r)
        else:
            out.append([r])
    return out


def _inside(b: Bracket, by: str | None) -> Column:
    value = _value(b.series.column)
    cond = (value >= F.lit(b.low)) & (value <= F.lit(b.high))
    return cond & (F.col(by) == F.lit(b.series.group)) if by else cond


def _exploded(df: DataFrame, hits: list[Column]) -> DataFrame:
    # The outer form keeps Catalyst from testing the array once more in a filter below.
    return df.select(F.explode_outer(F.array(*hits)).alias("h")).filter(F.col("h").isNotNull())


def _place(value: Column, low: float, high: float) -> Column:
    """Bin of a value within [low, high]; halved and finite, so that no difference overflows."""
    low, high = [max(min(x, sys.float_info.max), -sys.float_info.max) / 2 for x in (low, high)]
    if low == high:  # an infinity next to the largest finite number
        return F.when(F.abs(value) == math.inf, BINS - 1 if low > 0 else 0).otherwise(
            0 if low > 0 else BINS - 1
        )
    finite = F.greatest(F.least(value, F.lit(sys.float_info.max)), F.lit(-sys.float_info.max)) / 2
    return F.floor((finite - F.lit(low)) / F.lit(high - low) * BINS).cast("int")


def _refine(df, brackets, by):
    hits = []
    for i, b in enumerate(brackets):
        value = _value(b.series.column)
        place = _place(value, b.low, b.high)
        hits.append(
            F.when(
                _inside(b, by),
                F.struct(
                    F.lit(i).alias("i"),
                    F.least(place, F.lit(BINS - 1)).alias("bin"),
                    value.alias("v"),
                ),
            )
        )
    bins = (
        _exploded(df, hits)
        .groupBy("h.i", "h.bin")
        .agg(F.count(F.lit(1)).alias("n"), F.min("h.v").alias("lo"), F.max("h.v").alias("hi"))
        .collect()
    )
    narrowed = []
    for i, b in enumerate(brackets):
        below = b.below
        for r in sorted((r for r in bins if r["i"] == i), key=lambda r: r["bin"]):
            ranks = {k for k in b.ranks if below <= k < below + r["n"]}
            if ranks:
                stuck = (r["lo"], r["hi"], r["n"]) == (b.low, b.high, b.inside)
                narrowed.append(Bracket(b.series, r["lo"], r["hi"], below, r["n"], ranks, stuck))
            below += r["n"]
    return narrowed


def _listed(df, brackets, by):
    counted: dict[int, list[tuple[float, int]]] = {i: [] for i in range(len(brackets))}
    if brackets:
        hits = [
            F.when(
                _inside(b, by),
                F.struct(F.lit(i).alias("i"), _value(b.series.column).alias("v")),
            )
            for i, b in enumerate(brackets)
        ]
        rows = (
            _exploded(df, hits)
            .groupBy("h.i", "h.v")
            .agg(F.count(F.lit(1)).alias("n"))
            .collect()
        )
        for r in rows:
            counted[r["i"]].append((r["v"], r["n"]))
    return counted


def exact_quantiles(
    df: DataFrame,
    columns: list[str],
    probabilities: list[float],
    method: str = "disc",
    by: str | None = None,
) -> dict[tuple[object, str], list[float | None]]:
    """Exact quantiles per (group, column).

    ``disc`` returns an element of the data, ``linear`` interpolates between neighbours. Nulls and
    NaN are left out. Pass a stored table: every pass reads it again, only the columns asked for.
    """
    return _quantiles_of(df, series_of(df, columns, by), probabilities, method, by)


def _quantiles_of(df, series, probabilities, method, by):
    needed, plans = [], []
    for s in series:
        spots = [_spot(p, s.rows, method) for p in probabilities] if s.rows else []
        needed.append((s, {r for lo, hi, _ in spots for r in (lo, hi)}))
        plans.append((s, spots))
    values = order_statistics(df, needed, by)
    result = {}
    for s, spots in plans:
        if not s.rows:
            result[(s.group, s.column)] = [None] * len(probabilities)
            continue
        picked = []
        for lo, hi, weight in spots:
            a = values[(s.group, s.column, lo)]
            b = values[(s.group, s.column, hi)]
            picked.append(a if a == b else a + (b - a) * weight)
        result[(s.group, s.column)] = picked
    return result


def _spot(p, rows, method):
    if method == "disc":
        rank = max(math.ceil(p * rows) - 1, 0)
        return rank, rank, 0.0
    at = p * (rows - 1)
    low = math.floor(at)
    return low, min(low + 1, rows - 1), at - low


def grouped_quantiles(
    df: DataFrame, column: str, probabilities: list[float], by: str, group_rows: int = GROUP_ROWS
) -> DataFrame:
    """(``by``, ``values``): exact interpolated quantiles of every group, however many there are.

    Short groups are one distributed aggregation. Long ones, at most one for every ``group_rows``
    rows, are narrowed by range, ``GROUPS_AT_A_TIME`` together. Pass a stored table.
    """
    spark = df.sparkSession
    kind = df.schema[by].dataType.simpleString()
    long = series_of(df, [column], by, above=group_rows)
    rows = []
    for at in range(0, len(long), GROUPS_AT_A_TIME):
        found = _quantiles_of(df, long[at : at + GROUPS_AT_A_TIME], probabilities, "linear", by)
        rows += [(group, values) for (group, _), values in found.items() if values[0] is not None]
    done = spark.createDataFrame(rows, f"{by} {kind}, values array<double>")
    short = df.filter(F.col(by).isNotNull())
    if long:
        names = spark.createDataFrame([(s.group,) for s in long], f"{by} {kind}")
        short = short.join(names, by, "left_anti")
    at = [F.lit(p) for p in probabilities]
    quick = short.groupBy(by).agg(F.percentile(_value(column), F.array(*at)).alias("values"))
    return quick.filter(F.col("values").isNotNull()).unionByName(done)
