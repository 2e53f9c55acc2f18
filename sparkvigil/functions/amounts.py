"""Amount ladders, capping and binning."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Right-closed report ranges (low, high, label).
AMOUNT_RANGES = [
    (0.0, 100.0, "<$100"),
    (100.0, 500.0, "$100-500"),
    (500.0, 1000.0, "$500-1000"),
    (1000.0, 5000.0, "$1000-5000"),
    (5000.0, None, ">$5000"),
]


def amount_category(
    amount: Column, q25: Column, q50: Column, q75: Column, null_as_last: bool = False
) -> Column:
    """small / medium / large / very_large by quartile; a null amount has no category unless asked."""
    ladder = (
        F.when(amount <= q25, "small")
        .when(amount <= q50, "medium")
        .when(amount <= q75, "large")
        .when(amount.isNotNull(), "very_large")
    )
    return ladder.otherwise("very_large") if null_as_last else ladder


def is_outlier(amount: Column, lower: Column, upper: Column) -> Column:
    """Strictly outside the bounds; null for a null amount."""
    return (amount < lower) | (amount > upper)


def capped(amount: Column, lower: Column, upper: Column) -> Column:
    """The amount pulled to the nearest bound; null stays null."""
    return F.when(amount < lower, lower).when(amount > upper, upper).otherwise(amount)


def amount_range(amount: Column) -> Column:
    """Label of the right-closed range that holds the amount; null for 0 and below."""
    label = None
    for low, high, name in AMOUNT_RANGES:
        inside = amount > low if high is None else (amount > low) & (amount <= high)
        label = F.when(inside, name) if label is None else label.when(inside, name)
    return label


def right_closed_bin(value: Column, low: Column, high: Column, bins: int) -> Column:
    """1-based number of the equal-width bin (lo, hi]; the minimum belongs to bin 1."""
    step = (high - low) / F.lit(bins)
    passed = F.lit(1)
    for i in range(1, bins):
        passed = passed + F.when(value > low + F.lit(i) * step, 1).otherwise(0)
    return F.when(value.isNotNull(), passed)


def left_closed_bin(value: Column, low: Column, high: Column, bins: int) -> Column:
    """0-based number of the equal-width bin [lo, hi); the maximum belongs to the last bin."""
    width = (high - low) / F.lit(bins)
    number = F.floor((value - low) / F.nullif(width, F.lit(0.0))).cast("int")
    return F.when(value.isNotNull(), F.coalesce(F.least(number, F.lit(bins - 1)), F.lit(0)))
