"""Time of day and day of week, independent of the session time zone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Day names from Monday, and the hours the batch report calls late.
DAY_NAMES = ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday"]
LATE_NIGHT_HOURS = [0, 1, 2, 3, 4, 5, 22, 23]


def parsed_timestamp(column: str | Column, formats: tuple[str, ...] = ()) -> Column:
    """Timestamp without zone, null where the text cannot be read.

    ISO text is tried first, then each of ``formats``.
    """
    column = F.col(column) if isinstance(column, str) else column
    tries = [column.try_cast("timestamp_ntz")]
    tries += [F.try_to_timestamp(column, F.lit(f)).cast("timestamp_ntz") for f in formats]
    return F.coalesce(*tries)


def day_of_week(ts: Column, convention: str = "sunday1") -> Column:
    """``sunday1`` numbers Sunday 1 to Saturday 7, ``monday1`` Monday 1 to Sunday 7."""
    if convention == "sunday1":
        return F.dayofweek(ts)
    if convention == "monday1":
        return F.weekday(ts) + 1
    raise ValueError(f"unknown day-of-week convention {convention!r}")


def day_name(number: Column, convention: str = "sunday1") -> Column:
    """English day name of a day number, 'Unknown' outside 1..7."""
    if convention not in ("sunday1", "monday1"):
        raise ValueError(f"unknown day-of-week convention {convention!r}")
    names = DAY_NAMES if convention == "monday1" else DAY_NAMES[-1:] + DAY_NAMES[:-1]
    known = F.element_at(F.array(*[F.lit(n) for n in names]), number.cast("int"))
    return F.when(number.between(1, 7), known).otherwise("Unknown")


def timestamp_text(ts: Column) -> Column:
    """``2024-01-15 14:30:00``; fractions of a second are cut off."""
    return F.substring(ts.cast("timestamp_ntz").cast("string"), 1, 19)


def unusual_hour(hour: Column) -> Column:
    """The rule used for risk factors: before 6 or after 22."""
    return (hour < 6) | (hour > 22)


def late_night(hour: Column) -> Column:
    """The rule used in the batch report: 22:00 up to 6:00."""
    return hour.isin(*LATE_NIGHT_HOURS)
