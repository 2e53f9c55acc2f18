"""Repeatable pseudo-random numbers derived from a key."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# 13 hex digits are 52 bits, which a double holds exactly.
HASH_DIGITS = 13
HASH_SPAN = 16**HASH_DIGITS


def key_hash(key: str | Column, purpose: str = "") -> Column:
    """A 52-bit number that depends on the key and the purpose only, not on the partitioning."""
    key = F.col(key) if isinstance(key, str) else key
    text = F.concat(F.lit(f"{purpose}:"), F.coalesce(key.cast("string"), F.lit("")))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, HASH_DIGITS), 16, 10).cast("long")


def key_fraction(key: str | Column, purpose: str = "") -> Column:
    """The hash as a double in [0, 1)."""
    return key_hash(key, purpose).cast("double") / F.lit(float(HASH_SPAN))
