"""Display text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


# A character no category name holds; followed by a space it starts a word for initcap.
_WORD_BREAK = "\u0001 "


def title_case(text: Column) -> Column:
    """Upper-case every letter that does not follow a letter, lower-case the rest."""
    split_up = F.regexp_replace(F.lower(text), r"(?<=[^\p{L} ])(?=\p{L})", _WORD_BREAK)
    return F.replace(F.initcap(split_up), F.lit(_WORD_BREAK), F.lit(""))


def money(amount: Column) -> Column:
    """``$1,234.50``, half-even on the exact binary value."""
    return F.concat(F.lit("$"), F.format_number(amount, 2))


def percent(fraction: Column, digits: int = 1) -> Column:
    """``12.5%`` for 0.125, half-even on the exact binary value."""
    number = F.format_number(fraction * F.lit(100.0), digits)
    return F.concat(F.replace(number, F.lit(","), F.lit("")), F.lit("%"))


def fraud_label(prediction: Column) -> Column:
    return F.when(prediction == 1, "FRAUD").otherwise("LEGITIMATE")


def target_label(target: Column) -> Column:
    """Display name of the 0/1 target; null for anything else."""
    return F.when(target == 0, "Legitimate").when(target == 1, "Fraud")


def marked_label(label: Column) -> Column:
    """FRAUD / LEGITIMATE with the mark of the result table."""
    return F.when(label == "FRAUD", "🚨 FRAUD").otherwise("✅ LEGITIMATE")
