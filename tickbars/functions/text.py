"""Amounts, percents and summaries as display text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SUMMARY_LENGTH = 260


def two_decimals(value: Column, grouped: bool = False) -> Column:
    """``value`` with two decimals, rounded from its exact binary value, ties to even.

    ``format_number`` rounds that way, whereas ``format_string`` rounds the shortest
    decimal form and turns 0.125 into 0.13. From 1e14 on, where a double has less than
    two decimals, the digits are those of the shortest form.
    """
    digits = F.format_number(value, 2)
    if not grouped:
        digits = F.replace(digits, F.lit(","), F.lit(""))
    infinite = F.when(value > 0, "inf").otherwise("-inf")
    return F.when(F.abs(value) == float("inf"), infinite).otherwise(digits)


def amount_text(amount: Column, suffix: str = "") -> Column:
    """A dollar amount in T, B, M or K; ``N/A`` when missing or zero."""
    size = F.abs(amount)
    # The units and where each begins.
    scaled = (
        F.when(size >= 1e12, amount / 1e12)
        .when(size >= 1e9, amount / 1e9)
        .when(size >= 1e6, amount / 1e6)
        .when(size >= 1e3, amount / 1e3)
    )
    unit = (
        F.when(size >= 1e12, "T")
        .when(size >= 1e9, "B")
        .when(size >= 1e6, "M")
        .when(size >= 1e3, "K")
        .otherwise("")
    )
    # Only the form without a unit groups thousands: 999.999 becomes 1,000.00.
    digits = F.when(size < 1e3, two_decimals(amount, grouped=True)).otherwise(
        two_decimals(scaled)
    )
    missing = amount.isNull() | F.isnan(amount) | (amount == 0)
    return F.when(missing, "N/A").otherwise(
        F.concat(F.lit("$"), digits, unit, F.lit(suffix))
    )


def percent_text(ratio: Column) -> Column:
    """A ratio as percent text; ``N/A`` when missing."""
    return F.when(ratio.isNull() | F.isnan(ratio), "N/A").otherwise(
        F.concat(two_decimals(ratio * 100), F.lit("%"))
    )


def shorten(text: Column, length: int = SUMMARY_LENGTH) -> Column:
    """The first ``length`` characters, with dots when there was more; missing is empty."""
    present = F.coalesce(text, F.lit(""))
    dots = F.when(F.length(present) > length, "...").otherwise("")
    return F.concat(F.substring(present, 1, length), dots)
