"""Numbers, direction and rating of prices."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def to_number(text: Column) -> Column:
    """A served text as a double; text that is no number gives null."""
    plain = text.cast("string")
    # The cast would read Java's type suffixes, as in "1.5d".
    return F.when(~plain.rlike(r"[0-9.][dDfF]\s*$"), plain.try_cast("double"))


def candle_direction(open_price: Column, close_price: Column) -> Column:
    return F.when(close_price >= open_price, "up").otherwise("down")


def price_change(current: Column, previous: Column) -> Column:
    return current - previous


def percent_of(part: Column, whole: Column) -> Column:
    """``part / whole * 100``; null where ``whole`` is zero."""
    return F.try_divide(part, whole) * 100


def target_upside(target: Column, price: Column) -> Column:
    return percent_of(target - price, price)


def rating_band(rating: Column) -> Column:
    """Analyst rating as text; a missing rating falls in the last band."""
    # Upper bounds and names of the bands.
    return (
        F.when(rating <= 1.5, "Strong Buy")
        .when(rating <= 2.5, "Buy")
        .when(rating <= 3.5, "Hold")
        .when(rating <= 4.5, "Sell")
        .otherwise("Strong Sell")
    )
