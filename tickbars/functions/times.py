"""Clock text and epoch numbers as columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

NANOS_PER_SECOND = 1_000_000_000


def _int(text: Column) -> Column:
    return text.try_cast("bigint")


def parse_ts_ns(date: Column, time: Column) -> Column:
    """Epoch nanoseconds from a UTC date and a clock text.

    An all-digit ``time`` already is the answer. Otherwise the date is ``yyyy-MM-dd`` or
    ``yyyyMMdd`` and the time ``H:m:s`` with an optional fraction, padded or cut to nine
    digits. Hours, minutes, seconds and days past their range carry over, as in a
    calendar sum; text that is no time gives null.
    """
    dashed = F.contains(date, F.lit("-"))
    year = F.substring(date, 1, 4)
    month = F.when(dashed, F.substring(date, 6, 2)).otherwise(F.substring(date, 5, 2))
    day = F.when(dashed, F.substring(date, 9, 2)).otherwise(F.substring(date, 7, 2))
    first_of_month = F.concat_ws("-", year, F.lpad(month, 2, "0"), F.lit("01"))
    days = F.unix_date(first_of_month.try_cast("date")) + _int(day) - 1

    clock = F.split(F.substring_index(time, ".", 1), ":")
    fraction = F.get(F.split(time, r"\."), F.lit(1))
    nanos = _int(F.rpad(F.coalesce(fraction, F.lit("")), 9, "0"))
    seconds = (
        days * 86_400
        + _int(F.get(clock, F.lit(0))) * 3_600
        + _int(F.get(clock, F.lit(1))) * 60
        + _int(F.get(clock, F.lit(2)))
    )
    parsed = F.when(F.size(clock) == 3, seconds * NANOS_PER_SECOND + nanos)
    return F.when(time.rlike(r"\A[0-9]+\z"), _int(time)).otherwise(parsed)


def event_time(ts_ns: Column) -> Column:
    """Event time at whole seconds, as the stream's time column."""
    # Integer division: a double cannot hold epoch nanoseconds exactly.
    return F.timestamp_seconds(F.call_function("div", ts_ns, F.lit(NANOS_PER_SECOND)))


def bar_time(end: Column) -> Column:
    """Timestamp of a served bar's end; text that is no time gives null."""
    return F.try_to_timestamp(end)


def indicator_time(time: Column) -> Column:
    """Timestamp of a served indicator: epoch milliseconds first, then text."""
    return F.coalesce(
        F.timestamp_millis(time.try_cast("bigint")), F.try_to_timestamp(time)
    )


def utc_clock(time: Column) -> Column:
    """A timestamp's UTC clock as a zoneless time, whatever the session's zone."""
    seconds = F.unix_micros(time).cast("decimal(20,0)") / F.lit(1_000_000).cast("decimal(10,0)")
    zero, unit = F.lit(0), seconds.cast("decimal(18,6)")
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return epoch + F.make_dt_interval(zero, zero, zero, unit)
