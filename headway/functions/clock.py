"""Clock strings ``HH:MM:SS`` whose hour may pass 24, and the calendar parts of a timestamp."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def _field(clock: Column, number: int) -> Column:
    # A missing part is an empty string, and try_cast makes it NULL; ANSI mode would fail the job instead.
    return F.split_part(clock, F.lit(":"), F.lit(number)).try_cast("int")


def clock_to_seconds(clock: Column) -> Column:
    """Seconds since the service day's midnight; NULL for a malformed string."""
    return _field(clock, 1) * 3600 + _field(clock, 2) * 60 + _field(clock, 3)


def clock_hour(clock: Column) -> Column:
    """Hour of the service day, not wrapped at 24."""
    return _field(clock, 1)


def _two_digits(number: Column) -> Column:
    # Far cheaper than format_string, which builds a Java formatter for every row.
    text = number.cast("string")
    return F.when(number < 10, F.concat(F.lit("0"), text)).otherwise(text)


def seconds_to_clock(seconds: Column) -> Column:
    """Inverse of :func:`clock_to_seconds`; hours run past 24."""
    seconds = seconds.cast("int")
    minute = F.lit(60)
    minutes = F.floor(seconds / 60).cast("int")
    hours = F.floor(seconds / 3600).cast("int")
    return F.concat_ws(
        ":", _two_digits(hours), _two_digits(F.pmod(minutes, minute)), _two_digits(F.pmod(seconds, minute))
    )


def snapshot_date_in(path: Column) -> Column:
    """First ISO date in a file path, empty string when there is none."""
    return F.regexp_extract(path, r"(\d{4}-\d{2}-\d{2})", 1)
