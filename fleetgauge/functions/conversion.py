"""Conversions of raw values: bad input becomes NULL, also in ANSI mode."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

# Seconds of 0001-01-01 and 9999-12-31 23:59:59 UTC, the range of a Spark timestamp.
MIN_EPOCH_SECONDS = -62135596800
MAX_EPOCH_SECONDS = 253402300799


def to_double(text: Column) -> Column:
    return text.try_cast("double")


def to_whole_number(text: Column, type_name: str = "bigint") -> Column:
    """Whole number of a text. A decimal part is cut off ("2015.0" is 2015)."""
    without_fraction = F.regexp_replace(text, r"\.[0-9]*\s*$", "")
    return F.coalesce(text.try_cast(type_name), without_fraction.try_cast(type_name))


def to_time(text: Column) -> Column:
    return text.try_cast("timestamp")


def to_day(text: Column) -> Column:
    return text.try_cast("date")


def epoch_to_time(seconds: Column) -> Column:
    """Timestamp of epoch seconds; NULL outside the years 1 to 9999."""
    in_range = seconds.between(MIN_EPOCH_SECONDS, MAX_EPOCH_SECONDS)
    return F.timestamp_seconds(F.when(in_range, seconds))


def moment(as_of: datetime | str | Column | None) -> Column:
    """The time a job stamps on its rows: ``as_of``, or now if it is None."""
    if as_of is None:
        return F.current_timestamp()
    if isinstance(as_of, Column):
        return as_of
    return F.lit(as_of).cast("timestamp")
