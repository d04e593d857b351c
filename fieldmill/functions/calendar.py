"""Dates, weekdays and epoch seconds."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Weekday labels, 1 is Monday.
DAY_NAMES = ("Mon", "Tue", "Wed", "Thu", "Fri", "Sat", "Sun")


def day_name(number: Column) -> Column:
    """Label of weekday 1-7; any other number, text or null gives null."""
    number = number.try_cast("int")
    labels = F.array(*[F.lit(day) for day in DAY_NAMES])
    return F.when(number.between(1, len(DAY_NAMES)), F.get(labels, number - 1))


def date_from_parts(year: Column, month: Column, day: Column) -> Column:
    """A date from its three parts; null when a part is missing or the date does not exist."""
    parts = [part.try_cast("int") for part in (year, month, day)]
    midnight = [F.lit(0), F.lit(0), F.lit(0)]
    return F.try_make_timestamp_ntz(*parts, *midnight).cast("date")


def epoch_to_timestamp(seconds: Column) -> Column:
    """Timestamp from unix seconds, given as number or text; unreadable text gives null."""
    return F.timestamp_seconds(seconds.try_cast("bigint"))
