"""Event times from message text, and the calendar columns derived from them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the strict message time format (needs a fractional second and an offset).
STRICT_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"
# How this package writes message times.
MESSAGE_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx"
# A full date and time. A bare time or year would be read as a day of today's calendar.
FULL = r"^\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}(:\d{2}([.]\d+)?)?(Z|[+-]\d{2}(:?\d{2})?)?$"


def event_time(text: Column, strict: bool = False) -> Column:
    """Message text to timestamp, null when unreadable. Full date-times are accepted with or without a
    fraction, ``Z`` or an offset; ``strict`` asks for the one fixed format."""
    if strict:
        return F.try_to_timestamp(text, F.lit(STRICT_FORMAT))
    return F.when(text.rlike(FULL), F.try_to_timestamp(text))


def time_or(text: Column, arrival: Column) -> Column:
    """Message time, or the arrival time when it is missing or unreadable."""
    return F.coalesce(event_time(text), arrival)


def message_text(time: Column) -> Column:
    return F.date_format(time, MESSAGE_FORMAT)


def day_of(time: Column) -> Column:
    return F.to_date(time)


def hour_of(time: Column) -> Column:
    return F.hour(time)
