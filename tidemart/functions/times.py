"""Conversions between epoch numbers, timestamps and date-time texts."""

from pyspark.sql import Column
from pyspark.sql import functions as F

# Text formats of days and date-times, and the offset at which
# date-time texts are read back to epoch milliseconds.
DAY_FORMAT = "yyyy-MM-dd"
DATETIME_FORMAT = "yyyy-MM-dd HH:mm:ss"
TEXT_OFFSET = "+08:00"


def day_of_text(text: Column) -> Column:
    """Day of a date-time text; unreadable text gives null."""
    parsed = F.try_to_timestamp(text, F.lit(DATETIME_FORMAT))
    return F.date_format(parsed, DAY_FORMAT)


def event_time(seconds: Column) -> Column:
    """Timestamp of epoch seconds."""
    return F.timestamp_seconds(seconds)


def day_of_millis(millis: Column) -> Column:
    """Day of epoch milliseconds in the session time zone."""
    return F.date_format(F.timestamp_millis(millis), DAY_FORMAT)


def datetime_of_millis(millis: Column) -> Column:
    """Date-time text of epoch milliseconds in the session time zone."""
    return F.date_format(F.timestamp_millis(millis), DATETIME_FORMAT)


def millis_of_text(text: Column, offset: str = TEXT_OFFSET) -> Column:
    """Epoch milliseconds of a date-time text written at a fixed offset."""
    stamped = F.concat(text, F.lit(offset))
    return F.unix_millis(F.try_to_timestamp(stamped, F.lit(DATETIME_FORMAT + "XXX")))


def processing_time() -> Column:
    return F.current_timestamp()
