"""Small column expressions shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

HOUR_BUCKET = ["year", "month", "day", "hour"]


def event_time(name: str, data_type: T.DataType) -> Column:
    """An event-time column as a timestamp: longs are epoch milliseconds, the rest is cast.

    The cast is lenient (unreadable text gives NULL), as with ANSI mode off.
    """
    column = F.col(name)
    if isinstance(data_type, T.LongType):
        return F.timestamp_millis(column)
    return column.try_cast("timestamp")


def hour_bucket(timestamp: Column) -> dict[str, Column]:
    """Zero-padded ``year``, ``month``, ``day`` and ``hour`` of a message time in UTC.

    Taken from the epoch seconds, so the session's time zone has no say.
    """
    seconds = F.unix_seconds(timestamp)
    day = F.date_from_unix_date(F.floor(seconds / 86_400).cast("int"))
    hour = F.floor(F.pmod(seconds, F.lit(86_400)) / 3600)
    return dict(zip(HOUR_BUCKET, [F.lpad(part.cast("string"), width, "0") for part, width in (
        (F.year(day), 4), (F.month(day), 2), (F.day(day), 2), (hour, 2))]))


def line_total(quantity: Column, unit_price: Column) -> Column:
    return F.round(quantity * unit_price, 2)
