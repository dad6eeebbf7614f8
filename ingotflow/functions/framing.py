"""The five-byte frame header (marker byte, four-byte schema id) in front of a record body."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

HEADER_BYTES = 5
MARKER = b"\x00"


def strip_header(value: Column) -> Column:
    """Drop the frame header; values too short or without the marker pass through, NULL stays NULL.

    Built-in binary functions only, so it stays inside whole-stage codegen.
    """
    framed = (F.length(value) >= HEADER_BYTES) & (F.substring(value, 1, 1) == F.lit(MARKER))
    return F.when(framed, value.substr(F.lit(HEADER_BYTES + 1), F.length(value))).otherwise(value)
