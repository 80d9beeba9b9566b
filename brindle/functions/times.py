"""Timestamps without zone: event time for streams, and truncation that stays without zone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def event_time(c: Column) -> Column:
    """For watermarks, which want a zoned timestamp."""
    return c.cast("timestamp")


def trunc(unit: str, c: Column) -> Column:
    return F.date_trunc(unit, c).cast("timestamp_ntz")
