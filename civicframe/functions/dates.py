"""Dates, zones and durations."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def parse_time(x: Column, fmt: str | None = None) -> Column:
    """Text to a zone-free timestamp; bad text becomes null."""
    parsed = F.try_to_timestamp(x, F.lit(fmt)) if fmt else F.try_to_timestamp(x)
    return parsed.cast("timestamp_ntz")


def localise(x: Column, zone: str) -> Column:
    """Read a zone-free time as local time in ``zone`` and give the UTC time."""
    return F.convert_timezone(F.lit(zone), F.lit("UTC"), x)


def iso_weekday(x: Column) -> Column:
    return F.weekday(x) + 1


def is_weekend(x: Column) -> Column:
    return F.weekday(x) >= 5


def minutes(seconds: Column) -> Column:
    return seconds / 60.0
