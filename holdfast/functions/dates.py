"""Whole-day arithmetic on timestamps.

There are two readings of "whole days between": truncated toward zero and
floored. They differ for negative spans (-12 hours: 0 and -1). ``datediff``
counts midnights and is neither.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F


def moment(when: datetime) -> Column:
    """A literal without zone: the same clock time in every session time zone."""
    return F.expr(f"TIMESTAMP_NTZ '{when.isoformat(sep=' ')}'")


def truncated_days(start: Column, end: Column) -> Column:
    return F.extract(F.lit("DAY"), end - start)


def floored_days(start: Column, end: Column) -> Column:
    days = truncated_days(start, end)
    overshoots = (start + F.make_dt_interval(days=days)) > end
    return days - overshoots.cast("int")


def parse_or_null(text: Column) -> Column:
    """Timestamp without zone; text that is no timestamp becomes NULL."""
    return text.try_cast("timestamp_ntz")
