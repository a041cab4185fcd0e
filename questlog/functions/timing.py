"""Boundary-counting time arithmetic on zone-less timestamps.

The differences below count calendar boundaries crossed (10:00:59 to 10:31:00
is 31 minutes), not elapsed time, and do not depend on the session time zone.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def minute_index(ts: Column) -> Column:
    """Whole minutes since 1970-01-01 00:00, rounded down."""
    days = F.unix_date(ts.cast("date")).cast("bigint")
    return days * 1440 + F.hour(ts) * 60 + F.minute(ts)


def _second_index(ts: Column) -> Column:
    return minute_index(ts) * 60 + F.second(ts)


def second_diff(start: Column, end: Column) -> Column:
    """Second boundaries between two timestamps."""
    return _second_index(end) - _second_index(start)


def minute_floor(ts: Column) -> Column:
    """The timestamp cut to its minute."""
    zero = F.lit(0)
    return ts - F.make_dt_interval(zero, zero, zero, F.extract(F.lit("SECOND"), ts))


def day_diff(start: Column, end: Column) -> Column:
    """Calendar days from ``start`` to ``end``."""
    return F.datediff(end, start).cast("bigint")
