"""Dates and timestamps."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: how far back an incremental run looks.
LOOKBACK_DAYS = 3


def year_month(day: Column) -> Column:
    return F.date_format(day, "yyyy-MM")


def days_between(later: Column, earlier: Column) -> Column:
    return F.datediff(later, earlier).cast("bigint")


def lookback_start(high_water: Column, days: int = LOOKBACK_DAYS) -> Column:
    return high_water - F.make_dt_interval(F.lit(days))


def as_day(value: dt.date | str) -> Column:
    """A run date given by the caller, so that a table does not depend on when it is built."""
    return F.lit(dt.date.fromisoformat(value) if isinstance(value, str) else value)


def as_instant(value: dt.datetime | str) -> Column:
    """A run timestamp given by the caller, read in UTC when it names no zone."""
    moment = dt.datetime.fromisoformat(value) if isinstance(value, str) else value
    if moment.tzinfo is None:
        moment = moment.replace(tzinfo=dt.timezone.utc)
    micros = (moment - dt.datetime(1970, 1, 1, tzinfo=dt.timezone.utc)) // dt.timedelta(microseconds=1)
    return F.timestamp_micros(F.lit(micros))
