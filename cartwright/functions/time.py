"""Time rules. ``as_of`` is always an argument: no query reads the wall clock."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, functions as F

AsOf = str | dt.date | dt.datetime


def as_of_timestamp(as_of: AsOf) -> Column:
    return F.lit(as_of).cast("timestamp")


def coerce_ts(c: Column) -> Column:
    """ISO text to timestamp (zone suffix allowed), NULL when it does not parse.

    Text without a date part is refused first, as Spark would complete a bare
    time with today's date.
    """
    return F.when(c.rlike(r"^\s*[0-9]{4}"), F.try_to_timestamp(c))


def parse_ts(c: Column, as_of: AsOf) -> Column:
    return F.coalesce(coerce_ts(c), as_of_timestamp(as_of))


def coerce_date(c: Column) -> Column:
    return F.to_date(coerce_ts(c))


def order_date(ts: Column) -> Column:
    return F.to_date(ts)


def order_hour(ts: Column) -> Column:
    return F.hour(ts)


def tenure_days(signup: Column, as_of: AsOf) -> Column:
    """Whole days since signup; 0 for a missing or future signup."""
    days = F.datediff(F.to_date(as_of_timestamp(as_of)), signup)
    return F.greatest(F.coalesce(days, F.lit(0)), F.lit(0))


def to_utc(c: Column, zone: str) -> Column:
    """Wall-clock time of ``zone`` to the UTC instant (session zone is UTC)."""
    return F.to_utc_timestamp(c, zone)


def iso_text(ts: Column) -> Column:
    """ISO 8601 text; microseconds appear only when there are any."""
    whole = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss")
    fraction = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    return F.when(F.unix_micros(ts) % 1_000_000 == 0, whole).otherwise(fraction)
