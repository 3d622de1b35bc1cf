"""Date expressions shared by the jobs."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

SAO_PAULO = "America/Sao_Paulo"


def date_col(value: dt.date | str | Column) -> Column:
    """A date literal (``date`` or ISO text), or the given column as a date."""
    if isinstance(value, Column):
        return value.cast("date")
    if isinstance(value, str):
        value = dt.date.fromisoformat(value)
    return F.lit(value)


def local_date(ts: Column | str, tz: str = SAO_PAULO) -> Column:
    """Calendar date of a UTC timestamp in ``tz``; the session time zone must be UTC."""
    return F.to_date(F.from_utc_timestamp(ts, tz))


def local_date_between(ts: str, start: dt.date, end: dt.date, tz: str = SAO_PAULO) -> Column:
    """``start <= local_date(ts) <= end``, as a range on the bare column.

    The bounds are the UTC times of the local midnights, folded to literals, so that the
    range reaches the file statistics and no row is converted.
    """
    def utc_midnight(d: dt.date) -> Column:
        return F.to_utc_timestamp(F.lit(d), tz).cast("timestamp_ntz")

    return (F.col(ts) >= utc_midnight(start)) & (F.col(ts) < utc_midnight(end + dt.timedelta(days=1)))


def quarter_start(d: Column) -> Column:
    return F.to_date(F.trunc(d, "quarter"))


def week_start(d: Column) -> Column:
    """Sunday on or before ``d`` (``date_trunc('week')`` would give Monday)."""
    return F.date_sub(d, F.dayofweek(d) - 1)


def weeks_between(later: Column, earlier: Column) -> Column:
    """Number of Sunday-started weeks from ``earlier`` to ``later``."""
    return (F.datediff(week_start(later), week_start(earlier)) / 7).cast("long")
