"""Date helpers."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F


def local_date(ts: Column | str, timezone: str) -> Column:
    """Calendar day of a UTC instant in the given zone."""
    ts = F.col(ts) if isinstance(ts, str) else ts
    return F.to_date(F.from_utc_timestamp(ts.cast("timestamp"), timezone))


def month_ends(first: Column, last: Column) -> Column:
    """All month-end days d with first <= d <= last, as an array."""
    starts = F.sequence(F.trunc(first, "month"), F.trunc(last, "month"), F.expr("interval 1 month"))
    return F.filter(F.transform(starts, F.last_day), lambda d: (d >= first) & (d <= last))


def day(value: date) -> Column:
    return F.lit(value).cast("date")
