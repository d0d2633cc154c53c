"""Date and time expressions. The session time zone is pinned to UTC."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from almanac.functions.util import col_of


def parse_date(c, fmt: str | None = None) -> Column:
    c = col_of(c)
    return F.to_date(c, fmt) if fmt else F.to_date(c)


def week_end_monday(d) -> Column:
    """pandas ``Grouper(freq="W-MON")`` label: the week ends on Monday,
    right-closed and right-labelled (Sun -> next Mon, Mon -> same Mon)."""
    return F.next_day(F.date_sub(col_of(d), 1), "MON")


def epoch_ms_to_date(ms, tz: str = "UTC") -> Column:
    """Epoch milliseconds -> calendar day in ``tz`` (midnight-normalised)."""
    ts = F.timestamp_millis(col_of(ms))
    if tz != "UTC":
        ts = F.from_utc_timestamp(ts, tz)
    return F.to_date(ts)


def run_date(run_ts, tz: str = "UTC", minus_days: int = 0) -> Column:
    """The run's calendar day in ``tz`` (optionally minus days)."""
    d = F.to_date(F.from_utc_timestamp(col_of(run_ts), tz))
    return F.date_sub(d, minus_days) if minus_days else d


def vintage_of(run_ts) -> Column:
    """Vintage = run time floored to the hour."""
    return F.date_trunc("HOUR", col_of(run_ts))


def date_shift(d, days: int) -> Column:
    return F.date_add(col_of(d), days)
