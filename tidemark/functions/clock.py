"""Time expressions. A tick carries event time in epoch milliseconds; everything is UTC."""

from __future__ import annotations

from datetime import datetime, timedelta, timezone

from pyspark.sql import Column
from pyspark.sql import functions as F

HOURLY = "yyyy-MM-dd-HH"
DAILY = "yyyy-MM-dd"

_STRFTIME = {HOURLY: "%Y-%m-%d-%H", DAILY: "%Y-%m-%d"}
_LENGTH = {HOURLY: timedelta(hours=1), DAILY: timedelta(days=1)}


def event_time(millis: Column) -> Column:
    """Exact, where dividing by 1000 can lose a microsecond in the double."""
    return F.timestamp_millis(millis)


def exact_millis(ts: Column) -> Column:
    return F.unix_millis(ts)


def whole_second_millis(ts: Column) -> Column:
    """Epoch milliseconds with the sub-second part floored away."""
    return F.unix_seconds(ts) * F.lit(1000)


def clock_text(ts: Column) -> Column:
    return F.date_format(ts, "HH:mm:ss")


def as_utc(moment: datetime) -> datetime:
    """Naive datetimes are taken as UTC."""
    if moment.tzinfo is None:
        return moment.replace(tzinfo=timezone.utc)
    return moment.astimezone(timezone.utc)


def instant(moment: datetime) -> Column:
    """A timestamp literal that does not depend on the driver's or the session's zone."""
    since_epoch = as_utc(moment) - datetime(1970, 1, 1, tzinfo=timezone.utc)
    return F.timestamp_micros(F.lit(since_epoch // timedelta(microseconds=1)).cast("bigint"))


def lookback_start(now: datetime, minutes: float) -> datetime:
    return as_utc(now) - timedelta(minutes=minutes)


def partition_key(ts: Column, pattern: str) -> Column:
    """Partition value of a time, in UTC whatever the session's zone; sorts in time order."""
    seconds = F.unix_seconds(ts)
    days = F.floor(seconds / F.lit(86400)).cast("int")
    day = F.date_from_unix_date(days).cast("string")
    if pattern == DAILY:
        return day
    hour = F.floor(F.pmod(seconds, F.lit(86400)) / F.lit(3600)).cast("string")
    return F.concat(day, F.lit("-"), F.lpad(hour, 2, "0"))


def partition_key_of(moment: datetime, pattern: str) -> str:
    return as_utc(moment).strftime(_STRFTIME[pattern])
