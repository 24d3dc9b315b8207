"""Timestamps, hours and run windows. Every bound comes from an explicit `as_of`, never a clock."""

from __future__ import annotations

from datetime import UTC, datetime, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F

ISO_FORMAT = "yyyy-MM-dd HH:mm:ss"


def utc(moment: datetime) -> Column:
    """A timestamp literal. Naive datetimes are UTC, as is the session time zone."""
    if moment.tzinfo is not None:
        moment = moment.astimezone(UTC)
    return F.lit(moment.strftime("%Y-%m-%d %H:%M:%S")).cast("timestamp")


def between(ts: Column, bounds: tuple[datetime, datetime]) -> Column:
    """Half-open range check that reaches the file scan."""
    return (ts >= utc(bounds[0])) & (ts < utc(bounds[1]))


def parse_utc(text: Column) -> Column:
    """ISO text to a timestamp of whole seconds; null where it cannot be parsed."""
    return F.date_trunc("second", F.try_to_timestamp(text))


def hour_of(ts: Column) -> Column:
    return F.date_trunc("hour", ts)


def on_the_hour(ts: Column) -> Column:
    return ts == F.date_trunc("hour", ts)


def format_utc(ts: Column) -> Column:
    return F.date_format(ts, ISO_FORMAT)


def naive_utc(when: datetime | None) -> datetime | None:
    """The same instant in UTC, without a time zone; a time without one is in UTC already."""
    if when is None or when.tzinfo is None:
        return when
    return when.astimezone(UTC).replace(tzinfo=None)


def _hour(as_of: datetime) -> datetime:
    return naive_utc(as_of).replace(minute=0, second=0, microsecond=0)


def lookback(as_of: datetime, hours_back: int = 24) -> tuple[datetime, datetime]:
    """Half-open range of the current hour and the ones before it."""
    return _hour(as_of) - timedelta(hours=hours_back - 1), _hour(as_of) + timedelta(hours=1)


def horizon(as_of: datetime, days_ahead: int = 7) -> tuple[datetime, datetime]:
    """Half-open range from the current hour on."""
    return _hour(as_of), _hour(as_of) + timedelta(hours=24 * days_ahead)


def calendar_horizon(as_of: datetime, days_ahead: int = 7) -> tuple[datetime, datetime]:
    """Half-open range of whole days, as a forecast request asks for."""
    day = naive_utc(as_of).replace(hour=0, minute=0, second=0, microsecond=0)
    return day, day + timedelta(days=days_ahead)


def hour_sequence(start: datetime, stop: datetime) -> Column:
    """Array of the whole hours in the half-open range."""
    return F.sequence(
        utc(start), utc(stop) - F.expr("INTERVAL 1 HOUR"), F.expr("INTERVAL 1 HOUR")
    )
