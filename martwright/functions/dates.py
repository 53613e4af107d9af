"""Calendar, clock and time-zone helpers."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date, datetime

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def iso_week(day: Column | str) -> Column:
    """ISO week name such as ``2021-W53``."""
    day = _col(day)
    year = F.date_part(F.lit("yearofweek"), day).cast("string")
    return F.concat(year, F.lit("-W"), F.lpad(F.weekofyear(day).cast("string"), 2, "0"))


def time_of(ts: Column | str) -> Column:
    """Clock time ``HH:mm:ss`` of a timestamp."""
    return F.date_format(_col(ts), "HH:mm:ss")


def at_day(day: str | date) -> Column:
    """A date literal."""
    return F.lit(day if isinstance(day, str) else day.isoformat()).cast("date")


def datetime_of(value: str | datetime) -> Column:
    """A timestamp literal without zone."""
    return F.lit(value if isinstance(value, str) else value.isoformat(sep=" ")).cast("timestamp_ntz")


def previous_month_of(day: str | date) -> tuple[int, int]:
    """(year, month) of the calendar month before ``day``; a driver-side constant."""
    value = date.fromisoformat(day) if isinstance(day, str) else day
    return (value.year - 1, 12) if value.month == 1 else (value.year, value.month - 1)


def now_ms(now: str | datetime | None = None) -> Column:
    """Epoch milliseconds of a given UTC time, or of the current batch."""
    if now is None:
        return F.unix_millis(F.current_timestamp())
    text = now if isinstance(now, str) else now.isoformat(sep=" ")
    return F.unix_millis(F.lit(f"{text}+00:00").cast("timestamp"))


def from_ms(ms: Column | str) -> Column:
    """Epoch milliseconds as a UTC time without zone, whatever the session's zone is."""
    return F.lit("1970-01-01").cast("timestamp_ntz") + F.make_dt_interval(secs=_col(ms) / F.lit(1000).cast("decimal(18,6)"))


def local_time(
    ts: Column | str, city: Column | str, zones: Mapping[str, str], default_zone: str
) -> Column:
    """UTC time shown on the clock of a city; cities without a zone use the default zone."""
    zone = F.lit(default_zone)
    if zones:
        pairs = [F.lit(x) for pair in sorted(zones.items()) for x in pair]
        zone = F.coalesce(F.try_element_at(F.create_map(*pairs), _col(city)), zone)
    return F.from_utc_timestamp(_col(ts).cast("timestamp"), zone).cast("timestamp_ntz")
