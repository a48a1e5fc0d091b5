"""Safe parsing and calendar arithmetic."""

from __future__ import annotations

from datetime import datetime, timedelta, timezone

from pyspark.sql import Column
from pyspark.sql import functions as F

SPACE_FORMAT = "yyyy-MM-dd HH:mm:ss"  # fixed value: how the sources write timestamps
_ISO = r"^\d{4}-\d{2}-\d{2}(T.*)?$"
_ISO_OR_SPACED = r"^\d{4}-\d{2}-\d{2}(T.*| \d{2}:\d{2}:\d{2})?$"


def _column(c: Column | str) -> Column:
    return F.col(f"`{c}`") if isinstance(c, str) else c


def parse_iso(c: Column | str) -> Column:
    """ISO-8601 text to timestamp, NULL for anything else.

    Spark also accepts bare times ("10:00:00" means today) and bare years, hence the shape test.
    """
    c = _column(c)
    return F.when(c.rlike(_ISO), F.try_to_timestamp(c))


def parse_any(c: Column | str) -> Column:
    """ISO-8601 first, then ``yyyy-MM-dd HH:mm:ss``; both shapes are read by the same cast."""
    c = _column(c)
    return F.when(c.rlike(_ISO_OR_SPACED), F.try_to_timestamp(c))


def parse_timestamp_safe(c: Column | str, out: str, parser=parse_iso) -> dict[str, Column]:
    """``{out: timestamp, out_parse_error: boolean}`` for ``withColumns`` or ``select``."""
    c = _column(c)
    parsed = parser(c)
    return {out: parsed, f"{out}_parse_error": parsed.isNull() & c.isNotNull()}


def date_or_null(c: Column | str) -> Column:
    """Calendar day of a timestamp string, NULL when it cannot be read."""
    return F.to_date(parse_any(c))


def dateadd(part: str, n: Column | int, ts: Column) -> Column:
    return F.timestamp_add(part.upper(), n if isinstance(n, Column) else F.lit(n), ts)


def date_trunc(part: str, ts: Column) -> Column:
    return F.date_trunc(part, ts)


# Length of the clock units in seconds, months per calendar unit.
_SECONDS = {"second": 1, "minute": 60, "hour": 3600}
_MONTHS = {"month": 1, "quarter": 3, "year": 12}
_DAYS = {"day": 1, "week": 7}


def datediff(part: str, start: Column, end: Column) -> Column:
    """Number of unit boundaries crossed between two timestamps (not complete units).

    Weeks start on Monday, as in ``date_trunc('week')``.
    """
    part = part.lower()
    if part in _SECONDS:
        step = _SECONDS[part]
        return F.floor(F.unix_seconds(end) / step) - F.floor(F.unix_seconds(start) / step)
    if part in _MONTHS:
        step = _MONTHS[part]

        def months(c: Column) -> Column:
            return F.floor((F.year(c) * 12 + F.month(c) - 1) / step)
        return months(end) - months(start)
    if part == "day":
        return F.datediff(end, start).cast("bigint")
    if part == "week":
        def weeks(c: Column) -> Column:  # day 0 (1970-01-01) was a Thursday
            return F.floor((F.unix_date(F.to_date(c)) + 3) / 7)
        return weeks(end) - weeks(start)
    raise ValueError(f"unknown date part {part!r}")


def complete_years(start: Column, end: Column) -> Column:
    """Whole years from ``start`` to ``end`` (an age)."""
    return F.timestamp_diff("YEAR", start.cast("timestamp"), end.cast("timestamp"))


def last_day(part: str, day: Column) -> Column:
    """Last day of the month, quarter or year."""
    part = part.lower()
    if part == "month":
        return F.last_day(day)
    return F.date_sub(F.add_months(F.trunc(day, part), _MONTHS[part]), 1)


def current_timestamp_utc() -> Column:
    return F.to_utc_timestamp(F.current_timestamp(), F.current_timezone())


def aware(at: datetime) -> datetime:
    """A Python time without zone is taken as UTC, not as local time of the driver's machine."""
    return at if at.tzinfo else at.replace(tzinfo=timezone.utc)


def utc(micros: int) -> datetime:
    """Microseconds since 1970 as a Python time in UTC."""
    return datetime(1970, 1, 1, tzinfo=timezone.utc) + timedelta(microseconds=micros)
