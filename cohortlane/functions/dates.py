"""Day arithmetic, day windows and date texts.

Day bounds are DATE literals compared with the raw column.  Spark folds the
literal to the column's type (date, timestamp or timestamp_ntz), so the filter
reaches the scan instead of hiding behind a cast of the column.
"""

from __future__ import annotations

import datetime as dt
from zoneinfo import ZoneInfo

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import strip


def day(d: dt.date) -> Column:
    return F.lit(d.isoformat()).cast("date")


def day_diff(later: Column, earlier: Column) -> Column:
    return F.datediff(later, earlier)


def on_day(c: Column, d: dt.date) -> Column:
    return (c >= day(d)) & (c < day(d + dt.timedelta(days=1)))


def before_day(c: Column, d: dt.date) -> Column:
    return c < day(d)


def lookback(c: Column, as_of: dt.date, n: int, until: dt.date | None = None) -> Column:
    """On or after ``as_of - n`` days; open above unless ``until`` (exclusive) is given."""
    lower = c >= day(as_of - dt.timedelta(days=n))
    return lower if until is None else lower & (c < day(until))


def between_days(c: Column, first: dt.date, last: dt.date) -> Column:
    """Calendar days ``first`` to ``last``, both included."""
    return (c >= day(first)) & (c < day(last + dt.timedelta(days=1)))


def latest_of(*c: Column) -> Column:
    return F.greatest(*c)


def shift_zone(c: Column, zone: str) -> Column:
    """A UTC timestamp as the zone's clocks showed it at that moment."""
    return F.from_utc_timestamp(c, zone)


def _offset(zone: str, at: dt.datetime) -> dt.timedelta:
    """The zone's offset at a local time."""
    return at.replace(tzinfo=ZoneInfo(zone)).utcoffset()


def tz_bounds(as_of: dt.date, zone: str, mode: str = "literal") -> tuple[dt.datetime, dt.datetime]:
    """UTC bounds of "yesterday".

    ``literal`` adds the zone offset to UTC midnight (00:00 + 05:30 for India);
    ``local_day`` is the calendar day as the zone's inhabitants see it.  Each bound has
    the offset of its own midnight, so a day on which clocks change has 23 or 25 hours.
    """
    sign = {"literal": 1, "local_day": -1}[mode]
    upper = dt.datetime(as_of.year, as_of.month, as_of.day)
    lower = upper - dt.timedelta(days=1)
    return lower + sign * _offset(zone, lower), upper + sign * _offset(zone, upper)


def tz_window(c: Column, as_of: dt.date, zone: str, mode: str = "literal") -> Column:
    lower, upper = tz_bounds(as_of, zone, mode)
    return (c >= F.lit(lower.isoformat(" "))) & (c < F.lit(upper.isoformat(" ")))


# Accepted date texts, tried in this order (shape, Spark pattern).
DATE_FORMATS = (
    (r"^\d{4}-\d{1,2}-\d{1,2}$", "yyyy-M-d"),
    (r"^\d{1,2}-\d{1,2}-\d{4}$", "d-M-yyyy"),
    (r"^\d{1,2}/\d{1,2}/\d{4}$", "d/M/yyyy"),
    (r"^\d{1,2}/\d{1,2}/\d{4}$", "M/d/yyyy"),
    (r"^\d{1,2} [A-Za-z]{3} \d{4}$", "d MMM yyyy"),
    (r"^\d{1,2} [A-Za-z]+ \d{4}$", "d MMMM yyyy"),
    (r"^\d{4}/\d{1,2}/\d{1,2}$", "yyyy/M/d"),
)
_ISO = (
    r"^(\d{4})-?(\d{2})-?(\d{2})"
    r"(.([01]\d|2[0-3])(:?[0-5]\d(:?[0-5]\d([.,]\d+)?)?)?(Z|[+-]\d{2}(:?\d{2})?)?)?$"
)


def parse_date_multi(c: Column) -> Column:
    """First format that fits wins, so ``5/1/2024`` is the fifth of January; then ISO texts.

    The cheap shape test in front of each parser keeps texts that cannot fit from
    running into a parser exception.
    """
    text = F.regexp_replace(strip(c.cast("string")), r"\s+", " ")
    attempts = [F.when(text.rlike(shape), F.try_to_date(text, pattern)) for shape, pattern in DATE_FORMATS]
    iso = F.when(text.rlike(_ISO), F.regexp_replace(text, _ISO, "$1-$2-$3"))
    return F.coalesce(*attempts, F.try_to_date(iso, "yyyy-MM-dd"))
