"""Date and time expressions."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import let

# Staff time-zone labels and the IANA zones they stand for.
# Unknown or NULL labels fall back to UTC.
ZONE_NAMES = {
    "Eastern": "America/New_York",
    "Central": "America/Chicago",
    "Mountain": "America/Denver",
    "Pacific": "America/Los_Angeles",
    "Hawaii": "Pacific/Honolulu",
}

ISO_UTC_FORMAT = "yyyy-MM-dd'T'HH:mm:ss'Z'"


def to_date(d) -> dt.date:
    if isinstance(d, dt.datetime):
        return d.date()
    if isinstance(d, dt.date):
        return d
    return dt.date.fromisoformat(str(d))


def month_to_yesterday(as_of) -> tuple[dt.date, dt.date]:
    """Reporting range: first day of ``as_of``'s month to the day before ``as_of``.

    On the 1st of a month the range is empty (start > end).
    """
    d = to_date(as_of)
    return d.replace(day=1), d - dt.timedelta(days=1)


def day_list(start, end) -> list[dt.date]:
    """Inclusive list of days, empty when start > end (parameter-sized, built on the driver)."""
    s, e = to_date(start), to_date(end)
    return [s + dt.timedelta(days=i) for i in range((e - s).days + 1)]


def ts_literal(d) -> Column:
    """Midnight of a date (or a datetime) as a TIMESTAMP_NTZ literal.

    Built from text, so the wall-clock value does not depend on the
    session or the Python process time zone."""
    if not isinstance(d, dt.datetime):
        d = dt.datetime.combine(to_date(d), dt.time())
    return F.lit(d.isoformat(sep=" ")).cast("timestamp_ntz")


def date_bucket(col: Column, level: str | None) -> Column:
    """``date_trunc`` to day / ISO week (Monday) / month, as a DATE.

    Any other level (or NULL) truncates to the day.
    """
    unit = {"daily": "day", "weekly": "week", "monthly": "month"}.get(level, "day")
    return F.date_trunc(unit, col).cast("date")


def zone_name(label: Column) -> Column:
    expr = None
    for k, v in ZONE_NAMES.items():
        expr = (F.when(label == k, F.lit(v)) if expr is None else expr.when(label == k, F.lit(v)))
    return expr.otherwise(F.lit("UTC"))


def local_to_utc(local_ts: Column, zone: Column) -> Column:
    """Local wall-clock TIMESTAMP_NTZ in ``zone`` to a UTC TIMESTAMP_NTZ.

    An ambiguous wall time (the repeated hour when clocks fall back) is
    read as standard time, i.e. the later instant; a skipped wall time
    moves forward.  ``convert_timezone`` alone picks the earlier instant,
    so the later one is used whenever it maps back to the same wall time.
    """

    def standard(u):
        later = u + F.expr("INTERVAL 1 HOUR")
        return F.when(F.convert_timezone(F.lit("UTC"), zone, later) == local_ts, later).otherwise(u)

    return let(F.convert_timezone(zone, F.lit("UTC"), local_ts), standard)


def iso_utc_text(ts: Column) -> Column:
    return F.date_format(ts, ISO_UTC_FORMAT)


# The interval units that PostgreSQL reads, with their spellings,
# and what one is worth: (calendar months, microseconds).
UNITS = {
    "microsecond": (0, 1), "millisecond": (0, 1_000), "second": (0, 1_000_000), "minute": (0, 60_000_000),
    "hour": (0, 3_600_000_000), "day": (0, 86_400_000_000), "week": (0, 604_800_000_000), "month": (1, 0),
    "year": (12, 0), "decade": (120, 0), "century": (1_200, 0), "millennium": (12_000, 0),
}
UNIT_SPELLINGS = {
    "microsecond": "us usec usecs usecond useconds microsecon microsecond microseconds",
    "millisecond": "ms msec msecs msecond mseconds millisecon millisecond milliseconds",
    "second": "s sec secs second seconds",
    "minute": "m min mins minute minutes",
    "hour": "h hr hrs hour hours",
    "day": "d day days",
    "week": "w week weeks",
    "month": "mon mons month months",
    "year": "y yr yrs year years",
    "decade": "dec decs decade decades",
    "century": "c cent century centuries",
    "millennium": "mil mils millennia millennium",
}
# Days of a month and of a year when an interval is measured as
# an elapsed span.
MONTH_DAYS, YEAR_DAYS = 30, 365.25
DAY_US = 86_400_000_000


def _worth(unit: Column, of) -> Column:
    """``of(months, microseconds)`` of the unit that the text stands for; NULL
    for no unit.  A lookup in a constant map."""
    pairs = [F.lit(x) for name, spellings in UNIT_SPELLINGS.items() for s in spellings.split() for x in (s, of(*UNITS[name]))]
    return F.try_element_at(F.create_map(*pairs).cast("map<string,bigint>"), F.lower(F.trim(unit)))


def span_us(unit: Column) -> Column:
    """Microseconds of one unit as an elapsed span; NULL for no unit."""
    return _worth(unit, lambda months, us: us + int(months // 12 * YEAR_DAYS * DAY_US + months % 12 * MONTH_DAYS * DAY_US))


def unit_months(unit: Column) -> Column:
    return _worth(unit, lambda months, _: months)


def unit_us(unit: Column) -> Column:
    return _worth(unit, lambda _, us: us)


def add_units(ts: Column, count: Column, months: Column, us: Column) -> Column:
    """``ts`` plus ``count`` units of ``months`` calendar months (clamped to month
    end) or of ``us`` microseconds.  NULL for no unit."""
    by_month = F.timestamp_add("MONTH", (count * months).cast("int"), ts)
    return F.when(months > 0, by_month).otherwise(F.timestamp_add("MICROSECOND", count * us, ts))
