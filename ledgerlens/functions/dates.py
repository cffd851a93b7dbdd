"""Calendar expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .numeric import int_div


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def _minute_index(ts: Column) -> Column:
    """Minutes since 1970-01-01 00:00 of a naive timestamp, from its calendar
    fields (``timestampdiff``/``date_trunc`` would go through the session time
    zone and shift inside daylight-saving gaps)."""
    days = F.datediff(F.to_date(ts), F.lit("1970-01-01").cast("date")).cast("bigint")
    return days * 1440 + F.hour(ts) * 60 + F.minute(ts)


def minute_boundaries(start, end) -> Column:
    """Minute boundaries crossed between two timestamps (not elapsed minutes):
    23:59:59 -> 00:00:00 counts 1."""
    return (_minute_index(_c(end)) - _minute_index(_c(start))).cast("int")


def day_bucket(anchor, d, width: int = 7) -> Column:
    """1-based bucket of ``width`` days counted from ``anchor`` (truncating division)."""
    return (int_div(F.datediff(_c(d), _c(anchor)), width) + 1).cast("int")


def week_of_year_bucket(d) -> Column:
    """7-day buckets from 1 January (1-7 Jan is 1), not ISO weeks: 2020-06-15 -> 24."""
    return (int_div(F.dayofyear(_c(d)) - 1, 7) + 1).cast("int")


def parse_short_date(col, fmt: str = "d/M/yy") -> Column:
    """Parse ``d/M/yy`` text (two-digit years are 20yy)."""
    return F.to_date(_c(col), fmt)


def weekday_name(d) -> Column:
    """Weekday name of a date or naive timestamp (formatted from the date, so
    no session time-zone conversion is involved)."""
    return F.date_format(F.to_date(_c(d)), "EEEE")


def month_name(d) -> Column:
    return F.date_format(F.to_date(_c(d)), "MMMM")


def weekday_number(d) -> Column:
    """Sunday = 1 ... Saturday = 7."""
    return F.dayofweek(_c(d))
