"""Calendar expressions (D1–D14).  Built-in functions only."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_date(c: Column | str, fmt: str) -> Column:
    """Text -> DATE, unparsable -> NULL (one leading blank allowed)."""
    return F.try_to_date(F.ltrim(_col(c)), fmt)


def month_start(d: Column | str) -> Column:
    """First day of the month as a DATE."""
    return F.trunc(_col(d), "month")


def month_end(d: Column | str) -> Column:
    """Last day of the month."""
    return F.last_day(_col(d))


def year_month(d: Column | str) -> Column:
    """D3: 'YYYY-MM'."""
    return F.date_format(_col(d), "yyyy-MM")


def month_name(d: Column | str) -> Column:
    """D3: abbreviated English month name ('Jan')."""
    return F.date_format(_col(d), "MMM")


def day_name_short(d: Column | str) -> Column:
    return F.date_format(_col(d), "E")


def day_name(d: Column | str) -> Column:
    return F.date_format(_col(d), "EEEE")


def day_of_week_sun0(d: Column | str) -> Column:
    """0 = Sunday .. 6 = Saturday."""
    return F.dayofweek(_col(d)) - 1


def iso_week(d: Column | str) -> Column:
    """ISO-8601 week number."""
    return F.weekofyear(_col(d))


def is_weekend(d: Column | str) -> Column:
    """Saturday or Sunday (weekday() is 0 for Monday)."""
    return F.weekday(_col(d)) >= 5


def month_index(d: Column | str) -> Column:
    """year*12 + month, for month differences."""
    return F.year(_col(d)) * 12 + F.month(_col(d))


def days_between(later: Column | str, earlier: Column | str) -> Column:
    """Integer day difference (``later - earlier``)."""
    return F.datediff(_col(later), _col(earlier))
