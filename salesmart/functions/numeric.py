"""Numeric helpers: money type, guarded ratios."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(14,2)"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def money(c: Column | str) -> Column:
    """Warehouse money type NUMERIC(14,2); rounds half away from zero."""
    return _col(c).cast(MONEY)


def as_double(c: Column | str) -> Column:
    return _col(c).cast("double")


def ratio(num: Column | str, den: Column | str) -> Column:
    """num / den as DOUBLE; NULL when the denominator is 0 or NULL.

    Covers ``CASE WHEN den <> 0 THEN num::numeric / den END``, ``NULLIF`` and
    DAX ``DIVIDE`` (zero denominator -> blank).  Bare ``/ 0`` would raise
    under ANSI mode.
    """
    d = as_double(den)
    return F.when(d != 0, as_double(num) / d)


def ratio_or_zero(num: Column | str, den: Column | str) -> Column:
    """Like :func:`ratio` but 0 instead of NULL (the ``ELSE 0`` shape)."""
    return F.coalesce(ratio(num, den), F.lit(0.0))
