"""Explicit points in time and look-back ranges.

Every "now" of the source application becomes an explicit ``as_of`` literal, so results
are reproducible and backfills see the same windows as live runs.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def ts_lit(value) -> Column:
    """A TIMESTAMP_NTZ literal from a string, ``datetime`` or Column (UTC wall clock)."""
    if isinstance(value, Column):
        return value.cast("timestamp_ntz")
    if isinstance(value, dt.datetime):
        value = value.strftime("%Y-%m-%d %H:%M:%S.%f")
    return F.lit(str(value)).cast("timestamp_ntz")


def date_lit(value) -> Column:
    if isinstance(value, Column):
        return value.cast("date")
    return F.lit(str(value)).cast("date")


def minus(as_of, amount: int, unit: str) -> Column:
    """``as_of - INTERVAL amount unit`` (unit: SECOND, MINUTE, HOUR, DAY)."""
    return ts_lit(as_of) - F.expr(f"INTERVAL {int(amount)} {unit.upper()}")


def since(ts_col: str, as_of, amount: int, unit: str) -> Column:
    """``ts >= as_of - amount unit`` (closed at the start, open-ended)."""
    return F.col(ts_col) >= minus(as_of, amount, unit)


def trailing(ts_col: str, as_of, amount: int, unit: str) -> Column:
    """``as_of - amount unit < ts <= as_of`` (open start, inclusive end)."""
    c = F.col(ts_col)
    return (c > minus(as_of, amount, unit)) & (c <= ts_lit(as_of))


def half_open(ts_col: str, start, end) -> Column:
    """V9: ``start <= ts < end``."""
    c = F.col(ts_col)
    return (c >= ts_lit(start)) & (c < ts_lit(end))


def dates_between(date_col: str, d0, d1) -> Column:
    """``d0 <= date <= d1`` (closed on dates)."""
    return F.col(date_col).between(date_lit(d0), date_lit(d1))
