"""Date arithmetic and cyclic date encodings."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from claimlens.functions.text import _col

# Days per month as the encoders count them (February is always 29).
MONTH_DAYS = {1: 31, 2: 29, 3: 31, 4: 30, 5: 31, 6: 30, 7: 31, 8: 31, 9: 30, 10: 31, 11: 30, 12: 31}


def back(c: Column | str, years: int = 0, months: int = 0) -> Column:
    """Timestamp moved back by calendar years/months; keeps the time, clamps to month end."""
    return _col(c) - F.make_ym_interval(F.lit(years), F.lit(months))


def day_gap(start: Column | str, end: Column | str) -> Column:
    """Midnights crossed between two dates."""
    return F.datediff(_col(end), _col(start))


def age_years(birth: Column | str, at: Column | str) -> Column:
    """Whole years as days over 365, truncated toward zero."""
    return (day_gap(birth, at) / 365).cast("int")


def period(c: Column | str) -> Column:
    return F.date_format(_col(c), "yyyyMM")


def day_literal(yyyymmdd: str) -> Column:
    """``'20240601'`` as a zone-less timestamp."""
    return F.to_timestamp_ntz(F.lit(yyyymmdd), F.lit("yyyyMMdd"))


def now_to_second() -> Column:
    return F.date_trunc("second", F.current_timestamp())


def month_days(c: Column | str) -> Column:
    """Days of the month of a date, from the fixed table."""
    pairs = [F.lit(v) for item in MONTH_DAYS.items() for v in item]
    return F.element_at(F.create_map(*pairs), F.month(_col(c)))


def _turn(position: Column, last: Column | int) -> Column:
    return F.lit(2) * F.pi() * (position - 1) / last


def month_angle(c: Column | str) -> Column:
    return _turn(F.month(_col(c)), 11)


def day_angle(c: Column | str) -> Column:
    return _turn(F.dayofmonth(_col(c)), month_days(c) - 1)


def settlement_lag(service: Column | str, settled: Column | str) -> Column:
    """Days from service to settlement in units of 60 days."""
    return day_gap(service, settled) / 60
