"""Reference periods: the month or year a run works on."""

from __future__ import annotations

from datetime import date, datetime, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F


def reference_date(now: datetime) -> date:
    """The day before ``now``: a run on the first of a month works on the month that has just ended."""
    return (now - timedelta(days=1)).date()


def period_path(root: str, when: date, grain: str = "month") -> str:
    """``root/YYYY/MM`` or ``root/YYYY``."""
    return f"{root.rstrip('/')}/{when:%Y/%m}" if grain == "month" else f"{root.rstrip('/')}/{when:%Y}"


def month_bounds(day: Column) -> tuple[Column, Column]:
    """First and last day of the month of a date column."""
    return F.trunc(day, "MM"), F.last_day(day)


def year_bounds(day: Column) -> tuple[Column, Column]:
    """First and last day of the year of a date column."""
    year = F.year(day)
    return F.make_date(year, F.lit(1), F.lit(1)), F.make_date(year, F.lit(12), F.lit(31))
