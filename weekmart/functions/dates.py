"""ISO-week and serial-day column functions."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# Day 0 of the spreadsheet serial calendar, and the text form
# of a period (four-digit ISO year, dash, two-digit ISO week).
SERIAL_EPOCH = _dt.date(1899, 12, 30)
PERIOD_LABEL_FORMAT = "%d-%02d"
PERIOD_LABEL_PATTERN = r"^(\d{4})-(\d{2})$"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def iso_year(c) -> Column:
    """ISO-8601 week-numbering year (2021-01-01 -> 2020)."""
    return F.extract(F.lit("YEAROFWEEK"), F.to_date(_c(c))).cast("int")


def iso_week(c) -> Column:
    """ISO-8601 week number 1..53."""
    return F.weekofyear(F.to_date(_c(c))).cast("int")


def week_monday(year, week) -> Column:
    """Monday of ISO week (year, week): the week holding 4 January, plus w-1 weeks."""
    jan4 = F.make_date(_c(year), F.lit(1), F.lit(4))
    return F.date_add(F.trunc(jan4, "week"), (_c(week) - 1) * 7)


def week_exists(year, week) -> Column:
    """True when (year, week) names a real ISO week (week 53 only in long years)."""
    monday = week_monday(year, week)
    return (_c(week) >= 1) & (iso_year(monday) == _c(year)) & (iso_week(monday) == _c(week))


def period_label(year, week) -> Column:
    """(2000, 3) -> '2000-03'."""
    return F.format_string(PERIOD_LABEL_FORMAT, _c(year), _c(week))


def parse_period_label(c) -> tuple[Column, Column]:
    """'2000-03' -> (2000, 3); anything else -> (null, null)."""
    c = _c(c)
    ok = c.rlike(PERIOD_LABEL_PATTERN)
    y = F.when(ok, F.regexp_extract(c, PERIOD_LABEL_PATTERN, 1).cast("int"))
    w = F.when(ok, F.regexp_extract(c, PERIOD_LABEL_PATTERN, 2).cast("int"))
    return y, w


def date_serial(c) -> Column:
    """Date or timestamp -> whole days since 1899-12-30 (time of day dropped)."""
    return F.datediff(F.to_date(_c(c)), F.lit(SERIAL_EPOCH)).cast("long")
