"""Period and category filters, written so the fact scan is pruned.

An ISO-week predicate (``weekofyear(d) = 10``) cannot be pushed into a
Parquet scan, a date range can.  ``where_periods`` therefore emits the
Monday..Sunday range that covers the chosen periods (pushed down to the
scan's row-group statistics) *and* the exact semi-join on (year, week).
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weekmart.functions.dates import iso_week, iso_year

KEYS = ["year_num", "week_num"]


def with_period(df: DataFrame, date_col: str) -> DataFrame:
    """Stamp ISO ``year_num`` / ``week_num`` taken from ``date_col``."""
    return df.withColumn("year_num", iso_year(date_col)).withColumn("week_num", iso_week(date_col))


def collect_periods(periods) -> list[tuple[int, int]]:
    """The distinct periods as a sorted list of pairs: one per calendar week at
    most, however many rows the frame has."""
    if isinstance(periods, (list, tuple)):
        pairs = periods
    else:
        pairs = [(r[0], r[1]) for r in periods.select(*KEYS).distinct().collect()]
    return sorted({(int(y), int(w)) for y, w in pairs if y is not None and w is not None})


def period_bounds(pairs: list[tuple[int, int]]) -> tuple[_dt.date, _dt.date] | None:
    """First Monday and last Sunday of a period list."""
    days = []
    for y, w in pairs:
        try:
            days.append(_dt.date.fromisocalendar(y, w, 1))
        except ValueError:
            continue
    if not days:
        return None
    return min(days), max(days) + _dt.timedelta(days=6)


def date_range(df: DataFrame, date_col: str, lo: _dt.date, hi: _dt.date) -> DataFrame:
    """``lo <= date_col < hi + 1 day`` with literals of the column's own type,
    so the comparison reaches the scan as a pushed filter."""
    dtype = df.schema[date_col].dataType
    end = hi + _dt.timedelta(days=1)
    if isinstance(dtype, (T.TimestampNTZType, T.TimestampType)):
        # Text literals cast to the column's type: no trip through the
        # Python process's time zone.
        a = F.lit(f"{lo.isoformat()} 00:00:00").cast(dtype)
        b = F.lit(f"{end.isoformat()} 00:00:00").cast(dtype)
    else:
        a, b = F.lit(lo), F.lit(end)
    c = F.col(date_col)
    return df.where((c >= a) & (c < b))


def period_key(year="year_num", week="week_num"):
    """(year, week) packed into one integer, e.g. 2000-03 -> 200003."""
    y = F.col(year) if isinstance(year, str) else year
    w = F.col(week) if isinstance(week, str) else week
    return y * 100 + w


def where_periods(df: DataFrame, periods, date_col: str | None = None) -> DataFrame:
    """Rows whose (year_num, week_num) is in ``periods``.

    ``periods`` (a DataFrame or a list of pairs) is resolved once to its
    bounded list.  The filter is the covering date range -- pushed into the
    scan -- plus an exact IN-set on the packed period key (no join)."""
    pairs = collect_periods(periods)
    if not pairs:
        return df.where(F.lit(False))
    if date_col is not None:
        lo, hi = period_bounds(pairs) or (None, None)
        if lo is None:
            return df.where(F.lit(False))
        df = date_range(df, date_col, lo, hi)
    return df.where(period_key().isin([y * 100 + w for y, w in pairs]))


def where_category(df: DataFrame, column: str, value: str | None) -> DataFrame:
    """Optional equality filter; empty means no filter.  The value travels as
    a literal, never spliced into text, so quotes in it need no escaping."""
    if not value:
        return df
    return df.where(F.col(f"`{column}`") == F.lit(value))
