"""ISO-week period algebra.

Every rule takes an ``as_of`` date (the reference point that a live run
takes from the clock) and returns a DataFrame ``(year_num int, week_num
int)`` built by Spark from a date ``sequence``.  A period set is bounded by
its rule (a month touches at most 6 weeks, a quarter 15, a year 54, a range
its own length), which is what makes broadcasting it safe.
"""

from __future__ import annotations

import datetime as _dt
import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from weekmart.functions.dates import (
    PERIOD_LABEL_PATTERN, iso_week, iso_year, week_monday,
)

PERIOD_SCHEMA = "year_num int, week_num int"
KEYS = ["year_num", "week_num"]

# Names of the automatic period rules.
RULES = (
    "last-weeks", "current-month", "last-month", "current-quarter",
    "last-quarter", "year-to-date", "rolling-weeks",
)


def empty_periods(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], PERIOD_SCHEMA)


def _weeks_of(days: Column, spark: SparkSession) -> DataFrame:
    """Distinct ISO (year, week) of an array-of-dates column."""
    return (
        spark.range(1)
        .select(F.explode(days).alias("d"))
        .select(iso_year("d").alias("year_num"), iso_week("d").alias("week_num"))
        .distinct()
    )


def _days_between(start: Column, stop: Column) -> Column:
    return F.sequence(start, stop)


def last_weeks(spark: SparkSession, as_of: _dt.date, n: int) -> DataFrame:
    """The week of ``as_of`` and the n-1 weeks before it (n >= 1)."""
    if n is None or n < 1:
        return empty_periods(spark)
    steps = F.sequence(F.lit(0), F.lit(n - 1))
    days = F.transform(steps, lambda i: F.date_sub(F.lit(as_of), i * 7))
    return _weeks_of(days, spark)


rolling_weeks = last_weeks


def _month_days(first: Column) -> Column:
    return _days_between(first, F.last_day(first))


def weeks_in_month(spark: SparkSession, year: int, month: int) -> DataFrame:
    """Every ISO week with at least one day in the month."""
    if not 1 <= month <= 12:
        return empty_periods(spark)
    return _weeks_of(_month_days(F.make_date(F.lit(year), F.lit(month), F.lit(1))), spark)


def weeks_in_quarter(spark: SparkSession, year: int, quarter: int) -> DataFrame:
    """Union of the weeks of the quarter's three months, de-duplicated."""
    if quarter not in (1, 2, 3, 4):
        return empty_periods(spark)
    first = (quarter - 1) * 3 + 1
    out = weeks_in_month(spark, year, first)
    for m in (first + 1, first + 2):
        out = out.union(weeks_in_month(spark, year, m))
    return out.distinct()


def current_month(spark: SparkSession, as_of: _dt.date) -> DataFrame:
    return _weeks_of(_month_days(F.trunc(F.lit(as_of), "month")), spark)


def last_month(spark: SparkSession, as_of: _dt.date) -> DataFrame:
    return _weeks_of(_month_days(F.trunc(F.add_months(F.lit(as_of), -1), "month")), spark)


def current_quarter(spark: SparkSession, as_of: _dt.date) -> DataFrame:
    return weeks_in_quarter(spark, as_of.year, (as_of.month - 1) // 3 + 1)


def last_quarter(spark: SparkSession, as_of: _dt.date) -> DataFrame:
    q = (as_of.month - 1) // 3 + 1
    year, q = (as_of.year - 1, 4) if q == 1 else (as_of.year, q - 1)
    return weeks_in_quarter(spark, year, q)


def year_to_date(spark: SparkSession, as_of: _dt.date) -> DataFrame:
    """From the ISO week holding 1 January (possibly week 52/53 of the year
    before) up to the week of ``as_of``."""
    return _weeks_of(_days_between(F.trunc(F.lit(as_of), "year"), F.lit(as_of)), spark)


def current_week(spark: SparkSession, as_of: _dt.date) -> DataFrame:
    return _weeks_of(F.array(F.lit(as_of)), spark)


def parse_label(text: str) -> tuple[int, int] | None:
    m = re.match(PERIOD_LABEL_PATTERN, (text or "").strip())
    if not m:
        return None
    y, w = int(m.group(1)), int(m.group(2))
    return (y, w) if 1 <= w <= 53 else None


def period_range(spark: SparkSession, start: str, end: str, as_of: _dt.date) -> DataFrame:
    """Manual range 'YYYY-WW' .. 'YYYY-WW', both ends included, rolling over
    at week 52/53.  Bad text, start after end, or years outside
    [as_of.year-3, as_of.year+1] give an empty set."""
    a, b = parse_label(start), parse_label(end)
    if a is None or b is None or a > b:
        return empty_periods(spark)
    if a[0] < as_of.year - 3 or b[0] > as_of.year + 1:
        return empty_periods(spark)
    mondays = F.sequence(week_monday(F.lit(a[0]), F.lit(a[1])),
                         week_monday(F.lit(b[0]), F.lit(b[1])),
                         F.expr("INTERVAL 7 DAYS"))
    weeks = _weeks_of(mondays, spark)
    lo = (F.col("year_num") > a[0]) | ((F.col("year_num") == a[0]) & (F.col("week_num") >= a[1]))
    hi = (F.col("year_num") < b[0]) | ((F.col("year_num") == b[0]) & (F.col("week_num") <= b[1]))
    return weeks.where(lo & hi)


def apply_rule(spark: SparkSession, rule: str, as_of: _dt.date, n: int | None = None) -> DataFrame:
    if rule in ("last-weeks", "rolling-weeks"):
        return sort_periods(last_weeks(spark, as_of, n or 0))
    table = {
        "current-month": current_month, "last-month": last_month,
        "current-quarter": current_quarter, "last-quarter": last_quarter,
        "year-to-date": year_to_date,
    }
    if rule not in table:
        raise ValueError(f"unknown period rule {rule!r}; expected one of {RULES}")
    return sort_periods(table[rule](spark, as_of))


# -- set operations against the weeks that hold data -------------------------

def keep_available(periods: DataFrame, available: DataFrame) -> DataFrame:
    """Requested periods that have data (semi-join).  ``available`` holds at
    most one row per calendar week of the data's span, so it is broadcast."""
    return periods.join(F.broadcast(available.select(*KEYS)), KEYS, "left_semi")


def missing_periods(periods: DataFrame, available: DataFrame) -> DataFrame:
    """Requested periods without data (anti-join)."""
    return periods.join(F.broadcast(available.select(*KEYS)), KEYS, "left_anti")


def intersect_periods(periods: DataFrame, available: DataFrame) -> DataFrame:
    return periods.select(*KEYS).intersect(available.select(*KEYS))


def sort_periods(periods: DataFrame) -> DataFrame:
    """Periods in calendar order (a handful of rows: one per week)."""
    return periods.orderBy(*KEYS)


# -- resolver -----------------------------------------------------------------

@dataclass
class PeriodSpec:
    """One source of period choice (command line, profile or configuration).
    Inside one spec: a rule beats a range, a range beats start/end."""
    rule: str | None = None
    n: int | None = None
    period: str | None = None          # 'YYYY-WW:YYYY-WW'
    start: str | None = None
    end: str | None = None

    def is_set(self) -> bool:
        return bool(self.rule or self.period or self.start or self.end)

    def validate(self) -> None:
        chosen = sum(bool(x) for x in (self.rule, self.period, self.start or self.end))
        if chosen > 1:
            raise ValueError("only one period choice may be given")
        if bool(self.start) != bool(self.end):
            raise ValueError("start and end go together")
        if self.rule in ("last-weeks", "rolling-weeks") and (self.n is None or self.n < 1):
            raise ValueError(f"{self.rule} needs n >= 1")
        if self.rule and self.rule not in RULES:
            raise ValueError(f"unknown period rule {self.rule!r}")


def resolve_periods(spark: SparkSession, as_of: _dt.date, available: DataFrame,
                    *specs: PeriodSpec | None) -> DataFrame:
    """Pick the periods of a run.  ``specs`` are given in precedence order
    (command line, profile, configuration); the first one that is set wins.
    Result: requested periods that hold data.  With nothing set, the ISO week
    of ``as_of`` is used (no fallback when a choice was made but is empty)."""
    for spec in specs:
        if spec is None or not spec.is_set():
            continue
        spec.validate()
        if spec.rule:
            wanted = apply_rule(spark, spec.rule, as_of, spec.n)
        elif spec.period:
            if ":" not in spec.period:
                raise ValueError("period must look like YYYY-WW:YYYY-WW")
            a, b = spec.period.split(":", 1)
            wanted = period_range(spark, a, b, as_of)
        else:
            wanted = period_range(spark, spec.start, spec.end, as_of)
        return sort_periods(keep_available(wanted, available))
    return current_week(spark, as_of)
