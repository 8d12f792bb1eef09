import datetime as dt

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from weekmart.functions.dates import iso_week, iso_year, week_exists, week_monday
from weekmart.plans import periods as P


def pairs(df):
    return sorted((r.year_num, r.week_num) for r in df.collect())


def py_weeks(days):
    return sorted({d.isocalendar()[:2] for d in days})


def test_iso_year_ends(spark):
    df = spark.createDataFrame([(dt.date(2020, 12, 31),), (dt.date(2021, 1, 1),), (dt.date(2024, 12, 30),)], "d date")
    got = [(r.y, r.w) for r in df.select(iso_year("d").alias("y"), iso_week("d").alias("w")).collect()]
    assert got == [(2020, 53), (2020, 53), (2025, 1)]


def test_year_to_date_crosses_year(spark):
    assert pairs(P.year_to_date(spark, dt.date(2021, 1, 10))) == [(2020, 53), (2021, 1)]


def test_month_weeks(spark):
    assert pairs(P.weeks_in_month(spark, 2025, 2)) == [(2025, w) for w in range(5, 10)]


def test_quarter_bounds(spark):
    assert pairs(P.weeks_in_quarter(spark, 2025, 5)) == []
    q = pairs(P.weeks_in_quarter(spark, 2024, 4))
    assert q[0] == (2024, 40) and q[-1] == (2025, 1)


def test_last_quarter_from_q1(spark):
    assert pairs(P.last_quarter(spark, dt.date(2025, 2, 1))) == pairs(P.weeks_in_quarter(spark, 2024, 4))


def test_last_weeks_and_validation(spark):
    assert pairs(P.last_weeks(spark, dt.date(2021, 1, 6), 3)) == [(2020, 52), (2020, 53), (2021, 1)]
    assert pairs(P.last_weeks(spark, dt.date(2021, 1, 6), 0)) == []


def test_range_rollover_and_rules(spark):
    as_of = dt.date(2021, 6, 1)
    assert pairs(P.period_range(spark, "2020-52", "2021-02", as_of)) == \
        [(2020, 52), (2020, 53), (2021, 1), (2021, 2)]
    # a week 53 that does not exist is not invented
    assert pairs(P.period_range(spark, "2021-51", "2021-53", as_of)) == [(2021, 51), (2021, 52)]
    assert pairs(P.period_range(spark, "2021-05", "2021-01", as_of)) == []
    assert pairs(P.period_range(spark, "bad", "2021-01", as_of)) == []
    assert pairs(P.period_range(spark, "2010-01", "2010-05", as_of)) == []  # outside year bounds


def test_week_monday_round_trip(spark):
    df = spark.createDataFrame([(2020, 53), (2021, 53), (2026, 1)], "y int, w int")
    rows = df.select(week_monday("y", "w").alias("m"), week_exists("y", "w").alias("ok")).collect()
    assert rows[0].m == dt.date(2020, 12, 28) and rows[0].ok
    assert not rows[1].ok
    assert rows[2].m == dt.date(2025, 12, 29)


def test_resolve_precedence(spark):
    as_of = dt.date(2000, 3, 15)
    avail = P.last_weeks(spark, as_of, 200)
    got = pairs(P.resolve_periods(spark, as_of, avail, P.PeriodSpec(period="2000-01:2000-02"),
                                  P.PeriodSpec(rule="last-quarter")))
    assert got == [(2000, 1), (2000, 2)]
    got = pairs(P.resolve_periods(spark, as_of, avail, None, P.PeriodSpec(rule="last-month")))
    assert got == pairs(P.weeks_in_month(spark, 2000, 2))
    assert pairs(P.resolve_periods(spark, as_of, avail)) == [(2000, 11)]
    with pytest.raises(ValueError):
        P.resolve_periods(spark, as_of, avail, P.PeriodSpec(rule="last-weeks", period="2000-01:2000-02"))
    with pytest.raises(ValueError):
        P.resolve_periods(spark, as_of, avail, P.PeriodSpec(start="2000-01"))


def test_missing_and_available(spark):
    as_of = dt.date(2000, 3, 15)
    wanted = P.last_weeks(spark, as_of, 4)
    avail = P.last_weeks(spark, as_of, 2)
    assert pairs(P.keep_available(wanted, avail)) == [(2000, 10), (2000, 11)]
    assert pairs(P.missing_periods(wanted, avail)) == [(2000, 8), (2000, 9)]


@settings(max_examples=12, deadline=None)
@given(st.dates(min_value=dt.date(1995, 1, 1), max_value=dt.date(2035, 12, 31)))
def test_rules_match_python_isocalendar(spark, as_of):
    ytd = [dt.date(as_of.year, 1, 1) + dt.timedelta(days=i)
           for i in range((as_of - dt.date(as_of.year, 1, 1)).days + 1)]
    assert pairs(P.year_to_date(spark, as_of)) == py_weeks(ytd)
    first = as_of.replace(day=1)
    nxt = (first + dt.timedelta(days=32)).replace(day=1)
    month = [first + dt.timedelta(days=i) for i in range((nxt - first).days)]
    assert pairs(P.current_month(spark, as_of)) == py_weeks(month)
    assert pairs(P.last_weeks(spark, as_of, 5)) == py_weeks([as_of - dt.timedelta(weeks=i) for i in range(5)])


def _all_weeks(y0, y1):
    out = []
    for y in range(y0, y1 + 1):
        for w in range(1, 54):
            try:
                dt.date.fromisocalendar(y, w, 1)
            except ValueError:
                continue
            out.append((y, w))
    return out


@settings(max_examples=10, deadline=None)
@given(st.integers(2018, 2022), st.integers(1, 53), st.integers(0, 120))
def test_range_matches_brute_force(spark, y, w, span):
    as_of = dt.date(2021, 6, 1)
    weeks = _all_weeks(2017, 2023)
    start = (y, w)
    end_idx = min(len(weeks) - 1, next((i for i, p in enumerate(weeks) if p >= start), 0) + span)
    end = weeks[end_idx]
    label = lambda p: f"{p[0]}-{p[1]:02d}"
    got = pairs(P.period_range(spark, label(start), label(end), as_of))
    if start > end or start[0] < as_of.year - 3 or end[0] > as_of.year + 1:
        assert got == []
    else:
        assert got == [p for p in weeks if start <= p <= end]
