"""Every registered query against its DuckDB oracle on the smallest tables
(the round driver runs the same comparison at sf0.01)."""

import pytest

from tests.oracle_check import check
from tests.conftest import SF_SMALL


def test_all_registered_queries(spark):
    res = check(spark, SF_SMALL, verbose=False)
    errors = {k: v["error"] for k, v in res.items() if "error" in v}
    assert not errors
    bad = [k for k, v in res.items()
           if v["oracle"] and not (v["rows_match"] and v["cols_match"] and v["hash_match"])]
    assert not bad


def test_entry_smoke(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    assert df.count() > 0
    assert "Реалізація_грн" in df.columns and "year_num" in df.columns


def test_queries_hold_under_a_foreign_session(spark):
    """The driver's session may differ: another time zone, ANSI off."""
    conf = spark.conf
    saved = {k: conf.get(k) for k in ("spark.sql.session.timeZone", "spark.sql.ansi.enabled")}
    conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    conf.set("spark.sql.ansi.enabled", "false")
    try:
        keys = ["weekly_sales", "period_filter", "with_period", "text_to_serial", "coerce_types"]
        res = check(spark, SF_SMALL, keys, verbose=False)
        assert all(v.get("hash_match") for v in res.values()), res
    finally:
        for k, v in saved.items():
            conf.set(k, v)
