import datetime as dt

import pytest

from tests.conftest import SF_SMALL
from weekmart.plans import periods as P
from weekmart.run import run_weekly_export
from tests.doubles import FailingSink
from weekmart.sinks.files import ExportSpec
from weekmart.sinks.table import TableSink


def test_export_spec_formats():
    assert ExportSpec(fmt="both").file_formats() == ["csv", "parquet"]
    assert ExportSpec(fmt="both", force_csv_only=True).file_formats() == ["csv"]
    assert ExportSpec(fmt="table").file_formats() == []
    with pytest.raises(NotImplementedError):
        ExportSpec(fmt="xlsx").file_formats()


def test_whole_run(spark, scratch):
    table = TableSink(spark, "t_run_" + scratch.rsplit("-", 1)[-1], location=f"{scratch}/t")
    spec = ExportSpec(fmt="both", root=f"{scratch}/out", sinks=[table, FailingSink("down")])
    run = run_weekly_export(spark, SF_SMALL, dt.date(2000, 3, 15), None,
                            P.PeriodSpec(rule="last-month"), spec=spec)
    weeks = sorted((r.year_num, r.week_num) for r in run.periods.collect())
    assert weeks and all(y == 2000 for y, _ in weeks)
    status = {r.sink: r.status for r in run.sinks.collect()}
    assert status == {table.name: "ok", "down": "error"}
    m = {(r.year_num, r.week_num): r.row_count for r in run.manifest.collect()}
    assert sum(m.values()) == run.result.count() == table.read().count()
    fmts = {r.format for r in run.files.collect()}
    assert fmts == {"csv", "parquet"}
