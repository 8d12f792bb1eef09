import gzip
import os

import pytest
import pandas as pd
from pyspark.sql import functions as F

from weekmart.sinks.files import export_csv
from weekmart.sinks.table import TableSink
from weekmart.sources.period_files import backfill, period_files, read_period_files


def _write_reference_layout(root):
    """<root>/<YYYY>/<YYYY-WW>.parquet: two years, one empty week, one
    name that does not match, one file with an extra column."""
    os.makedirs(f"{root}/2024", exist_ok=True)
    os.makedirs(f"{root}/2025", exist_ok=True)
    pd.DataFrame({"name": ["a", "b"], "qty": [1.0, 2.0]}).to_parquet(f"{root}/2024/2024-52.parquet")
    import pyarrow as pa
    import pyarrow.parquet as pq
    pq.write_table(pa.table({"name": pa.array([], pa.string()), "qty": pa.array([], pa.float64())}),
                   f"{root}/2025/2025-01.parquet")
    pd.DataFrame({"name": ["c"], "qty": [3.0], "extra": ["e"]}).to_parquet(f"{root}/2025/2025-02.parquet")
    pd.DataFrame({"name": ["z"], "qty": [9.0]}).to_parquet(f"{root}/2025/notes.parquet")


def test_reference_layout_listing_and_backfill(spark, scratch):
    root = scratch.removeprefix("file:") + "/src"
    _write_reference_layout(root)
    listing = period_files(spark, root, "parquet")
    assert [(r.year_num, r.week_num) for r in listing.collect()] == [(2024, 52), (2025, 1), (2025, 2)]
    assert period_files(spark, root, "parquet", year=2025, week=2).count() == 1
    rows = read_period_files(spark, root, "parquet")
    assert sorted(rows.columns) == ["extra", "name", "qty", "week_num", "year_num"]
    assert rows.count() == 3
    t = TableSink(spark, "t_bf_" + scratch.rsplit("-", 1)[-1], location=f"{scratch}/t")
    st = {(r.year_num, r.week_num): (r.rows, r.status) for r in backfill(spark, root, t, "parquet").collect()}
    assert st == {(2024, 52): (2, "ok"), (2025, 1): (0, "empty"), (2025, 2): (1, "ok")}
    assert t.read().count() == 3
    # an empty week file leaves that period's old rows alone and reports 'empty'
    t.upsert(spark.createDataFrame([("old", 5.0, 2025, 1)], "name string, qty double, year_num int, week_num int"))
    st = {(r.year_num, r.week_num): (r.rows, r.status) for r in backfill(spark, root, t, "parquet").collect()}
    assert st[(2025, 1)] == (0, "empty")
    assert t.read().count() == 4


def test_csv_export_quoting_and_compression(spark, scratch):
    df = spark.createDataFrame([("a;b", 1.5, 2000, 1), ('q"x', float("inf"), 2000, 2), (None, 3.0, 2000, 2)],
                               "s string, v double, year_num int, week_num int")
    path = scratch.removeprefix("file:")
    assert export_csv(df, f"{path}/min", sep=";") == 3
    text = "".join(open(os.path.join(dp, f)).read() for dp, _, fs in os.walk(f"{path}/min")
                   for f in fs if f.endswith(".csv"))
    assert '"a;b";1.5' in text and '"q""x";' in text
    export_csv(df, f"{path}/nn", sep=";", quoting="nonnumeric")
    text = "".join(open(os.path.join(dp, f)).read() for dp, _, fs in os.walk(f"{path}/nn")
                   for f in fs if f.endswith(".csv"))
    assert '"s";"v"' in text and '"a;b";1.5' in text
    export_csv(df, f"{path}/gz", sep=";", compression="gzip")
    gz = [os.path.join(dp, f) for dp, _, fs in os.walk(f"{path}/gz") for f in fs if f.endswith(".csv.gz")]
    assert gz and all(gzip.open(p).read() for p in gz)
    back = read_period_files(spark, f"{path}/min", "csv", schema="s string, v double")
    assert sorted((r.week_num, r.v if r.v is not None else -1.0) for r in back.collect()) == [(1, 1.5), (2, -1.0), (2, 3.0)]


def test_csv_backfill_reads_each_file_by_its_own_header(spark, scratch):
    root = scratch.removeprefix("file:") + "/csvsrc"
    os.makedirs(f"{root}/2024", exist_ok=True)
    os.makedirs(f"{root}/2025", exist_ok=True)
    pd.DataFrame({"name": ["a", "b"], "qty": [1.0, 2.0]}).to_csv(f"{root}/2024/2024-52.csv", sep=";", index=False)
    open(f"{root}/2025/2025-01.csv", "w").write("name;qty\n")                      # empty week
    pd.DataFrame({"qty": [3.0], "name": ["c"], "extra": ["e"]}).to_csv(        # other order + extra column
        f"{root}/2025/2025-02.csv", sep=";", index=False)
    pd.DataFrame({"name": ["z"], "qty": [9.0]}).to_csv(f"{root}/2025/readme.csv", sep=";", index=False)
    rows = read_period_files(spark, root, "csv")
    got = sorted((r.year_num, r.week_num, r.name, r.qty, r.extra) for r in rows.collect())
    assert got == [(2024, 52, "a", 1.0, None), (2024, 52, "b", 2.0, None), (2025, 2, "c", 3.0, "e")]


def test_parquet_second_reader_when_schemas_do_not_merge(spark, scratch):
    root = scratch.removeprefix("file:") + "/pqsrc"
    os.makedirs(f"{root}/2025", exist_ok=True)
    pd.DataFrame({"name": ["a"], "qty": [1.0]}).to_parquet(f"{root}/2025/2025-01.parquet")
    # an empty week whose text column carries no type (null) cannot be merged
    pd.DataFrame({"name": pd.Series([], dtype=object), "qty": pd.Series([], dtype=float)}).to_parquet(
        f"{root}/2025/2025-02.parquet")
    pd.DataFrame({"name": ["c"], "qty": [3.0], "extra": ["e"]}).to_parquet(f"{root}/2025/2025-03.parquet")
    rows = read_period_files(spark, root, "parquet")
    got = sorted((r.week_num, r.name, r.extra) for r in rows.collect())
    assert got == [(1, "a", None), (3, "c", "e")]


def test_backfill_matches_columns_by_name_and_reports_bad_files(spark, scratch):
    from weekmart.sinks.table import TableSink
    root = scratch.removeprefix("file:") + "/named"
    os.makedirs(f"{root}/2025", exist_ok=True)
    open(f"{root}/2025/2025-01.csv", "w").write("name;qty;price\na;1;2.5\n")
    open(f"{root}/2025/2025-02.csv", "w").write("name;price;qty;more\nb;20.5;3;x\n")
    with gzip.open(f"{root}/2025/2025-03.csv.gz", "wt") as f:
        f.write("qty;name\n7;c\n")
    schema = "name string, qty int, price double"
    got = sorted(tuple(r) for r in read_period_files(spark, root, "csv", schema).collect())
    assert got == [("a", 1, 2.5, 2025, 1), ("b", 3, 20.5, 2025, 2), ("c", 7, None, 2025, 3)]

    root = scratch.removeprefix("file:") + "/broken"
    os.makedirs(f"{root}/2025", exist_ok=True)
    for week in (1, 2):
        pd.DataFrame({"name": ["a"], "qty": [week]}).to_parquet(f"{root}/2025/2025-0{week}.parquet")
    open(f"{root}/2025/2025-03.parquet", "wb").write(b"not parquet at all")
    with pytest.raises(OSError):
        read_period_files(spark, root, "parquet")
    t = TableSink(spark, "t_broken_" + scratch.rsplit("-", 1)[-1], location=f"{scratch}/tb")
    status = {r.week_num: (r.rows, r.status) for r in backfill(spark, root, t, "parquet").collect()}
    assert status[1] == (1, "ok") and status[2] == (1, "ok")
    assert status[3][0] == 0 and status[3][1].startswith("error: ")
    assert t.read().count() == 2


def test_backfill_counts_nothing_when_the_sink_fails(spark, scratch):
    class Refusing:
        def upsert(self, df):
            raise RuntimeError("down")

    root = scratch.removeprefix("file:") + "/refused"
    os.makedirs(f"{root}/2025", exist_ok=True)
    open(f"{root}/2025/2025-01.csv", "w").write("name\na\n")
    rows = backfill(spark, root, Refusing(), "csv", "name string").collect()
    assert [(r.rows, r.status) for r in rows] == [(0, "error: RuntimeError: down")]
