import pytest
from pyspark.sql import functions as F

from weekmart.sinks.base import fan_out
from tests.doubles import FailingSink, FlakyTransport
from weekmart.sinks.deliver import DeliverySink, TransportError, send_with_retry
from weekmart.sinks.table import TableSink

SCHEMA = "a long, s string, year_num int, week_num int"


def rows(t):
    return sorted(tuple(r) for r in t.read().collect())


def test_upsert_replaces_only_touched_periods(spark, scratch):
    t = TableSink(spark, "t_upsert_" + scratch.rsplit("-", 1)[-1], location=f"{scratch}/t")
    first = spark.createDataFrame([(1, "x", 2000, 1), (2, "y", 2000, 2)], SCHEMA)
    t.upsert(first)
    t.upsert(first)
    assert rows(t) == [(1, "x", 2000, 1), (2, "y", 2000, 2)]
    second = spark.createDataFrame([(9, "q", 2000, 2)], SCHEMA)
    assert t.upsert(second) == 1
    assert t.upsert(second) == 1
    assert rows(t) == [(1, "x", 2000, 1), (9, "q", 2000, 2)]
    t.upsert(spark.createDataFrame([], SCHEMA))   # empty touches nothing
    assert rows(t) == [(1, "x", 2000, 1), (9, "q", 2000, 2)]


def test_delete_evolve_widen_insert(spark, scratch):
    t = TableSink(spark, "t_misc_" + scratch.rsplit("-", 1)[-1], location=f"{scratch}/t")
    t.upsert(spark.createDataFrame([(1, "x", 2000, 1), (2, "y", 2000, 2)], SCHEMA))
    t.delete_period(2000, 1)
    assert rows(t) == [(2, "y", 2000, 2)]
    t.upsert(spark.createDataFrame([(3, "z", 1.5, 2000, 3)], "a long, s string, extra double, year_num int, week_num int"))
    assert "extra" in t.schema().fieldNames()
    t.upsert(spark.createDataFrame([("2000-01-05", "d", 2000, 4)], "a string, s string, year_num int, week_num int"))
    assert dict((r.week_num, r.a) for r in t.read().collect())[4] == 36530   # date text -> serial
    t.upsert(spark.createDataFrame([("abc", "w", 2000, 5)], "a string, s string, year_num int, week_num int"))
    assert t.schema()["a"].dataType.simpleString() == "string"
    assert sorted(r.a for r in t.read().collect()) == ["2", "3", "36530", "abc"]


def test_insert_keeps_known_columns(spark, scratch):
    t = TableSink(spark, "t_ins_" + scratch.rsplit("-", 1)[-1], location=f"{scratch}/t", evolve=False)
    t.setup(spark.createDataFrame([], SCHEMA))
    n = t.insert(spark.createDataFrame([(1, "x", "junk", 2000, 1)], "a long, s string, z string, year_num int, week_num int"))
    assert n == 1 and t.schema().fieldNames() == ["a", "s", "year_num", "week_num"]


def test_fan_out_isolates_failures(spark, scratch):
    df = spark.createDataFrame([(1, "x", 2000, 1)], SCHEMA)
    t = TableSink(spark, "t_fan_" + scratch.rsplit("-", 1)[-1], location=f"{scratch}/t")
    st = {r.sink: (r.status, r.rows) for r in fan_out(df, [FailingSink("down"), t]).collect()}
    assert st["down"] == ("error", 0)
    assert st[t.name] == ("ok", 1)


def test_retry_policy(tmp_path):
    flaky = FlakyTransport(str(tmp_path), [503, 503])
    import io
    import pyarrow as pa
    import pyarrow.parquet as pq
    buf = io.BytesIO()
    pq.write_table(pa.table({"a": [1, 2]}), buf)
    assert send_with_retry(flaky, "k", buf.getvalue(), backoff=0) == (2, 3)
    bad = FlakyTransport(str(tmp_path), [400])
    with pytest.raises(TransportError):
        send_with_retry(bad, "k2", buf.getvalue(), backoff=0)
    assert bad.calls["k2"] == 1
    always = FlakyTransport(str(tmp_path), [503, 503, 503])
    with pytest.raises(TransportError):
        send_with_retry(always, "k3", buf.getvalue(), backoff=0)
    assert always.calls["k3"] == 3


def test_delivery_sink_end_to_end(spark, scratch):
    df = spark.createDataFrame([(i, "x", 2000, 1 + i % 3) for i in range(30)], SCHEMA)
    sink = DeliverySink(spark, transport=FlakyTransport(f"{scratch}/drop", [503, 429]), backoff=0,
                        receipts=f"{scratch}/r.json")
    assert sink.upsert(df) == 30
    assert {r["attempts"] for r in sink.receipts()} == {3}
    back = spark.read.option("recursiveFileLookup", "true").parquet(f"{scratch}/drop")
    assert back.count() == 30


def test_delivery_replaces_periods_whatever_the_task_layout(spark, scratch):
    df = spark.createDataFrame([(i, "x", 2000, 1 + i % 3) for i in range(30)], SCHEMA)
    sink = DeliverySink(spark, path=f"{scratch}/drop", backoff=0)
    sink.upsert(df.repartition(7))
    sink.upsert(df.coalesce(1))
    read = lambda: spark.read.option("pathGlobFilter", "*.parquet").option(
        "recursiveFileLookup", "true").parquet(f"{scratch}/drop")
    assert read().count() == 30
    sink.upsert(df.where("week_num = 2").limit(4))
    assert {r.week_num: r["count"] for r in read().groupBy("week_num").count().collect()} == \
        {1: 10, 2: 4, 3: 10}


def test_columns_match_whatever_their_case(spark, scratch):
    from pyspark.sql import types as T

    from weekmart.functions.values import coerce
    from weekmart.operators.columns import align_columns
    t = TableSink(spark, "t_case_" + scratch.rsplit("-", 1)[-1], location=f"{scratch}/t")
    t.upsert(spark.createDataFrame([("x", 1, 2000, 1)], "name string, qty long, year_num int, week_num int"))
    t.upsert(spark.createDataFrame([("y", 2, 2000, 2)], "Name string, QTY int, Year_Num int, WEEK_NUM int"))
    t.insert(spark.createDataFrame([("z", 3, 2000, 2)], "NAME string, qTy long, year_num int, week_num int"))
    assert rows(t) == [("x", 1, 2000, 1), ("y", 2, 2000, 2), ("z", 3, 2000, 2)]
    assert t.schema().fieldNames() == ["name", "qty", "year_num", "week_num"]
    both = spark.createDataFrame([(1, 2, 3)], "A long, a long, b long")
    target = T.StructType.fromDDL("a string, B double")
    assert [r.asDict() for r in align_columns(both, target).collect()] == [{"a": 2, "B": 3}]
    assert [r.asDict() for r in coerce(both, target).collect()] == [{"a": "2", "B": 3.0}]


def test_week_files_match_whatever_their_case(spark, scratch):
    import os

    from weekmart.sources.period_files import backfill, read_period_files
    from weekmart.streaming.load import stream_load
    root = f"{scratch.removeprefix('file:')}/src"
    os.makedirs(f"{root}/2000")
    with open(f"{root}/2000/2000-01.csv", "w") as f:
        f.write("Name;Qty\na;1\n")
    with open(f"{root}/2000/2000-02.csv", "w") as f:
        f.write("QTY;NAME\n2;b\n")
    want = [("a", 1, 2000, 1), ("b", 2, 2000, 2)]
    t = TableSink(spark, "t_casef_" + scratch.rsplit("-", 1)[-1], location=f"{scratch}/t")
    assert {r.status for r in backfill(spark, root, t, "csv", schema="name string, qty long").collect()} == {"ok"}
    assert rows(t) == want
    s = TableSink(spark, "t_cases_" + scratch.rsplit("-", 1)[-1], location=f"{scratch}/s")
    stream_load(spark, root, s, f"{scratch}/ck", "name string, qty long", "csv").awaitTermination()
    assert rows(s) == want
    p = f"{scratch}/pq"
    spark.createDataFrame(want, "Name string, QTY long, year_num int, week_num int") \
        .write.partitionBy("year_num", "week_num").parquet(p)
    got = read_period_files(spark, p, "parquet", schema="name string, qty long")
    assert sorted(tuple(r) for r in got.collect()) == want and got.columns[:2] == ["name", "qty"]
