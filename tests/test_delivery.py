"""A delivery leaves one copy, whatever is sent, run or stopped twice."""

import pytest
from pyspark.sql import types as T

from tests.doubles import FlakyTransport, FolderStore
from weekmart.sinks import deliver
from weekmart.sinks.deliver import (
    DeliverySink, DirectoryTransport, delivered_files, fitted_value, read_delivered, schema_changes,
)

SCHEMA = "qty long, name string, year_num int, week_num int"


def frame(spark, weeks=3, n=30, by=1):
    return spark.createDataFrame([(i * by, "x", 2000, 1 + i % weeks) for i in range(n)], SCHEMA)


def test_a_payload_sent_twice_after_a_lost_answer_counts_once(spark, scratch):
    store = FolderStore(scratch.removeprefix("file:") + "/store", "t",
                        {"qty": "BIGINT", "name": "BIGINT", "year_num": "BIGINT", "week_num": "BIGINT"},
                        lost_commits=1)
    sink = DeliverySink(spark, transport=store, backoff=0)
    assert sink.upsert(frame(spark).repartition(4)) == 30
    assert sorted(r["qty"] for r in store.rows()) == list(range(30))
    log = store.statements()
    # Staging first; the swap twice, as its answer was lost; the staging table goes last.
    assert log[0][0].startswith('CREATE TABLE IF NOT EXISTS "t__') and "delivery_token" in log[0][0]
    swaps = [g for g in log if g[0] == "BEGIN TRANSACTION"]
    assert len(swaps) == 2 and swaps[0] == swaps[1] and swaps[0][-1] == "COMMIT"
    assert [s.split()[0] for s in swaps[0][1:-1]] == ["DELETE"] * 3 + ["INSERT"]
    assert log[-1][0].startswith('DROP TABLE IF EXISTS "t__')
    assert ["ROLLBACK"] in log
    assert any('ALTER COLUMN "name" TYPE VARCHAR' in s for g in log for s in g)


def test_only_what_a_task_reports_is_published(spark, scratch):
    """A task that ran twice stored its payload twice; its first files go."""
    schema = T.StructType.fromDDL(SCHEMA)
    import io

    import pyarrow as pa
    import pyarrow.parquet as pq
    buf = io.BytesIO()
    pq.write_table(pa.table({"qty": [1, 2]}), buf)
    first, second = (DirectoryTransport(f"{scratch}/drop", "r1") for _ in range(2))
    first.send("2000-01/part-0", buf.getvalue())
    first.send("2000-01/part-1", buf.getvalue())
    second.send("2000-01/part-0", buf.getvalue())
    assert delivered_files(f"{scratch}/drop") == {}
    second.publish(schema, [{"key": "2000-01/part-0", "token": second.token("2000-01/part-0")}])
    assert read_delivered(spark, f"{scratch}/drop").count() == 2
    plain = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet")
    assert plain.parquet(f"{scratch}/drop").count() == 2


@pytest.mark.parametrize("broken", ["_put", "_remove"])
def test_a_crash_in_the_commit_leaves_one_whole_state(spark, scratch, monkeypatch, broken):
    drop = f"{scratch}/drop"
    DeliverySink(spark, path=drop, backoff=0).upsert(frame(spark))
    schema = T.StructType.fromDDL(SCHEMA)
    import io

    import pyarrow as pa
    import pyarrow.parquet as pq
    buf = io.BytesIO()
    pq.write_table(pa.table({"qty": pa.array([7], pa.int64()), "name": ["y"], "year_num": pa.array([2000], pa.int32()),
                             "week_num": pa.array([1], pa.int32())}), buf)
    t = DirectoryTransport(drop, "r2")
    t.send("2000-01/part-0", buf.getvalue())
    receipt = [{"key": "2000-01/part-0", "token": t.token("2000-01/part-0")}]

    def stop(*_):
        raise RuntimeError("crash")

    with monkeypatch.context() as m:
        m.setattr(deliver, broken, stop)
        with pytest.raises(RuntimeError):
            t.publish(schema, receipt)
    per_week = lambda: {r.week_num: r["count"] for r in read_delivered(spark, drop)
                        .groupBy("week_num").count().collect()}
    # Before the manifest the old state stands, after it the new one.
    assert per_week() == ({1: 10, 2: 10, 3: 10} if broken == "_put" else {1: 1, 2: 10, 3: 10})
    t.publish(schema, receipt)
    assert per_week() == {1: 1, 2: 10, 3: 10}
    t.vacuum()
    plain = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet")
    assert plain.parquet(drop).count() == 21
    t.delete_period(2000, 2)
    assert per_week() == {1: 1, 3: 10}


def test_a_failed_delivery_changes_nothing(spark, scratch):
    drop = f"{scratch}/drop"
    DeliverySink(spark, path=drop, backoff=0).upsert(frame(spark))
    bad = DeliverySink(spark, transport=FlakyTransport(drop, [400]), backoff=0)
    with pytest.raises(Exception):
        bad.upsert(frame(spark, by=100))
    assert sorted(r.qty for r in read_delivered(spark, drop).collect()) == list(range(30))


def test_schema_changes_and_fitted_values():
    want = T.StructType.fromDDL("a string, b double, c string, d long, year_num int, week_num int")
    have = {"a": "BIGINT", "c": "BIGINT", "d": "VARCHAR", "year_num": "BIGINT", "week_num": "BIGINT"}
    assert schema_changes("t", have, want, {"a"}) == [
        'ALTER TABLE "t" ALTER COLUMN "a" TYPE VARCHAR',
        'ALTER TABLE "t" ADD COLUMN IF NOT EXISTS "b" DOUBLE']
    fit = lambda i: fitted_value(want.fields[i], have.get(want.fields[i].name), {"a"})
    assert (fit(0), fit(1), fit(4)) == ('"a"', '"b"', '"year_num"')
    assert "date_diff" in fit(2) and fit(3) == 'TRY_CAST("d" AS VARCHAR)'
