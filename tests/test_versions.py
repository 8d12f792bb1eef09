"""The versioned table: what a reader sees when a load dies on the way."""

import pytest
from pyspark.sql import functions as F

from weekmart.sinks import versions as V

SCHEMA = "a long, s string, year_num int, week_num int"


def rows(t, *columns):
    return sorted(tuple(r) for r in t.read().select(*columns or "*").collect())


def table(spark, scratch):
    return V.VersionedSink(spark, f"{scratch}/t")


def frame(spark, data, schema=SCHEMA):
    return spark.createDataFrame(data, schema)


def test_upsert_insert_delete(spark, scratch):
    t = table(spark, scratch)
    first = frame(spark, [(1, "x", 2000, 1), (2, "y", 2000, 2)])
    assert t.upsert(first) == 2 and t.upsert(first) == 2
    assert t.upsert(frame(spark, [(9, "q", 2000, 2)])) == 1
    assert rows(t) == [(1, "x", 2000, 1), (9, "q", 2000, 2)]
    assert t.upsert(frame(spark, [])) == 0 and len(rows(t)) == 2
    assert t.insert(frame(spark, [(5, "i", 2000, 1), (6, "j", 2001, 3)])) == 2
    t.delete_period(2000, 2)
    assert rows(t) == [(1, "x", 2000, 1), (5, "i", 2000, 1), (6, "j", 2001, 3)]
    assert sorted(tuple(r) for r in t.read(1).collect()) == [(1, "x", 2000, 1), (2, "y", 2000, 2)]
    with pytest.raises(ValueError):
        t.upsert(frame(spark, [(1, "x", None, 1)]))
    assert len(rows(t)) == 3


def test_columns_evolve_without_rewriting(spark, scratch):
    t = table(spark, scratch)
    t.upsert(frame(spark, [(1, "x", 2000, 1), (None, "n", 2000, 1)]))
    t.upsert(frame(spark, [(3, "z", 1.5, 2000, 2)], "a long, S string, extra double, YEAR_NUM int, week_num int"))
    t.upsert(frame(spark, [("2000-01-05", "d", 2000, 3)], "A string, s string, year_num int, week_num int"))
    assert t.schema()["a"].dataType.simpleString() == "bigint"
    before = {f.path for f in spark.read.format("binaryFile").option("recursiveFileLookup", "true")
              .load(f"{scratch}/t/data").select("path").collect()}
    t.upsert(frame(spark, [("abc", "w", 2000, 4)], "a string, s string, year_num int, week_num int"))
    after = {f.path for f in spark.read.format("binaryFile").option("recursiveFileLookup", "true")
             .load(f"{scratch}/t/data").select("path").collect()}
    assert before < after and len(after - before) <= 2          # only the new week was written
    assert t.schema()["a"].dataType.simpleString() == "string"
    assert {(r.a, r.extra, r.week_num) for r in t.read().collect()} == \
        {("1", None, 1), (None, None, 1), ("3", 1.5, 2), ("36530", None, 3), ("abc", None, 4)}


@pytest.mark.parametrize("step", ["write", "commit"])
def test_a_crash_leaves_the_table_whole(spark, scratch, monkeypatch, step):
    """Dying in the middle of an upsert that replaces a week and widens a column."""
    t = table(spark, scratch)
    t.upsert(frame(spark, [(1, "x", 2000, 1), (2, "y", 2000, 2)]))
    change = frame(spark, [("text", "new", 2000, 2), ("more", "new", 2000, 3)],
                   "a string, s string, year_num int, week_num int")
    if step == "write":
        bad = change.withColumn("s", F.when(F.col("week_num") == 3, F.raise_error(F.lit("lost"))).otherwise(F.col("s")))
        with pytest.raises(Exception, match="lost"):
            t.upsert(bad)
    else:
        with monkeypatch.context() as m:
            m.setattr(V.VersionedSink, "publish", lambda self, commit: (_ for _ in ()).throw(KeyboardInterrupt()))
            with pytest.raises(KeyboardInterrupt):
                t.upsert(change)
    again = table(spark, scratch)
    assert rows(again) == [(1, "x", 2000, 1), (2, "y", 2000, 2)]
    assert again.schema()["a"].dataType.simpleString() == "bigint"
    assert again.upsert(change) == 2
    assert rows(again) == [("1", "x", 2000, 1), ("more", "new", 2000, 3), ("text", "new", 2000, 2)]
    again.vacuum(keep=1)
    assert len(rows(again)) == 3


def test_of_two_writers_one_fails(spark, scratch):
    a, b = table(spark, scratch), table(spark, scratch)
    a.upsert(frame(spark, [(1, "x", 2000, 1)]))
    stale = b.current()
    a.upsert(frame(spark, [(2, "y", 2000, 2)]))
    stale.periods.clear()
    with pytest.raises(V.CommitConflict):
        b.publish(stale)
    assert len(rows(a)) == 2


def test_no_session_setting_changes(spark, scratch):
    before = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    table(spark, scratch).upsert(frame(spark, [(1, "x", 2000, 1)]))
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode") == before
