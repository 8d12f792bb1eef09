"""Loads per period: a refused week keeps no other week out."""

from pyspark.sql import functions as F

from tests.doubles import FailingSink
from weekmart.plans.manifest import run_ledger
from weekmart.sinks import ledger as L
from weekmart.sinks.versions import VersionedSink

SCHEMA = "a long, year_num int, week_num int"


class Counting:
    """Refuses the weeks it is told to, and counts the loads it was given."""

    name = "counting"

    def __init__(self, refused):
        self.refused, self.calls, self.held = set(refused), 0, {}

    def upsert(self, df):
        self.calls += 1
        weeks = {(r.year_num, r.week_num): r["count"] for r in df.groupBy("year_num", "week_num").count().collect()}
        bad = self.refused & set(weeks)
        if bad:
            raise ValueError(f"refused {sorted(bad)[0]}")
        self.held.update(weeks)
        return sum(weeks.values())

    def close(self):
        pass


def frame(spark, weeks=40):
    return spark.createDataFrame([(i, 2000, 1 + i % weeks) for i in range(3 * weeks)], SCHEMA)


def test_refused_weeks_stand_alone(spark):
    sink = Counting({(2000, 7), (2000, 30)})
    rows = {(r.year_num, r.week_num): (r.status, r["rows"]) for r in
            L.load_periods(frame(spark), [sink], [(2000, w) for w in range(1, 43)]).collect()}
    assert {p for p, (s, _) in rows.items() if s == "error"} == {(2000, 7), (2000, 30)}
    assert {p for p, (s, _) in rows.items() if s == "empty"} == {(2000, 41), (2000, 42)}
    assert len(sink.held) == 38 and all(rows[p] == ("ok", n) for p, n in sink.held.items())
    assert sink.calls <= 2 * 2 * 7


def test_a_dead_sink_is_left_after_some_tries(spark):
    rows = L.load_periods(frame(spark), [FailingSink("down"), Counting(())], give_up_after=3).collect()
    down = [r for r in rows if r.sink == "down"]
    assert len(down) == 40 and all(r.status == "error" and r["rows"] == 0 for r in down)
    assert sum("not tried" in r.error for r in down) == 37
    assert all(r.status == "ok" for r in rows if r.sink == "counting")
    status = {r.sink: (r.status, r["rows"]) for r in L.sink_status(spark.createDataFrame(rows, L.LEDGER_SCHEMA)).collect()}
    assert status == {"down": ("error", 0), "counting": ("ok", 120)}


def test_the_kept_ledger_names_open_weeks(spark, scratch):
    kept, store = f"{scratch}/ledger", VersionedSink(spark, f"{scratch}/t", name="inner")
    strict = L.CheckedSink(store, F.col("a") != 5, name="store")
    L.load_periods(frame(spark, 6), [strict], ledger=kept)
    assert [tuple(r) for r in L.open_periods(spark, kept, "store").collect()] == [(2000, 6)]
    assert store.read().count() == 15
    loose = L.CheckedSink(store, F.lit(None).cast("boolean"), name="store")
    again = L.retry_open(frame(spark, 6), [loose], kept).collect()
    assert [(r.week_num, r.status, r["rows"]) for r in again] == [(6, "ok", 3)]
    assert L.open_periods(spark, kept, "store").count() == 0 and store.read().count() == 18
    assert L.retry_open(frame(spark, 6), [loose], kept).count() == 0
    files = spark.createDataFrame([(2000, 6, 2, 1280)], "year_num int, week_num int, files long, bytes long")
    told = {r.week_num: (r.period, r.status, r["rows"], r.files, r.size)
            for r in run_ledger(L.latest(spark, kept), files).collect()}
    assert told[6] == ("2000-06", "ok", 3, 2, "1.2 КБ") and told[1] == ("2000-01", "ok", 3, 0, "0 Б")
