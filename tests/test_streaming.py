import os

import pandas as pd

from weekmart.session import scratch_dir
from weekmart.sinks.table import TableSink
from weekmart.streaming.load import stream_load


def test_incremental_load_replaces_periods(spark, scratch):
    src = scratch.removeprefix("file:") + "/src"
    os.makedirs(f"{src}/2025", exist_ok=True)
    pd.DataFrame({"name": ["a", "b"], "qty": [1.0, 2.0]}).to_csv(f"{src}/2025/2025-01.csv", sep=";", index=False)
    t = TableSink(spark, "t_stream_" + scratch.rsplit("-", 1)[-1], location=f"{scratch}/t")
    ck = scratch_dir(spark, "ck")
    q = stream_load(spark, src, t, ck, "name string, qty double", "csv")
    q.awaitTermination()
    assert t.read().count() == 2
    # a re-delivered week replaces its period; a new week is added
    os.makedirs(f"{src}/2025b", exist_ok=True)
    pd.DataFrame({"name": ["c"], "qty": [5.0]}).to_csv(f"{src}/2025b/2025-01.csv", sep=";", index=False)
    pd.DataFrame({"name": ["d"], "qty": [7.0]}).to_csv(f"{src}/2025b/2025-02.csv", sep=";", index=False)
    q = stream_load(spark, src, t, ck, "name string, qty double", "csv")
    q.awaitTermination()
    got = sorted((r.week_num, r.name) for r in t.read().collect())
    assert got == [(1, "c"), (2, "d")]


def test_period_split_over_batches_keeps_all_its_files(spark, scratch):
    # Hive layout: week 2025-03 is two part files; one file per trigger puts
    # them in different batches of the same run.
    src = scratch.removeprefix("file:") + "/hive"
    d3, d4 = f"{src}/year_num=2025/week_num=3", f"{src}/year_num=2025/week_num=4"
    os.makedirs(d3, exist_ok=True)
    os.makedirs(d4, exist_ok=True)
    pd.DataFrame({"name": ["a"], "qty": [1.0]}).to_csv(f"{d3}/part-0.csv", sep=";", index=False)
    pd.DataFrame({"name": ["b"], "qty": [2.0]}).to_csv(f"{d3}/part-1.csv", sep=";", index=False)
    pd.DataFrame({"name": ["c"], "qty": [3.0]}).to_csv(f"{d4}/part-0.csv", sep=";", index=False)
    t = TableSink(spark, "t_split_" + scratch.rsplit("-", 1)[-1], location=f"{scratch}/ts")
    ck = scratch_dir(spark, "ck")
    q = stream_load(spark, src, t, ck, "name string, qty double", "csv", max_files_per_trigger=1)
    q.awaitTermination()
    got = sorted((r.week_num, r.name) for r in t.read().collect())
    assert got == [(3, "a"), (3, "b"), (4, "c")]
    # a later run that re-delivers week 3 replaces it
    pd.DataFrame({"name": ["z"], "qty": [9.0]}).to_csv(f"{d3}/part-2.csv", sep=";", index=False)
    q = stream_load(spark, src, t, ck, "name string, qty double", "csv", max_files_per_trigger=1)
    q.awaitTermination()
    got = sorted((r.week_num, r.name) for r in t.read().collect())
    assert got == [(3, "z"), (4, "c")]


def test_crash_between_batches_and_replay_lose_nothing(spark, scratch):
    src = scratch.removeprefix("file:") + "/crash"
    d = f"{src}/year_num=2025/week_num=3"
    os.makedirs(d, exist_ok=True)
    for i in range(3):
        pd.DataFrame({"qty": [float(i)], "name": [f"r{i}"]}).to_csv(f"{d}/part-{i}.csv", sep=";", index=False)
    t = TableSink(spark, "t_crash_" + scratch.rsplit("-", 1)[-1], location=f"{scratch}/tc")
    ck = scratch_dir(spark, "ck")

    class Crashing:
        calls = 0

        def upsert(self, df):
            self.calls += 1
            if self.calls == 3:
                raise RuntimeError("lost")
            n = t.upsert(df)
            if self.calls == 2:
                t.upsert(df)      # as if the batch were replayed
            return n

    q = stream_load(spark, src, Crashing(), ck, "name string, qty double", "csv", max_files_per_trigger=1)
    try:
        q.awaitTermination()
    except Exception:
        pass
    q = stream_load(spark, src, t, ck, "name string, qty double", "csv", max_files_per_trigger=1)
    q.awaitTermination()
    assert sorted((r.name, r.qty) for r in t.read().collect()) == [("r0", 0.0), ("r1", 1.0), ("r2", 2.0)]


def _csv(path, rows):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    pd.DataFrame(rows, columns=["name", "qty"]).to_csv(path, sep=";", index=False)


def test_a_running_stream_replaces_periods_as_single_runs_do(spark, scratch):
    src = scratch.removeprefix("file:") + "/cont"
    deliveries = [[("a/2025-01.csv", [("a", 1.0)]), ("a/2025-02.csv", [("b", 2.0)])],
                  [("b/2025-01.csv", [("c", 3.0)])],
                  [("c/2025-02.csv", [("d", 4.0)]), ("c/2025-03.csv", [("e", 5.0)])]]
    t = TableSink(spark, "t_cont_" + scratch.rsplit("-", 1)[-1], location=f"{scratch}/tc")
    once = TableSink(spark, "t_once_" + scratch.rsplit("-", 1)[-1], location=f"{scratch}/to")
    _csv(f"{src}/{deliveries[0][0][0]}", deliveries[0][0][1])
    ck, ck2 = scratch_dir(spark, "ck"), scratch_dir(spark, "ck")
    q = None
    try:
        for files in deliveries:
            for name, rows in files:
                _csv(f"{src}/{name}", rows)
            if q is None:
                q = stream_load(spark, src, t, ck, "name string, qty double", "csv", available_now=False, every="0 seconds")
            q.processAllAvailable()
            stream_load(spark, src, once, ck2, "name string, qty double", "csv").awaitTermination()
    finally:
        if q is not None:
            q.stop()
    want = [(1, "c"), (2, "d"), (3, "e")]
    for sink in (t, once):
        assert sorted((r.week_num, r.name) for r in sink.read().collect()) == want


def test_run_state_does_not_grow_with_files(spark, scratch):
    from weekmart.streaming.load import RunState
    state = RunState(spark, f"{scratch}/state")
    size = lambda: state.fs.getFileStatus(state._path("state.json")).getLen()
    schema, sizes = "path string, year_num int, week_num int", []
    for epoch in range(4):
        files = spark.range(1000).selectExpr(f"concat('f{epoch}-', id) as path", "2025 as year_num",
                                             "cast(id % 50 + 1 as int) as week_num").to(
            spark.createDataFrame([], schema).schema)
        for _ in range(2):                                  # a replayed batch adds nothing
            assert state.take(files, epoch, lambda: files).count() == 1000
        state.done(lambda: files)
        sizes.append(size())
    assert max(sizes) == min(sizes) < 100
    kept = [s.getPath().getName() for s in state.fs.listStatus(state._path(""))]
    assert sorted(k for k in kept if k.startswith("run=")) == ["run=2", "run=3"]
