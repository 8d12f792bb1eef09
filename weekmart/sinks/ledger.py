"""Loads that are committed and recorded period by period.

``load_periods`` gives each sink all its periods in one job.  Only if that fails are they
split: halves are tried again until the periods that the sink refuses stand alone, so a bad
week costs a few more jobs and keeps no other week out.  What happened is a ledger row
per sink and period; kept in a folder, it tells a later run which periods are still open."""

from __future__ import annotations

import logging
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from weekmart.operators.filters import KEYS, collect_periods, where_periods
from weekmart.session import _checkpoint_root

log = logging.getLogger("weekmart")

LEDGER_SCHEMA = "run string, sink string, year_num int, week_num int, status string, rows long, error string"
GIVE_UP_AFTER = 8       # single periods refused in a row with one error: the sink is down
Period = tuple[int, int]


class CheckedSink:
    """A sink that refuses rows which break ``rule``, as a store's constraint does: the
    load that holds one fails."""

    def __init__(self, sink, rule: Column, message: str = "row refused", name: str | None = None):
        self.sink, self.rule, self.message = sink, rule, message
        self.name = name or f"checked:{sink.name}"

    def upsert(self, df: DataFrame) -> int:
        # A rule that is null for a row does not refuse it.
        holds = F.coalesce(self.rule, F.lit(True))
        checked = df.where(F.when(holds, F.lit(True)).otherwise(
            F.raise_error(F.lit(self.message)).cast("boolean")))
        return self.sink.upsert(checked)

    def close(self) -> None:
        self.sink.close()


class _Loader:
    """One sink's way through the periods."""

    def __init__(self, sink, source: DataFrame, counts: dict[Period, int], give_up_after: int):
        self.sink, self.source, self.counts = sink, source, counts
        self.done: dict[Period, tuple[str, int, str | None]] = {}
        self.refused, self.last, self.limit = 0, None, give_up_after

    def load(self, periods: list[Period], whole: bool = False) -> None:
        if not periods:
            return
        if self.refused >= self.limit:
            self.done.update({p: ("error", 0, f"not tried after {self.refused} failures: {self.last}")
                              for p in periods})
            return
        try:
            self.sink.upsert(self.source if whole else where_periods(self.source, periods))
        except Exception as e:  # noqa: BLE001 - told per period
            told = f"{type(e).__name__}: {e}"
            log.warning("sink %s refused %d periods: %s", self.sink.name, len(periods), told.split("\n")[0])
            if len(periods) == 1:
                same = told == self.last
                self.refused, self.last = (self.refused + 1 if same else 1), told
                self.done[periods[0]] = ("error", 0, told)
                return
            middle = len(periods) // 2
            self.load(periods[:middle])
            self.load(periods[middle:])
            return
        self.refused, self.last = 0, None
        self.done.update({p: ("ok", self.counts[p], None) for p in periods})


def load_periods(df: DataFrame, sinks: list, wanted=None, ledger: str | None = None,
                 run: str | None = None, give_up_after: int = GIVE_UP_AFTER,
                 materialize: bool = True) -> DataFrame:
    """Load ``df`` into every sink; one row (run, sink, year_num, week_num, status, rows,
    error) per sink and period: ``ok``, ``error`` (nothing of that period was loaded) or
    ``empty`` for a ``wanted`` period without rows, which is left alone.  With ``ledger``
    the rows are added to that folder.  The result is computed once, unless
    ``materialize`` says that it is stored already."""
    spark, run, source = df.sparkSession, run or uuid.uuid4().hex[:12], df
    if materialize:
        _checkpoint_root(spark)
        source = df.checkpoint(eager=True)
    # As many rows as weeks.
    counts = {(r.year_num, r.week_num): r["count"] for r in source.groupBy(*KEYS).count().collect()
              if r.year_num is not None and r.week_num is not None}
    asked = set(collect_periods(wanted)) if wanted is not None else set(counts)
    told = []
    for sink in sinks:
        loader = _Loader(sink, source, counts, give_up_after)
        present = sorted(asked & set(counts))
        loader.load(present, whole=len(present) == len(counts))
        loader.done.update({p: ("empty", 0, None) for p in asked - set(counts)})
        told += [(run, sink.name, *p, *loader.done[p]) for p in sorted(asked)]
    rows = spark.createDataFrame(told, LEDGER_SCHEMA)
    if ledger:
        rows.withColumn("at", F.current_timestamp()).coalesce(1).write.mode("append").parquet(ledger)
    return rows


def sink_status(ledger: DataFrame) -> DataFrame:
    """(sink, status, rows, error) of a ledger: ``error`` if any period failed."""
    failed = F.col("status") == "error"
    return ledger.groupBy("sink").agg(
        F.when(F.bool_or(failed), "error").otherwise("ok").alias("status"),
        F.sum("rows").cast("long").alias("rows"),
        F.min_by("error", F.when(failed, F.col("year_num") * 100 + F.col("week_num"))).alias("error"))


def latest(spark: SparkSession, ledger: str) -> DataFrame:
    """The last row of each sink and period."""
    last = Window.partitionBy("sink", *KEYS).orderBy(F.desc("at"), F.desc("run"))
    return spark.read.parquet(ledger).withColumn("__n", F.row_number().over(last)) \
        .where("__n = 1").drop("__n")


def open_periods(spark: SparkSession, ledger: str, sink: str) -> DataFrame:
    """(year_num, week_num) that ``sink`` has not taken yet."""
    return latest(spark, ledger).where((F.col("sink") == sink) & (F.col("status") == "error")).select(*KEYS)


def retry_open(df: DataFrame, sinks: list, ledger: str) -> DataFrame:
    """Load into each sink the periods of ``df`` that its ledger has as open."""
    out = None
    for sink in sinks:
        again = collect_periods(open_periods(df.sparkSession, ledger, sink.name))
        if again:
            rows = load_periods(where_periods(df, again), [sink], again, ledger)
            out = rows if out is None else out.unionByName(rows)
    return out if out is not None else df.sparkSession.createDataFrame([], LEDGER_SCHEMA)
