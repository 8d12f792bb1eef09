"""The sink contract and the fan-out of one result to several sinks."""

from __future__ import annotations

import logging
from typing import Protocol, runtime_checkable

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

log = logging.getLogger("weekmart")

STATUS_SCHEMA = "sink string, status string, rows long, error string"


@runtime_checkable
class PeriodSink(Protocol):
    """setup -> delete_period / insert -> close, plus the Spark-native
    ``upsert`` that replaces every period present in the frame at once."""
    name: str

    def setup(self, df: DataFrame) -> None: ...
    def delete_period(self, year: int, week: int) -> None: ...
    def insert(self, df: DataFrame) -> int: ...
    def upsert(self, df: DataFrame) -> int: ...
    def close(self) -> None: ...


def counted(df: DataFrame, name: str = "rows") -> tuple[DataFrame, Observation]:
    """Attach a row counter that is filled by whatever action runs next
    (the write itself), so counting costs no extra pass."""
    obs = Observation(name)
    return df.observe(obs, F.count(F.lit(1)).alias("rows")), obs


def observed_rows(obs: Observation) -> int:
    try:
        return int(obs.get.get("rows", 0))
    except Exception:  # noqa: BLE001 - no action ran (empty plan)
        return 0


def fan_out(df: DataFrame, sinks: list, spark: SparkSession | None = None,
            materialize: str = "checkpoint") -> DataFrame:
    """Load one result into several sinks.  A failing sink is recorded and
    skipped; the others go on.  Returns (sink, status, rows, error), one row
    per sink instance.

    With more than one sink the result is computed once: by default it is
    checkpointed into the shared ``spark.checkpoint.dir`` (lineage cut, so a
    lost executor costs a re-read, not a re-run of the whole summary);
    ``materialize="persist"`` keeps it in executor memory/disk instead."""
    spark = spark or df.sparkSession
    source, cached = df, None
    if len(sinks) > 1 and materialize == "checkpoint":
        from weekmart.session import _checkpoint_root
        _checkpoint_root(spark)          # sets a private folder only when unset
        source = df.checkpoint(eager=True)
    elif len(sinks) > 1 and materialize == "persist":
        source = cached = df.persist(StorageLevel.MEMORY_AND_DISK)
    statuses = []
    try:
        for sink in sinks:
            name = getattr(sink, "name", type(sink).__name__)
            try:
                rows = sink.upsert(source)
                statuses.append((name, "ok", int(rows), None))
            except Exception as e:  # noqa: BLE001 - isolate the failing sink
                log.warning("sink %s failed: %s", name, e)
                statuses.append((name, "error", 0, f"{type(e).__name__}: {e}"))
    finally:
        if cached is not None:
            cached.unpersist()
    return spark.createDataFrame(statuses, STATUS_SCHEMA)
