"""Incremental period load: a growing directory of period files, each
micro-batch replacing the periods it touches in the target.

The stream only discovers files (``binaryFile`` without its content); its
checkpoint remembers which ones were taken.  ``foreachBatch`` then loads every
touched period whole, from all files that the present run has seen of it, by
column name, and replaces the period.

A run is what lies in the directory when its first batch is taken, under any
trigger: it is over when every such file that still exists has been taken, and the
next batch begins the next run.  A later run that brings new files of a period
replaces that period.  So neither the batch size, the trigger nor a failure changes
the result.  A file that cannot be read fails the batch.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weekmart.session import _qualified
from weekmart.sources.period_files import (
    _GLOBS, _period_from_path, _rows_of, layouts_of, period_files,
)

# Fixed value: the columns of Spark's binaryFile source.
FILE_SCHEMA = "path string, modificationTime timestamp, length bigint, content binary"


def period_stream(spark: SparkSession, root: str, fmt: str = "csv",
                  max_files_per_trigger: int | None = None) -> DataFrame:
    """(path, year_num, week_num) of period files as they appear."""
    r = (spark.readStream.format("binaryFile").schema(FILE_SCHEMA)
         .option("recursiveFileLookup", "true").option("pathGlobFilter", _GLOBS.get(fmt, f"*.{fmt}")))
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    y, w = _period_from_path(F.col("path"), fmt)
    found = r.load(root).select("path", y.alias("year_num"), w.alias("week_num"))
    return found.where("year_num is not null and week_num is not null")


class RunState:
    """The run in progress, kept beside the checkpoint:

        <checkpoint>-run/run=<n>/expected      files that were there when it began
        <checkpoint>-run/run=<n>/batch=<epoch> files of each batch
        <checkpoint>-run/state.json            run, last batch, whether it is over

    The file lists are Parquet tables that Spark writes and reads; the driver holds
    the three values of ``state.json`` only.  A batch is noted before it is loaded, under
    its epoch, so a replayed batch adds nothing new.  Lists of runs before the last one
    are removed."""

    def __init__(self, spark: SparkSession, checkpoint: str):
        path, self.fs = _qualified(spark, f"{checkpoint.rstrip('/')}-run")
        self.spark, self.root = spark, path.toString().rstrip("/")

    def _path(self, rest: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{rest}")

    def load(self) -> dict | None:
        at = self._path("state.json")
        if not self.fs.exists(at):
            return None
        stream = self.fs.open(at)
        try:
            return json.loads(self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def save(self, state: dict) -> None:
        jvm, gateway = self.spark._jvm, self.spark.sparkContext._gateway
        draft = self._path(f".state.{uuid.uuid4().hex}")
        out = self.fs.create(draft, False)
        try:
            out.write(bytearray(json.dumps(state).encode()))
        finally:
            out.close()
        rename = jvm.org.apache.hadoop.fs.Options.Rename
        how = gateway.new_array(rename, 1)
        how[0] = rename.OVERWRITE
        jvm.org.apache.hadoop.fs.FileContext.getFileContext(
            draft.toUri(), self.spark._jsc.hadoopConfiguration()).rename(draft, self._path("state.json"), how)

    def _list(self, run: int, name: str) -> DataFrame:
        schema = "path string, year_num int, week_num int"
        return self.spark.read.schema(schema).parquet(f"{self.root}/run={run}/{name}")

    def take(self, files: DataFrame, epoch: int, present) -> DataFrame:
        """Note a batch's ``files``; returns the run's files of the periods they touch.
        ``present()`` lists what the directory holds, for a run that begins."""
        state = self.load()
        # The last batch of a finished run may be replayed: it still belongs to it.
        if state is None or (state["over"] and epoch != state["epoch"]):
            run = state["run"] + 1 if state else 0
            present().write.mode("overwrite").parquet(f"{self.root}/run={run}/expected")
            state = {"run": run, "epoch": epoch, "over": False}
            self.save(state)
            self.fs.delete(self._path(f"run={run - 2}"), True)
        run = state["run"]
        files.write.mode("overwrite").parquet(f"{self.root}/run={run}/batch={epoch}")
        self.save({**state, "epoch": epoch})
        touched = self._list(run, f"batch={epoch}").select("year_num", "week_num").distinct()
        return self._list(run, "batch=*").distinct().join(touched, ["year_num", "week_num"], "left_semi") \
            .select("path", "year_num", "week_num")

    def done(self, present) -> None:
        """The batch is loaded; the run is over if no file of it is left."""
        state = self.load()
        left = self._list(state["run"], "expected").join(
            self._list(state["run"], "batch=*").select("path"), "path", "left_anti").select("path")
        over = left.isEmpty() or left.join(present().select("path"), "path", "left_semi").isEmpty()
        self.save({**state, "over": over})


def stream_load(spark: SparkSession, root: str, sink, checkpoint: str,
                schema: T.StructType | str, fmt: str = "csv", sep: str = ";",
                clean=None, available_now: bool = True, max_files_per_trigger: int | None = None,
                every: str = "1 minute"):
    """Start the load; with ``available_now`` it runs to the end of the files
    present and stops, else it looks for files ``every`` so often.  Returns the
    StreamingQuery."""
    state = RunState(spark, checkpoint)

    def present() -> DataFrame:
        return period_files(spark, root, fmt).select("path", "year_num", "week_num")

    def load_batch(batch: DataFrame, epoch_id: int) -> None:
        if batch.isEmpty():
            return
        layouts = layouts_of(spark, state.take(batch, epoch_id, present), fmt)
        bad = layouts.where("error is not null").first()
        if bad:
            raise OSError(f"cannot read {bad['path']}: {bad['error']}")
        rows = _rows_of(spark, layouts, fmt, sep, schema)
        sink.upsert(clean(rows) if clean is not None else rows)
        state.done(present)

    w = period_stream(spark, root, fmt, max_files_per_trigger).writeStream \
        .foreachBatch(load_batch).option("checkpointLocation", _qualified(spark, checkpoint)[0].toString())
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=every)
    return w.start()
