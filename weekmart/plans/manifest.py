"""Run manifest and the small profiles reported after a run."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weekmart.functions.dates import period_label
from weekmart.functions.sizes import human_size

KEYS = ["year_num", "week_num"]
# A column's display width is its longest text plus 2, at most 100.
WIDTH_PAD, WIDTH_MAX = 2, 100


def manifest(result: DataFrame, wanted: DataFrame) -> DataFrame:
    """Rows per requested period (0 for a period without rows).  The counts
    are one partial aggregate; their size is bounded by the period list."""
    counts = result.groupBy(*KEYS).agg(F.count(F.lit(1)).alias("row_count"))
    return (wanted.select(*KEYS)
            .join(F.broadcast(counts), KEYS, "left")
            .select(*KEYS, period_label("year_num", "week_num").alias("period"),
                    F.coalesce(F.col("row_count"), F.lit(0)).cast("long").alias("row_count")))


def manifest_stats(m: DataFrame, col: str = "row_count") -> DataFrame:
    """Total, mean, min, max over the periods of a manifest."""
    c = F.col(col)
    return m.agg(
        F.count(F.lit(1)).cast("long").alias("periods"),
        F.sum(c).cast("long").alias("total_rows"),
        F.avg(c).alias("mean_rows"),
        F.min(c).cast("long").alias("min_rows"),
        F.max(c).cast("long").alias("max_rows"),
        F.count(F.when(c == 0, 1)).cast("long").alias("empty_periods"),
    )


def file_manifest(files: DataFrame) -> DataFrame:
    """Per period: files and bytes written, with a readable size.
    ``files`` has (year_num, week_num, path, length)."""
    return (files.groupBy(*KEYS)
            .agg(F.count(F.lit(1)).cast("long").alias("files"),
                 F.sum("length").cast("long").alias("bytes"))
            .withColumn("size", human_size("bytes")))


def run_ledger(ledger: DataFrame, files: DataFrame | None = None) -> DataFrame:
    """The run's manifest with what became of each period: (sink, year_num, week_num,
    period, status, rows, error) of a load's ledger, failed and empty periods included, and
    with ``files`` (a :func:`file_manifest`) the files, bytes and readable size of each."""
    out = ledger.select("sink", *KEYS, period_label("year_num", "week_num").alias("period"),
                        "status", "rows", "error")
    if files is None:
        return out
    none = F.lit(0).cast("long")
    return out.join(files.select(*KEYS, "files", "bytes"), KEYS, "left").select(
        *out.columns, F.coalesce("files", none).alias("files"), F.coalesce("bytes", none).alias("bytes"),
        human_size(F.coalesce("bytes", none)).alias("size"))


def column_width_profile(df: DataFrame) -> DataFrame:
    """For each column: the longest value as text (header included) and the
    display width min(longest + 2, 100).  One aggregate pass."""
    cols = df.columns
    agg = df.agg(*[F.max(F.length(F.col(f"`{c}`").cast("string"))).alias(f"m{i}")
                   for i, c in enumerate(cols)])
    rows = agg.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column_name"),
                 F.greatest(F.coalesce(F.col(f"m{i}"), F.lit(0)), F.lit(len(c))).alias("max_len"))
        for i, c in enumerate(cols)])).alias("r"))
    return rows.select(
        F.col("r.column_name").alias("column_name"),
        F.col("r.max_len").cast("int").alias("max_len"),
        F.least(F.col("r.max_len") + WIDTH_PAD, F.lit(WIDTH_MAX)).cast("int").alias("width"))


def load_status(status: DataFrame) -> DataFrame:
    """Success / error counts of a fan-out or back-load status frame."""
    return status.groupBy("status").agg(F.count(F.lit(1)).cast("long").alias("n"),
                                        F.sum("rows").cast("long").alias("rows"))
