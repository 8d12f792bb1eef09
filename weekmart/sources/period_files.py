"""Back-load of period files.

Two layouts are recognised, each from the file's path alone:

* ``<root>/<YYYY>/<YYYY-WW>.<ext>``  -- one file per week, period in the name;
* ``<root>/year_num=YYYY/week_num=WW/part-*.<ext>`` -- what ``export_csv`` /
  ``export_parquet`` write (and any Hive-style partitioned set).

Listing uses the ``binaryFile`` source without its ``content`` column, so
it is a distributed directory listing that never opens the files.  Before
reading, one distributed pass opens each file's start (CSV header, Parquet
footer).  Files are then read in one job by column name, grouped by their
layout, and take the period from ``_metadata``.  A file that cannot be opened
is an error of its period, never an empty file.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weekmart.functions.names import match_names
from weekmart.functions.values import coerce
from weekmart.session import scratch_dir

# File-name and directory patterns that carry a period.
NAME_PATTERN = r"(?:^|/)(\d{4})-(\d{2})\.{ext}$"
HIVE_PATTERN = r"/year_num=(\d+)/week_num=(\d+)/"


# A CSV set may hold gzip files beside plain ones.
_GLOBS = {"csv": "*.{csv,csv.gz}"}
_ENDINGS = {"csv": r"csv(?:\.gz)?"}


def _period_from_path(path: Column, ext: str) -> tuple[Column, Column]:
    name_re = NAME_PATTERN.replace("{ext}", _ENDINGS.get(ext, ext.replace(".", r"\.")))
    y = F.coalesce(F.nullif(F.regexp_extract(path, name_re, 1), F.lit("")),
                   F.nullif(F.regexp_extract(path, HIVE_PATTERN, 1), F.lit("")))
    w = F.coalesce(F.nullif(F.regexp_extract(path, name_re, 2), F.lit("")),
                   F.nullif(F.regexp_extract(path, HIVE_PATTERN, 2), F.lit("")))
    return y.try_cast("int"), w.try_cast("int")


def period_files(spark: SparkSession, root: str, ext: str = "csv",
                 year: int | None = None, week: int | None = None) -> DataFrame:
    """(path, year_num, week_num, length) of every period file under root,
    optionally for one year and/or week, sorted by path.  Files whose path
    carries no period are left out."""
    files = (spark.read.format("binaryFile")
             .option("recursiveFileLookup", "true")
             .option("pathGlobFilter", _GLOBS.get(ext, f"*.{ext}"))
             .load(root)
             .select("path", "length"))
    y, w = _period_from_path(F.col("path"), ext)
    out = files.select("path", y.alias("year_num"), w.alias("week_num"), "length")
    out = out.where(F.col("year_num").isNotNull() & F.col("week_num").isNotNull())
    if year is not None:
        out = out.where(F.col("year_num") == year)
    if week is not None:
        out = out.where(F.col("week_num") == week)
    return out.orderBy("path")


def plan_backfill(spark: SparkSession, root: str, ext: str = "csv",
                  year: int | None = None, week: int | None = None) -> DataFrame:
    """Dry run: what a back-load would read, without touching the data."""
    return period_files(spark, root, ext, year, week)


def _open(path: str):
    """(pyarrow filesystem, path) of a listed file, local or remote."""
    from pyarrow import fs as pafs
    if "://" in path or path.startswith("file:"):
        return pafs.FileSystem.from_uri(path)
    return pafs.LocalFileSystem(), path


def _csv_layout(path: str) -> str | None:
    """The header line of a CSV file, plain or gzip; None for an empty file."""
    fs, name = _open(path)
    line = b""
    with fs.open_input_stream(name) as stream:
        while b"\n" not in line:
            piece = stream.read(65536)
            if not piece:
                break
            line += piece
    return line.split(b"\n", 1)[0].decode("utf-8", "replace").rstrip("\r") or None


def _parquet_layout(path: str) -> str | None:
    """The schema text of a Parquet file's footer; None for one without rows."""
    import pyarrow.parquet as pq
    fs, name = _open(path)
    with fs.open_input_file(name) as handle:
        meta = pq.ParquetFile(handle).metadata
        if meta.num_rows == 0:
            return None
        return meta.schema.to_arrow_schema().to_string(show_schema_metadata=False)


def file_layouts(spark: SparkSession, root: str, fmt: str = "csv",
                 year: int | None = None, week: int | None = None) -> DataFrame:
    """:func:`layouts_of` every period file under root."""
    return layouts_of(spark, period_files(spark, root, fmt, year, week).drop("length"), fmt)


def layouts_of(spark: SparkSession, files: DataFrame, fmt: str = "csv") -> DataFrame:
    """(path, year_num, week_num, layout, error) of the listed files, which are
    dealt over the cluster and opened once each, at their start only."""
    layout_of = {"csv": _csv_layout, "parquet": _parquet_layout}[fmt]

    def run(batches):
        for pdf in batches:
            layouts, errors = [], []
            for path in pdf["path"]:
                layout = error = None
                try:
                    layout = layout_of(path)
                except Exception as e:  # noqa: BLE001 - told per file
                    error = f"{type(e).__name__}: {e}"
                layouts.append(layout)
                errors.append(error)
            yield pdf.assign(layout=layouts, error=errors)

    dealt = files.repartition(4 * spark.sparkContext.defaultParallelism, "path")
    scanned = dealt.mapInPandas(
        run, "path string, year_num int, week_num int, layout string, error string")
    out = scratch_dir(spark, "layouts")
    scanned.write.mode("overwrite").parquet(out)
    return spark.read.schema(scanned.schema).parquet(out)


def _schema(schema: T.StructType | str) -> T.StructType:
    return schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)


def _read_by_layout(spark: SparkSession, layouts: DataFrame, fmt: str, sep: str,
                    schema: T.StructType | None) -> DataFrame | None:
    """Rows of the files, combined by column name: the files of one layout are
    read together (few distinct layouts; the driver holds the paths, as Spark's
    reader does anyway).  With a schema its columns are picked by name and cast;
    a column that a file lacks is null."""
    groups = (layouts.where("layout is not null").groupBy("layout")
              .agg(F.sort_array(F.collect_list("path")).alias("paths")).collect())
    out = None
    # Groups in order of their first file, so column order is stable.
    for paths in sorted((r["paths"] for r in groups), key=lambda ps: ps[0]):
        if fmt == "parquet":
            part = spark.read.parquet(*paths)
        else:
            part = (spark.read.option("header", "true").option("sep", sep)
                    .option("inferSchema", str(schema is None).lower()).csv(paths))
        at = F.col("_metadata.file_path").alias("__file_path")
        if schema is None:
            part = part.select("*", at)
        else:
            present = match_names(part.columns, schema.fieldNames())
            lacking = [f for f in schema.fields if f.name not in present]
            named = part.select("*", at)
            picked = coerce(named, T.StructType(schema.fields + [T.StructField("__file_path", T.StringType())]))
            part = picked.withColumns({f.name: F.lit(None).cast(f.dataType) for f in lacking}) \
                if lacking else picked
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    return out


def _rows_of(spark: SparkSession, layouts: DataFrame, fmt: str, sep: str,
             schema: T.StructType | str | None) -> DataFrame:
    wanted = None if schema is None else T.StructType(
        [f for f in _schema(schema).fields if f.name.lower() not in ("year_num", "week_num")])
    df = _read_by_layout(spark, layouts, fmt, sep, wanted)
    if df is None:
        fields = (wanted.fields if wanted else []) + [T.StructField("year_num", T.IntegerType()),
                                                      T.StructField("week_num", T.IntegerType())]
        return spark.createDataFrame([], T.StructType(fields))
    data = wanted.fieldNames() if wanted else \
        [c for c in df.columns if c.lower() not in ("year_num", "week_num", "__file_path")]
    y, w = _period_from_path(F.col("__file_path"), fmt)
    return df.select(*[F.col(f"`{c}`") for c in data], y.alias("year_num"), w.alias("week_num"))


def read_period_files(spark: SparkSession, root: str, fmt: str = "csv",
                      schema: T.StructType | str | None = None, sep: str = ";",
                      year: int | None = None, week: int | None = None) -> DataFrame:
    """Rows of every period file under root, matched by column name, with
    ``year_num``/``week_num`` taken from each row's own file path.  Empty files
    add no rows; a file that cannot be opened raises.  Without a schema the
    columns of all files are combined and CSV types are inferred."""
    if fmt not in ("csv", "parquet"):
        raise ValueError(f"unsupported period file format {fmt!r}")
    layouts = file_layouts(spark, root, fmt, year, week)
    bad = layouts.where("error is not null").orderBy("path").first()
    if bad:
        raise OSError(f"cannot read {bad['path']}: {bad['error']}")
    return _rows_of(spark, layouts, fmt, sep, schema)


def backfill_schema(spark: SparkSession, root: str, fmt: str = "csv", sep: str = ";") -> T.StructType:
    """The schema a back-load would create the target with.  Files without
    rows contribute nothing, so an empty first file does not decide it."""
    return read_period_files(spark, root, fmt, sep=sep).schema


def backfill(spark: SparkSession, root: str, sink, fmt: str = "csv",
             schema: T.StructType | str | None = None, sep: str = ";",
             year: int | None = None, week: int | None = None,
             clean=None) -> DataFrame:
    """Load every period file into ``sink`` in one job: each period present
    in the files replaces that period in the target.  Returns per period
    (year_num, week_num, files, rows, status).

    A period with a file that cannot be opened is not loaded and reported as
    ``error: ...`` while the others load.  If the sink fails, every period is
    an error and has 0 rows.  A listed period without rows is ``empty`` (its old
    rows in the target are left alone).  The load itself records which periods
    carried rows (an Observation bounded by the number of weeks); their counts
    are read from the target's replaced partitions."""
    from pyspark.sql import Observation

    keys = ["year_num", "week_num"]
    layouts = file_layouts(spark, root, fmt, year, week)
    files = layouts.groupBy(*keys).agg(F.count("*").alias("files"), F.min("error").alias("error"))
    broken = files.where("error is not null").select(*keys)
    rows = _rows_of(spark, layouts.join(broken, keys, "left_anti"), fmt, sep, schema)
    if clean is not None:
        rows = clean(rows)
    obs = Observation("backfill_periods")
    observed = rows.observe(obs, F.collect_set(F.col("year_num") * 100 + F.col("week_num")).alias("keys"))
    failure = None
    try:
        sink.upsert(observed)
    except Exception as e:  # noqa: BLE001 - reported in the status frame
        failure = f"error: {type(e).__name__}: {e}"
    if failure is not None:
        counted = files.select(*keys, F.lit(0).cast("long").alias("rows"))
    else:
        source = rows
        if hasattr(sink, "read"):
            loaded = [(k // 100, k % 100) for k in sorted(obs.get.get("keys") or [])]
            source = sink.read().join(F.broadcast(
                spark.createDataFrame(loaded, "year_num int, week_num int")), keys, "left_semi")
        counted = source.groupBy(*keys).agg(F.count("*").alias("rows"))
    n = F.coalesce("rows", F.lit(0)).cast("long")
    return (files.join(counted, keys, "left")
            .select(*keys, "files", F.when(F.col("error").isNull(), n).otherwise(0).cast("long").alias("rows"),
                    F.when(F.col("error").isNotNull(), F.concat(F.lit("error: "), "error"))
                    .when(F.lit(failure is not None), F.lit(failure))
                    .when(n == 0, F.lit("empty")).otherwise(F.lit("ok")).alias("status")))
