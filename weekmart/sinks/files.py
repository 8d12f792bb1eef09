"""Period file export: CSV or Parquet, one directory per period.

Layout: ``<root>/year_num=YYYY/week_num=WW/part-*.<ext>`` (Hive style, so a
later read recovers the period columns by partition discovery).  Rows are
clustered by period with a REBALANCE: a large week is split over several
tasks instead of landing in one, and each period gets few files.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weekmart.functions.values import finite_frame, number_to_text
from weekmart.sinks.base import observed_rows

KEYS = ["year_num", "week_num"]
# CSV quoting modes.
QUOTING = ("minimal", "all", "nonnumeric")
_NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType,
            T.DoubleType, T.DecimalType)
_FRACTIONS = (T.FloatType, T.DoubleType, T.DecimalType)


def _q(n: str):
    return F.col("`" + n.replace("`", "``") + "`")


def layout(df: DataFrame, sort_keys: list[str] | None = None,
           partitions: int | None = None) -> DataFrame:
    """Cluster on the period (REBALANCE: AQE splits a large week over
    several tasks and merges small ones), each file sorted by the keys.
    ``partitions`` asks for a range partitioning instead (globally ordered
    files, at the price of a sampling pass)."""
    keys = [_q(k) for k in KEYS + list(sort_keys or [])]
    if partitions:
        out = df.repartitionByRange(partitions, *keys)
    else:
        out = df.hint("rebalance", *KEYS)
    return out.sortWithinPartitions(*keys)


def _nonnumeric(df: DataFrame, sep: str) -> DataFrame:
    """QUOTE_NONNUMERIC: text fields quoted (inner quotes doubled), numbers
    bare, nulls empty.  Each line is formatted here as one text column
    (named by the formatted header line) and written verbatim."""
    fields, header = [], []
    for f in df.schema.fields:
        if f.name.lower() in KEYS:
            continue
        c = _q(f.name)
        if isinstance(f.dataType, _NUMERIC):
            v = _number(c, f.dataType)
        else:
            v = F.concat(F.lit('"'), F.replace(c.cast("string"), F.lit('"'), F.lit('""')), F.lit('"'))
        fields.append(F.coalesce(v, F.lit("")))
        header.append('"' + f.name.replace('"', '""') + '"')
    line = F.concat_ws(sep, *fields).alias(sep.join(header))
    return df.select(line, *[_q(k) for k in KEYS])


def export_csv(df: DataFrame, path: str, sep: str = ";", quoting: str = "minimal",
               encoding: str = "UTF-8", header: bool = True, compression: str | None = None,
               sort_keys: list[str] | None = None, max_records_per_file: int | None = None,
               mode: str = "overwrite") -> int:
    """Write one CSV set per period.  ±inf/NaN and nulls are written as
    empty fields, numbers in plain notation.  Existing periods under ``path``
    that this frame does not hold are kept (dynamic overwrite).  Returns rows
    written."""
    return csv_export(df, path, sep, quoting, encoding, header, compression, sort_keys,
                      max_records_per_file, mode)["rows"]


def _number(c, kind: T.DataType):
    """A number's CSV text: plain notation; a float keeps a fraction, so that the
    column is read back as what it is."""
    text = number_to_text(c, kind)
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        return F.when(F.contains(text, F.lit(".")), text).otherwise(F.concat(text, F.lit(".0")))
    return text


def _plain_numbers(df: DataFrame) -> DataFrame:
    """Fractional columns as text in plain notation."""
    return df.select(*[_number(_q(f.name), f.dataType).alias(f.name)
                       if isinstance(f.dataType, _FRACTIONS) else _q(f.name)
                       for f in df.schema.fields])


def csv_export(df: DataFrame, path: str, sep: str = ";", quoting: str = "minimal",
               encoding: str = "UTF-8", header: bool = True, compression: str | None = None,
               sort_keys: list[str] | None = None, max_records_per_file: int | None = None,
               mode: str = "overwrite") -> dict[str, int]:
    """:func:`export_csv` with what it wrote: ``rows`` and, for a compressed export,
    ``text_bytes``, the UTF-8 bytes of the rows' values, separators, quotes and line
    ends before compression (header lines not included)."""
    if quoting not in QUOTING:
        raise ValueError(f"quoting must be one of {QUOTING}")
    df = finite_frame(df)
    if quoting != "nonnumeric":
        df = _plain_numbers(df)
    obs = Observation("csv")
    told = [F.count(F.lit(1)).alias("rows")]
    if compression:
        data = [f for f in df.schema.fields if f.name.lower() not in KEYS]
        raw_len = F.octet_length(F.concat_ws(sep, *[
            F.coalesce(_q(f.name).cast("string"), F.lit("")) for f in data]))
        if quoting != "minimal":
            quoted = len(data) if quoting == "all" else \
                sum(not isinstance(f.dataType, _NUMERIC) for f in data)
            raw_len = raw_len + 2 * quoted
        told.append(F.sum(raw_len + 1).alias("text_bytes"))
    # Observed after the exchange (a range exchange samples its input first).
    out = layout(df, sort_keys).observe(obs, *told)
    opts = {"sep": sep, "header": str(header).lower(), "encoding": encoding,
            "nullValue": "", "emptyValue": "", "escape": '"',
            "partitionOverwriteMode": "dynamic"}
    if quoting == "all":
        opts["quoteAll"] = "true"
    if quoting == "nonnumeric":
        out = _nonnumeric(out, sep)
        opts.update({"sep": "\u0001", "quote": "\u0000", "escapeQuotes": "false"})
    if compression:
        opts["compression"] = compression
    if max_records_per_file:
        opts["maxRecordsPerFile"] = str(max_records_per_file)
    out.write.mode(mode).options(**opts).partitionBy(*KEYS).csv(path)
    rows = observed_rows(obs)
    if not compression:
        return {"rows": rows}
    return {"rows": rows, "text_bytes": int(obs.get.get("text_bytes") or 0) if rows else 0}


def export_parquet(df: DataFrame, path: str, sort_keys: list[str] | None = None,
                   compression: str | None = None, mode: str = "overwrite") -> int:
    obs = Observation("parquet")
    out = layout(finite_frame(df), sort_keys).observe(obs, F.count(F.lit(1)).alias("rows"))
    w = out.write.mode(mode).option("partitionOverwriteMode", "dynamic")
    if compression:
        w = w.option("compression", compression)
    w.partitionBy(*KEYS).parquet(path)
    return observed_rows(obs)


@dataclass
class ExportSpec:
    """What one run writes.  ``fmt``: csv | parquet | both (csv + parquet)
    | table | none; ``force_csv_only`` turns any file format into CSV only;
    sink-only formats write no file."""
    fmt: str = "csv"
    root: str | None = None
    sep: str = ";"
    quoting: str = "minimal"
    encoding: str = "UTF-8"
    compression: str | None = None
    force_csv_only: bool = False
    sinks: list = field(default_factory=list)
    ledger: str | None = None     # folder of the per-period load ledger

    def file_formats(self) -> list[str]:
        f = self.fmt.lower()
        if f == "xlsx":
            raise NotImplementedError("workbook output is not built; use csv or parquet")
        if f in ("table", "none", "sink"):
            return []
        if self.force_csv_only:
            return ["csv"]
        return {"csv": ["csv"], "parquet": ["parquet"], "both": ["csv", "parquet"]}[f]


def export_periods(df: DataFrame, spec: ExportSpec, sort_keys: list[str] | None = None) -> dict[str, int]:
    """Write every file format of the spec under ``spec.root/<fmt>``."""
    written = {}
    for fmt in spec.file_formats():
        path = f"{spec.root.rstrip('/')}/{fmt}"
        if fmt == "csv":
            written[fmt] = export_csv(df, path, spec.sep, spec.quoting, spec.encoding,
                                      compression=spec.compression, sort_keys=sort_keys)
        else:
            written[fmt] = export_parquet(df, path, sort_keys=sort_keys, compression=spec.compression)
    return written
