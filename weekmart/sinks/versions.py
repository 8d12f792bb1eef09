"""A table of immutable period versions behind one pointer.

    <root>/data/year_num=YYYY/week_num=WW/version=<id>/part-*.parquet
    <root>/commits/00000001.json, 00000002.json, ...

A load writes its periods as a new version, in folders that no reader knows yet, and
then adds one commit file: the table's columns, the version of each period, and the
columns that each version's files have.  The commit with the highest number is the table.
Its file is moved into place under a number that must be free, so of two writers that
started from the same commit one fails (and may load again), and a crash at any moment
leaves the previous table whole.

Widening a column to text changes the columns of the commit; older files keep their
numbers, which are turned into text as they are read.  A new column is null in older
files.  Nothing is rewritten, and no session setting is used.  ``vacuum`` removes the
files that the newest commits no longer name.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weekmart.functions.values import DATE_TEXT_PATTERN, number_to_text
from weekmart.operators.columns import matched, quoted, unmatched
from weekmart.session import _qualified
from weekmart.sinks.table import _INTEGRAL, fitted

KEYS = ("year_num", "week_num")


class CommitConflict(RuntimeError):
    """Another writer committed first; the table holds its rows, not this load's."""


class Commit:
    """One state of the table: columns, the version of each period, and each
    version's columns.  Its size grows with the number of periods, not of rows."""

    def __init__(self, number: int = 0, schema: T.StructType | None = None,
                 periods: dict[tuple[int, int], str] | None = None,
                 versions: dict[str, T.StructType] | None = None):
        self.number, self.schema = number, schema
        self.periods, self.versions = periods or {}, versions or {}

    def to_json(self) -> str:
        used = set(self.periods.values())
        return json.dumps({
            "schema": self.schema.jsonValue(),
            "periods": [[y, w, v] for (y, w), v in sorted(self.periods.items())],
            "versions": {v: s.jsonValue() for v, s in self.versions.items() if v in used}})

    @staticmethod
    def from_json(number: int, text: str) -> "Commit":
        told = json.loads(text)
        return Commit(number, T.StructType.fromJson(told["schema"]),
                      {(y, w): v for y, w, v in told["periods"]},
                      {v: T.StructType.fromJson(s) for v, s in told["versions"].items()})


class VersionedSink:
    """A period sink over a folder that all executors share."""

    def __init__(self, spark: SparkSession, root: str, name: str | None = None, evolve: bool = True):
        self.spark, self.auto_evolve = spark, evolve
        path, self.fs = _qualified(spark, root)
        self.root = path.toString().rstrip("/")
        self.name = name or f"versions:{root}"

    # -- commits -------------------------------------------------------------
    def _path(self, rest: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{rest}")

    def _numbers(self) -> list[int]:
        folder = self._path("commits")
        if not self.fs.exists(folder):
            return []
        names = [s.getPath().getName() for s in self.fs.listStatus(folder)]
        return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())

    def current(self, number: int | None = None) -> Commit:
        """The newest commit, or the one of a number."""
        numbers = self._numbers()
        if not numbers:
            return Commit()
        at = numbers[-1] if number is None else number
        stream = self.fs.open(self._path(f"commits/{at:08d}.json"))
        try:
            text = self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        return Commit.from_json(at, text)

    def publish(self, commit: Commit) -> None:
        """Add ``commit`` after the one it was made from; its number must be free."""
        jvm, gateway = self.spark._jvm, self.spark.sparkContext._gateway
        draft = self._path(f"commits/.{uuid.uuid4().hex}.tmp")
        out = self.fs.create(draft, False)
        try:
            out.write(bytearray(commit.to_json().encode()))
        finally:
            out.close()
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(
            draft.toUri(), self.spark._jsc.hadoopConfiguration())
        none = gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
        try:
            context.rename(draft, self._path(f"commits/{commit.number + 1:08d}.json"), none)
        except Exception as e:
            self.fs.delete(draft, False)
            raise CommitConflict(f"commit {commit.number + 1} of {self.root} is taken: {e}") from e
        commit.number += 1

    # -- reading -------------------------------------------------------------
    def read(self, number: int | None = None) -> DataFrame:
        """The table's rows; with ``number`` those of an earlier commit."""
        commit = self.current(number)
        if commit.schema is None:
            raise ValueError(f"{self.root} holds no table")
        target = commit.schema
        out = self.spark.createDataFrame([], target)
        groups: dict[str, list[tuple[int, int, str]]] = {}
        for (y, w), v in sorted(commit.periods.items()):
            groups.setdefault(json.dumps(commit.versions[v].jsonValue()), []).append((y, w, v))
        keys = [T.StructField(k, T.IntegerType()) for k in KEYS]
        for columns, places in groups.items():
            held = T.StructType(T.StructType.fromJson(json.loads(columns)).fields + keys)
            paths = [f"{self.root}/data/year_num={y}/week_num={w}/version={v}" for y, w, v in places]
            rows = self.spark.read.schema(held).option("basePath", f"{self.root}/data").parquet(*paths)
            types = {f.name.lower(): f.dataType for f in held.fields}
            cols = []
            for f in target.fields:
                kind = types.get(f.name.lower())
                c = F.lit(None) if kind is None else F.col(quoted(f.name))
                if kind is not None and kind != f.dataType and isinstance(f.dataType, T.StringType):
                    c = number_to_text(c, kind)
                cols.append(c.cast(f.dataType).alias(f.name))
            out = out.unionByName(rows.select(*cols))
        return out

    def schema(self) -> T.StructType | None:
        return self.current().schema

    # -- changes -------------------------------------------------------------
    def _evolved(self, commit: Commit, df: DataFrame) -> T.StructType:
        """The table's columns for ``df``: absent ones added, whole-number columns that
        receive text other than dates turned into text."""
        keys = [T.StructField(k, T.IntegerType()) for k in KEYS]
        if commit.schema is None:
            return T.StructType(unmatched(T.StructType(keys), df) + keys)
        fields = [f for f in commit.schema.fields if f.name not in KEYS]
        if self.auto_evolve:
            fields += unmatched(commit.schema, df)
        numbers = [f.name for f in fields if isinstance(f.dataType, _INTEGRAL)]
        df, have = matched(df, numbers)
        texts = [(n, c) for n, (c, t) in have.items() if isinstance(t, T.StringType)]
        if texts:
            told = df.agg(*[F.bool_or(~c.rlike(DATE_TEXT_PATTERN)).alias(f"t{i}")
                            for i, (_, c) in enumerate(texts)]).first()
            wide = {n for i, (n, _) in enumerate(texts) if told[f"t{i}"]}
            fields = [T.StructField(f.name, T.StringType()) if f.name in wide else f for f in fields]
        return T.StructType(fields + keys)

    def setup(self, df: DataFrame) -> None:
        commit = self.current()
        schema = self._evolved(commit, df.limit(0))
        if schema != commit.schema:
            commit.schema = schema
            self.publish(commit)

    def _write(self, df: DataFrame, schema: T.StructType, version: str) -> dict[tuple[int, int], int]:
        """Write ``df`` as a version; rows of each period.  The counts are read from the
        files' footers' row counts, for the folders of this version alone."""
        rows = fitted(df, schema).withColumn("version", F.lit(version))
        rows.hint("rebalance", *KEYS).write.mode("append") \
            .partitionBy(*KEYS, "version").parquet(f"{self.root}/data")
        held = T.StructType([f for f in schema.fields if f.name not in KEYS]
                            + [T.StructField(k, T.IntegerType()) for k in KEYS])
        wanted = self._path(f"data/year_num=*/week_num=*/version={version}")
        found = [s.getPath() for s in (self.fs.globStatus(wanted) or [])]
        if not found:
            return {}
        written = self.spark.read.schema(held).option("basePath", f"{self.root}/data") \
            .parquet(*[p.toString() for p in found])
        return {(r.year_num, r.week_num): r["count"] for r in written.groupBy(*KEYS).count().collect()}

    def upsert(self, df: DataFrame) -> int:
        """Replace every period that ``df`` holds; others stay.  Rows without a period
        are refused."""
        commit, version = self.current(), uuid.uuid4().hex[:16]
        schema = self._evolved(commit, df)
        counts = self._write(df, schema, version)
        if any(k is None for period in counts for k in period):
            raise ValueError("rows without a year or a week")
        if not counts and schema == commit.schema:
            return 0
        commit.schema = schema
        commit.versions[version] = T.StructType([f for f in schema.fields if f.name not in KEYS])
        commit.periods.update({period: version for period in counts})
        self.publish(commit)
        return sum(counts.values())

    def insert(self, df: DataFrame) -> int:
        """Add rows: the periods touched are written again with what they hold."""
        commit = self.current()
        if commit.schema is None or not commit.periods:
            return self.upsert(df)
        touched = df.select(*KEYS).distinct()
        old = self.read().join(touched, list(KEYS), "left_semi")
        new = fitted(df, self._evolved(commit, df))
        return self.upsert(fitted(old, new.schema).unionByName(new)) - old.count()

    def delete_period(self, year: int, week: int) -> None:
        commit = self.current()
        if commit.periods.pop((year, week), None) is not None:
            self.publish(commit)

    def vacuum(self, keep: int = 2) -> int:
        """Remove commits before the newest ``keep`` and the versions that no kept commit
        names.  Not to be run beside a writer, whose version is not named yet.  Returns the
        number of folders removed."""
        numbers = self._numbers()
        kept = [self.current(n) for n in numbers[-keep:]]
        named = {(y, w, v) for c in kept for (y, w), v in c.periods.items()}
        removed = 0
        for s in self.fs.globStatus(self._path("data/year_num=*/week_num=*/version=*")) or []:
            parts = [p.partition("=")[2] for p in s.getPath().toString().split("/")[-3:]]
            if parts[0].lstrip("-").isdigit() and (int(parts[0]), int(parts[1]), parts[2]) not in named:
                self.fs.delete(s.getPath(), True)
                removed += 1
        for n in numbers[:-keep]:
            self.fs.delete(self._path(f"commits/{n:08d}.json"), False)
        return removed

    def close(self) -> None:
        pass
