"""Catalog table sink, partitioned by (year_num, week_num).

* setup   -- CREATE TABLE from the frame's schema when absent, then add
             any new columns (``ALTER TABLE ADD COLUMNS``; a refused add is
             logged and skipped).
* widen   -- a BIGINT column that now receives non-date text becomes
             STRING.  File-source tables cannot ALTER a column's type, so
             the table is rewritten once with the column cast to text.
* delete  -- one period: a static ``INSERT OVERWRITE ... PARTITION`` with
             no rows removes the partition's files and its catalog entry.
* insert  -- append; only the table's columns, coerced to its types.
* upsert  -- dynamic partition overwrite: every period present in the
             frame is replaced, every other period is left alone, an empty
             frame touches nothing.  Re-running gives the same table.
"""

from __future__ import annotations

import logging
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weekmart.functions.values import (
    DATE_TEXT_PATTERN, coerce_column, number_to_text, text_to_serial,
)
from weekmart.operators.columns import matched, unmatched
from weekmart.sinks.base import counted, observed_rows
from weekmart.sinks.dialects import column_ddl

log = logging.getLogger("weekmart")
KEYS = ("year_num", "week_num")
_INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def _q(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _qt(table: str) -> str:
    return ".".join(_q(p) for p in table.split("."))


def fitted(df: DataFrame, target: T.StructType) -> DataFrame:
    """``df`` as the target's columns, matched by name whatever their case, coerced to
    its types; absent ones are null."""
    df, have = matched(df, target.fieldNames())
    cols = []
    for f in target.fields:
        if f.name not in have:
            cols.append(F.lit(None).cast(f.dataType).alias(f.name))
            continue
        c, src = have[f.name]
        if isinstance(f.dataType, _INTEGRAL) and isinstance(src, T.StringType):
            c = F.coalesce(text_to_serial(c), coerce_column(c, src, f.dataType))
        elif src != f.dataType:
            c = coerce_column(c, src, f.dataType)
        cols.append(c.cast(f.dataType).alias(f.name))
    return df.select(*cols)


class TableSink:
    def __init__(self, spark: SparkSession, table: str, location: str | None = None,
                 keys: tuple[str, ...] = KEYS, name: str | None = None, evolve: bool = True):
        self.spark, self.table, self.location, self.keys = spark, table, location, tuple(keys)
        self.auto_evolve = evolve
        self.name = name or f"table:{table}"

    # -- catalog ---------------------------------------------------------
    def exists(self) -> bool:
        return self.spark.catalog.tableExists(self.table)

    def schema(self) -> T.StructType:
        self.spark.catalog.refreshTable(self.table)
        return self.spark.table(self.table).schema

    def read(self) -> DataFrame:
        # Another session (a stream's batch, another job) may have replaced
        # partitions: drop the cached file listing first.
        self.spark.catalog.refreshTable(self.table)
        return self.spark.table(self.table)

    def setup(self, df: DataFrame) -> None:
        if not self.exists():
            data = unmatched(T.StructType([T.StructField(k, T.IntegerType()) for k in self.keys]), df)
            keys = [T.StructField(k, T.IntegerType()) for k in self.keys]
            ddl = column_ddl(T.StructType(data + keys), "spark")
            loc = f" LOCATION '{self.location}'" if self.location else ""
            parts = ", ".join(_q(k) for k in self.keys)
            self.spark.sql(f"CREATE TABLE IF NOT EXISTS {_qt(self.table)} ({ddl}) "
                           f"USING parquet PARTITIONED BY ({parts}){loc}")
        if self.auto_evolve:
            self.evolve(df)

    def evolve(self, df: DataFrame) -> list[str]:
        added = []
        for f in unmatched(self.schema(), df):
            try:
                self.spark.sql(f"ALTER TABLE {_qt(self.table)} ADD COLUMNS "
                               f"({column_ddl(T.StructType([f]), 'spark')})")
                added.append(f.name)
            except Exception as e:  # noqa: BLE001 - a refused add is skipped
                log.warning("could not add column %s: %s", f.name, e)
        return added

    # -- type widening -----------------------------------------------------
    def columns_to_widen(self, df: DataFrame) -> list[str]:
        """Integer columns of the table that receive text which is not a date.
        One aggregate pass over the incoming frame decides for all columns."""
        numbers = [f.name for f in self.schema().fields
                   if isinstance(f.dataType, _INTEGRAL) and f.name not in self.keys]
        df, have = matched(df, numbers)
        cands = [(n, c) for n, (c, t) in have.items() if isinstance(t, T.StringType)]
        if not cands:
            return []
        row = df.agg(*[F.max(F.when(c.isNotNull() & ~c.rlike(DATE_TEXT_PATTERN), 1)).alias(f"w{i}")
                       for i, (_, c) in enumerate(cands)]).first()
        return [n for i, (n, _) in enumerate(cands) if row[f"w{i}"] == 1]

    def widen(self, df: DataFrame) -> list[str]:
        cols = self.columns_to_widen(df)
        if not cols:
            return []
        old = self.read()
        new = old.select(*[
            number_to_text(F.col(_q(f.name)), f.dataType).alias(f.name) if f.name in cols
            else F.col(_q(f.name)) for f in old.schema.fields])
        tmp = f"{self.table}__widen_{uuid.uuid4().hex[:8]}"
        loc = f" LOCATION '{self.location.rstrip('/')}_{uuid.uuid4().hex[:8]}'" if self.location else ""
        ddl = column_ddl(new.schema, "spark")
        parts = ", ".join(_q(k) for k in self.keys)
        self.spark.sql(f"CREATE TABLE {_qt(tmp)} ({ddl}) USING parquet PARTITIONED BY ({parts}){loc}")
        new.write.insertInto(tmp, overwrite=True)
        self.spark.sql(f"DROP TABLE {_qt(self.table)}")
        self.spark.sql(f"ALTER TABLE {_qt(tmp)} RENAME TO {_qt(self.table)}")
        if self.location:
            self.location = loc.split("'")[1]
        log.warning("widened %s to STRING in %s", cols, self.table)
        return cols

    # -- rows --------------------------------------------------------------
    def prepare(self, df: DataFrame) -> DataFrame:
        """Project to the table's columns in its order, coerced to its types.
        Extra columns are dropped; absent ones are null."""
        return fitted(df, self.schema())

    def delete_period(self, year: int, week: int) -> None:
        """Remove one period, only when both key columns exist."""
        if not self.exists():
            return
        schema = self.schema()
        if not all(k in schema.fieldNames() for k in self.keys):
            return
        data = T.StructType([f for f in schema.fields if f.name not in self.keys])
        view = f"__weekmart_empty_{uuid.uuid4().hex[:8]}"
        self.spark.createDataFrame([], data).createOrReplaceTempView(view)
        spec = ", ".join(f"{_q(k)} = {int(v)}" for k, v in zip(self.keys, (year, week)))
        cols = ", ".join(_q(f.name) for f in data.fields)
        self.spark.sql(f"INSERT OVERWRITE TABLE {_qt(self.table)} PARTITION ({spec}) "
                       f"SELECT {cols} FROM {view}")
        self.spark.catalog.dropTempView(view)

    def clustered(self, df: DataFrame) -> DataFrame:
        """Cluster rows by period before the write: few files per partition
        directory.  REBALANCE lets AQE split a hot period's partition into
        several tasks and merge small ones, from measured shuffle sizes."""
        return df.hint("rebalance", *self.keys)

    def insert(self, df: DataFrame) -> int:
        self.setup(df)
        out, obs = counted(self.clustered(self.prepare(df)))
        out.write.insertInto(self.table)
        return observed_rows(obs)

    def upsert(self, df: DataFrame) -> int:
        self.setup(df)
        self.widen(df)
        out, obs = counted(self.clustered(self.prepare(df)))
        conf = self.spark.conf
        before = conf.get("spark.sql.sources.partitionOverwriteMode")
        conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
        try:
            out.write.insertInto(self.table, overwrite=True)
        finally:
            conf.set("spark.sql.sources.partitionOverwriteMode", before)
        return observed_rows(obs)

    def close(self) -> None:
        pass
