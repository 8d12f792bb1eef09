"""JDBC targets (PostgreSQL, ClickHouse, ...).

A load goes through a staging table beside the target:

1. The frame is matched to the target's columns (case aside) and coerced to their types.
2. Spark's JDBC writer appends it to a fresh staging table, over at most
   ``max_connections`` connections; its row count must be what the tasks counted, as a task
   that committed and was run again would have added its rows twice.
3. On one connection the target's rows of the staged periods are deleted and the staged rows
   inserted.  Where the store has transactions this is one; ClickHouse has none, so there it
   goes period by period and a failure leaves one period at most without its rows.
4. The staging table is dropped, whatever happened.

So no failure before the last step touches the target.  DDL and these statements run on
the driver through ``java.sql.DriverManager`` (a classic, non-Connect session).  The
database's driver jar is supplied by the user (``spark.jars``).
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from weekmart.functions.names import match_names
from weekmart.functions.values import coerce
from weekmart.operators.columns import unmatched
from weekmart.sinks.base import counted, observed_rows
from weekmart.sinks.dialects import create_table_sql, quote

KEYS = ("year_num", "week_num")


def delete_period_sql(table: str, dialect: str, keys=KEYS) -> str:
    """Parameterised delete of one period; identifiers quoted."""
    cond = " AND ".join(f"{quote(k, dialect)} = ?" for k in keys)
    return f"DELETE FROM {table} WHERE {cond}"


def add_column_sql(table: str, field: T.StructField, dialect: str) -> str:
    from weekmart.sinks.dialects import column_type
    col = f"{quote(field.name, dialect)} {column_type(field.dataType, dialect)}"
    if dialect in ("postgresql", "duckdb", "clickhouse"):
        return f"ALTER TABLE {table} ADD COLUMN IF NOT EXISTS {col}"
    return f"ALTER TABLE {table} ADD COLUMN {col}"


def load_statements(table: str, staging: str, columns: list[str], dialect: str,
                    keys: list[str]) -> list[str]:
    """Replace the staged periods: a delete and an insert from the staging table."""
    q = [quote(k, dialect) for k in keys]
    same = " AND ".join(f"s.{k} = {table}.{k}" for k in q)
    names = ", ".join(quote(c, dialect) for c in columns)
    out = [f"DELETE FROM {table} WHERE EXISTS (SELECT 1 FROM {staging} s WHERE {same})"] if keys else []
    return out + [f"INSERT INTO {table} ({names}) SELECT {names} FROM {staging}"]


def period_statements(table: str, staging: str, columns: list[str], dialect: str,
                      keys: list[str], period: tuple) -> list[str]:
    """The same for one period of a store without transactions."""
    only = " AND ".join(f"{quote(k, dialect)} = {int(v)}" for k, v in zip(keys, period))
    names = ", ".join(quote(c, dialect) for c in columns)
    return [f"DELETE FROM {table} WHERE {only}",
            f"INSERT INTO {table} ({names}) SELECT {names} FROM {staging} WHERE {only}"]


class JdbcSink:
    def __init__(self, spark: SparkSession, url: str, table: str, dialect: str = "postgresql",
                 properties: dict | None = None, batchsize: int = 10_000, name: str | None = None,
                 max_connections: int = 16):
        self.spark, self.url, self.table, self.dialect = spark, url, table, dialect
        self.properties = dict(properties or {})
        self.batchsize, self.max_connections = batchsize, max_connections
        self.name = name or f"jdbc:{dialect}:{table}"
        self._schema: T.StructType | None = None

    # driver-side statements ------------------------------------------------
    def _connection(self):
        jvm = self.spark.sparkContext._jvm
        props = jvm.java.util.Properties()
        for k, v in self.properties.items():
            props.setProperty(k, str(v))
        return jvm.java.sql.DriverManager.getConnection(self.url, props)

    def _execute(self, sql: str, params: tuple = ()) -> None:
        conn = self._connection()
        try:
            st = conn.prepareStatement(sql)
            for i, p in enumerate(params, 1):
                st.setObject(i, p)
            st.execute()
            st.close()
        finally:
            conn.close()

    def _execute_batch(self, sql: str, rows: list[tuple]) -> None:
        """One prepared statement, every parameter row in one batch and one
        transaction: a run's period deletes cost one connection, not one
        per period, and either all of them happen or none."""
        if not rows:
            return
        conn = self._connection()
        try:
            conn.setAutoCommit(False)
            st = conn.prepareStatement(sql)
            try:
                for params in rows:
                    for i, p in enumerate(params, 1):
                        st.setObject(i, p)
                    st.addBatch()
                st.executeBatch()
                conn.commit()
            except Exception:
                conn.rollback()
                raise
            finally:
                st.close()
        finally:
            conn.close()

    def _query(self, conn, sql: str) -> list[tuple]:
        """A statement's rows, of a few whole numbers each."""
        st = conn.prepareStatement(sql)
        try:
            found, out = st.executeQuery(), []
            width = found.getMetaData().getColumnCount()
            while found.next():
                out.append(tuple(found.getLong(i + 1) for i in range(width)))
            return out
        finally:
            st.close()

    def _transaction(self, conn, statements: list[str]) -> None:
        """The statements together, or none of them where the store can undo."""
        conn.setAutoCommit(self.dialect == "clickhouse")
        try:
            for sql in statements:
                st = conn.prepareStatement(sql)
                try:
                    st.execute()
                finally:
                    st.close()
            if self.dialect != "clickhouse":
                conn.commit()
        except Exception:
            if self.dialect != "clickhouse":
                conn.rollback()
            raise

    def exists(self) -> bool:
        """Whether the store knows the table; a store that cannot be asked raises."""
        schema, _, name = self.table.replace('"', "").replace("`", "").rpartition(".")
        conn = self._connection()
        try:
            found = conn.getMetaData().getTables(None, schema or None, name, None)
            try:
                return bool(found.next())
            finally:
                found.close()
        finally:
            conn.close()

    def schema(self) -> T.StructType | None:
        self._schema = None
        if self.exists():
            r = self.spark.read.format("jdbc").option("url", self.url).option("dbtable", self.table)
            for k, v in self.properties.items():
                r = r.option(k, v)
            self._schema = r.load().schema
        return self._schema

    def setup(self, df: DataFrame) -> None:
        have = self.schema()
        if have is None:
            self._execute(create_table_sql(self.table, df.schema, self.dialect))
            self.schema()
            return
        for f in unmatched(have, df):
            try:
                self._execute(add_column_sql(self.table, f, self.dialect))
            except Exception:  # noqa: BLE001 - skipped, as a refused add
                pass
        self.schema()

    def delete_period(self, year: int, week: int) -> None:
        have = self._schema or self.schema()
        if have is None or len(match_names(have.fieldNames(), list(KEYS))) < len(KEYS):
            return
        self._execute(delete_period_sql(self.table, self.dialect), (int(year), int(week)))

    def _write_rows(self, df: DataFrame, table: str) -> int:
        """Append to a table over a bounded number of connections; the rows counted."""
        out, obs = counted(df.coalesce(self.max_connections))
        w = (out.write.format("jdbc").mode("append").option("url", self.url)
             .option("dbtable", table).option("batchsize", self.batchsize))
        for k, v in self.properties.items():
            w = w.option(k, v)
        w.save()
        return observed_rows(obs)

    def _staged(self, df: DataFrame, replace: bool) -> int:
        target = self._schema or self.schema()
        if target is None:
            raise RuntimeError(f"{self.table} does not exist")
        rows = coerce(df, target)
        keys = [target.fieldNames()[i] for i in match_names(target.fieldNames(), list(KEYS)).values()]
        if len(keys) < len(KEYS) or not replace:
            keys = []
        staging = f"{self.table}__stage_{uuid.uuid4().hex[:8]}"
        self._execute(create_table_sql(staging, rows.schema, self.dialect))
        try:
            sent = self._write_rows(rows, staging)
            conn = self._connection()
            try:
                held = self._query(conn, f"SELECT COUNT(*) FROM {staging}")[0][0]
                if held != sent:
                    raise RuntimeError(f"{staging} holds {held} rows, but {sent} were sent; nothing was loaded")
                names = rows.columns
                if self.dialect == "clickhouse" and keys:
                    columns = ", ".join(quote(k, self.dialect) for k in keys)
                    for period in self._query(conn, f"SELECT DISTINCT {columns} FROM {staging} ORDER BY {columns}"):
                        self._transaction(conn, period_statements(
                            self.table, staging, names, self.dialect, keys, period))
                else:
                    self._transaction(conn, load_statements(self.table, staging, names, self.dialect, keys))
            finally:
                conn.close()
        finally:
            self._execute(f"DROP TABLE {staging}")
        return sent

    def insert(self, df: DataFrame) -> int:
        if self._schema is None:
            self.setup(df)
        return self._staged(df, replace=False)

    def upsert(self, df: DataFrame, periods=None) -> int:
        """Replace every period that the frame holds.  The staging table tells which
        those are; ``periods`` is not needed any more."""
        self.setup(df)
        return self._staged(df, replace=True)

    def close(self) -> None:
        pass
