"""Column types of each target dialect, from a Spark schema."""

from __future__ import annotations

from pyspark.sql import types as T

# Target column type per source type family, per dialect.
# Families: integer, float, boolean, timestamp, date, text.
TYPE_MAPS = {
    "clickhouse": {"integer": "Int64", "float": "Float64", "boolean": "UInt8",
                   "timestamp": "DateTime", "date": "Date", "text": "Nullable(String)"},
    "duckdb": {"integer": "BIGINT", "float": "DOUBLE", "boolean": "BOOLEAN",
               "timestamp": "TIMESTAMP", "date": "DATE", "text": "VARCHAR"},
    "postgresql": {"integer": "BIGINT", "float": "DOUBLE PRECISION", "boolean": "BOOLEAN",
                   "timestamp": "TIMESTAMP", "date": "DATE", "text": "TEXT"},
    "spark": {"integer": "BIGINT", "float": "DOUBLE", "boolean": "BOOLEAN",
              "timestamp": "TIMESTAMP", "date": "DATE", "text": "STRING"},
    "derby": {"integer": "BIGINT", "float": "DOUBLE", "boolean": "BOOLEAN",
              "timestamp": "TIMESTAMP", "date": "DATE", "text": "VARCHAR(32672)"},
}
QUOTES = {"clickhouse": "`", "duckdb": '"', "postgresql": '"', "spark": "`", "derby": '"'}


def type_family(t: T.DataType) -> str:
    if isinstance(t, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return "integer"
    if isinstance(t, (T.FloatType, T.DoubleType, T.DecimalType)):
        return "float"
    if isinstance(t, T.BooleanType):
        return "boolean"
    if isinstance(t, (T.TimestampType, T.TimestampNTZType)):
        return "timestamp"
    if isinstance(t, T.DateType):
        return "date"
    return "text"


def column_type(t: T.DataType, dialect: str) -> str:
    if dialect == "spark":
        # Our own tables keep the exact Spark type; a column without any value
        # has none yet, and text can hold whatever comes later.
        if isinstance(t, T.NullType):
            return TYPE_MAPS["spark"]["text"]
        return t.simpleString()
    return TYPE_MAPS[dialect][type_family(t)]


def quote(name: str, dialect: str) -> str:
    q = QUOTES[dialect]
    return q + name.replace(q, q + q) + q


def column_ddl(schema: T.StructType, dialect: str) -> str:
    return ", ".join(f"{quote(f.name, dialect)} {column_type(f.dataType, dialect)}"
                     for f in schema.fields)


def create_table_sql(table: str, schema: T.StructType, dialect: str,
                     keys: tuple[str, ...] = ("year_num", "week_num")) -> str:
    """CREATE TABLE text for a dialect; ClickHouse gets a MergeTree ordered
    by the period keys (or ``tuple()`` when they are absent)."""
    cols = column_ddl(schema, dialect)
    if dialect == "clickhouse":
        present = [k for k in keys if k in schema.fieldNames()]
        order = ", ".join(quote(k, dialect) for k in present) or "tuple()"
        return (f"CREATE TABLE IF NOT EXISTS {table} ({cols}) "
                f"ENGINE = MergeTree() ORDER BY ({order})")
    if dialect == "derby":
        return f"CREATE TABLE {table} ({cols})"
    return f"CREATE TABLE IF NOT EXISTS {table} ({cols})"
