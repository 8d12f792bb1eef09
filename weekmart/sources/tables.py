"""What a table's columns hold."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def column_facts(df: DataFrame, types: dict[str, str] | None = None) -> DataFrame:
    """(column, type, filled): each column's type (or its entry in ``types``) and
    the number of rows that hold a value, counted in one pass."""
    counts = df.agg(*[F.count(F.col(f"`{f.name}`")).alias(f"n{i}") for i, f in enumerate(df.schema.fields)])
    rows = [F.struct(F.lit(f.name).alias("column"),
                     F.lit((types or {}).get(f.name, f.dataType.simpleString())).alias("type"),
                     F.col(f"n{i}").alias("filled")) for i, f in enumerate(df.schema.fields)]
    return counts.select(F.inline(F.array(*rows)))
