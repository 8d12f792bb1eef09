"""Column-set operators against a target schema.

Columns are matched by name without regard to case, as Spark's own resolver does.
Of several columns that differ only in case, the one spelled like the target's is
meant, else the first; the output takes the target's spelling."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weekmart.functions.names import match_names


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def matched(df: DataFrame, wanted: list[str]) -> tuple[DataFrame, dict[str, tuple[Column, T.DataType]]]:
    """``df`` and, for each wanted name that it has, the column meant and its type.
    Where columns of ``df`` differ only in case, it comes back with numbered names,
    as a name alone would not tell them apart."""
    fields = df.schema.fields
    places = match_names([f.name for f in fields], wanted)
    if len({f.name.lower() for f in fields}) < len(fields):
        df = df.toDF(*[f"c{i}" for i in range(len(fields))])
        return df, {n: (F.col(f"c{i}"), fields[i].dataType) for n, i in places.items()}
    return df, {n: (F.col(quoted(fields[i].name)), fields[i].dataType) for n, i in places.items()}


def unmatched(have: T.StructType, df: DataFrame) -> list[T.StructField]:
    """The columns of ``df`` that ``have`` lacks, each name once."""
    out: dict[str, T.StructField] = {}
    taken = {n.lower() for n in have.fieldNames()}
    for f in df.schema.fields:
        if f.name.lower() not in taken:
            out.setdefault(f.name.lower(), f)
    return list(out.values())


def align_columns(df: DataFrame, target: T.StructType | list[str]) -> DataFrame:
    """Keep only the columns the target has, in the target's order (columns
    the target lacks are dropped; target columns the frame lacks are not
    invented)."""
    names = target.fieldNames() if isinstance(target, T.StructType) else list(target)
    df, have = matched(df, names)
    return df.select(*[have[n][0].alias(n) for n in names if n in have])
