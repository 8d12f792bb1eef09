"""Word splitting and small helpers shared by the text operators (JVM built-ins)."""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The separator classes of the two word definitions.
SPACE_SEPARATORS = r"[\x20\x09-\x0D]+"
ALNUM_SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
SPACE_CHARS = " \t\n\x0b\x0c\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def lower_ascii(text: Column) -> Column:
    """Lower-case A-Z only.  Pure ASCII text takes Spark's fast path."""
    ascii_only = F.octet_length(text) == F.char_length(text)
    return F.when(ascii_only, F.lower(text)).otherwise(
        F.translate(text, string.ascii_uppercase, string.ascii_lowercase))


def space_words(text: Column) -> Column:
    """Words ``[^\\x20\\x09-\\x0D]+``; null text has none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACE_SEPARATORS), "")


def alnum_words(text: Column) -> Column:
    """Lower-cased words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+``; null text has none."""
    return F.array_remove(
        F.split(lower_ascii(F.coalesce(text, F.lit(""))), ALNUM_SEPARATORS), "")


def computed_once(value: Column) -> Column:
    """``value`` as a column that the optimizer neither copies into the filters
    above it nor merges with other projections.  The partition number is what
    makes it so; it does not change the value."""
    return F.when(F.spark_partition_id() >= 0, value)


def by_shuffle(df: DataFrame) -> DataFrame:
    """``df`` as a join side that goes with its partner by shuffle, never to the driver.
    Spark's size estimate counts neither the rows that an explode makes nor how well a
    file was compressed, so such a side can be far larger than a broadcast may be."""
    return df.hint("merge")


def free_name(columns: list[str], wanted: str) -> str:
    """``wanted``, prefixed with ``_`` until it clashes with no column."""
    taken = {c.lower() for c in columns}
    while wanted.lower() in taken:
        wanted = "_" + wanted
    return wanted
