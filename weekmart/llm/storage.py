"""Intermediate tables in the shared checkpoint folder: they cut the lineage and
survive a lost executor."""

from __future__ import annotations

from pyspark.sql import DataFrame

from weekmart.session import scratch_dir


def stored(df: DataFrame) -> DataFrame:
    """``df`` written as Parquet under ``spark.checkpoint.dir`` and read back."""
    spark = df.sparkSession
    path = scratch_dir(spark, "llm") + "/t"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
