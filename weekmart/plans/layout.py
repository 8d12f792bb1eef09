"""Storage layout for repeated weekly runs at scale.

``build_sales_layout`` writes, once (and then per new week):

* ``lineitem`` partitioned by ISO (year_num, week_num) -- a period run reads
  only its week directories (partition pruning, no row-group guessing) --
  and bucketed + sorted by ``l_orderkey``;
* ``order_dim`` -- the collapsed snowflake arm orders -> customer -> nation --
  bucketed + sorted by ``o_orderkey`` with the same bucket count.

The cube's largest join (fact to order arm) then needs no shuffle on either
side: both scans already deliver matching buckets in key order.  Part and
supplier stay plain tables (broadcast when Spark finds them small, shuffled
otherwise).  Tables are catalog tables whose files live under ``location``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weekmart.operators.filters import with_period
from weekmart.plans.sales_cube import order_dimension, read_table

CATALOG_PREFIX = "catalog:"


def clustered_for_buckets(df: DataFrame, key: str, buckets: int, *parts: str) -> DataFrame:
    """Bring each (partition values, bucket) group into few writer tasks
    before a bucketed write, so the table gets about one file per group
    instead of one per group per scan task.  The bucket id is the one
    Spark's bucketed writer computes (``pmod(hash(key), n)``); REBALANCE
    lets AQE split a hot week's buckets over several tasks (several files
    in one bucket are fine for bucketed reads)."""
    b = "__bucket"
    out = df.withColumn(b, F.expr(f"pmod(hash(`{key}`), {int(buckets)})"))
    return out.hint("rebalance", *parts, b).drop(b)


def build_sales_layout(spark: SparkSession, sf_dir: str, database: str, location: str,
                       buckets: int = 64) -> str:
    """Write the layout; returns the source string the cube reads it from
    (``catalog:<database>``)."""
    loc = location.rstrip("/")
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}` LOCATION '{loc}'")
    li = with_period(read_table(spark, sf_dir, "lineitem"), "l_shipdate")
    li = clustered_for_buckets(li, "l_orderkey", buckets, "year_num", "week_num")
    (li.write.mode("overwrite")
       .partitionBy("year_num", "week_num")
       .bucketBy(buckets, "l_orderkey").sortBy("l_orderkey")
       .option("path", f"{loc}/lineitem")
       .saveAsTable(f"`{database}`.`lineitem`"))
    orders = clustered_for_buckets(order_dimension(spark, sf_dir), "o_orderkey", buckets)
    (orders.write.mode("overwrite")
       .bucketBy(buckets, "o_orderkey").sortBy("o_orderkey")
       .option("path", f"{loc}/order_dim")
       .saveAsTable(f"`{database}`.`order_dim`"))
    for name in ("part", "supplier", "customer", "nation"):
        (read_table(spark, sf_dir, name).write.mode("overwrite")
           .option("path", f"{loc}/{name}")
           .saveAsTable(f"`{database}`.`{name}`"))
    return CATALOG_PREFIX + database
