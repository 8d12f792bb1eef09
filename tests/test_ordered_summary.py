"""The summary dealt by ranges of the export's order: the same rows as the keyed one, and no
further exchange for the total order."""

import re

import pytest
from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from tests.test_plans import plan_text
from weekmart import oracle_sql as O
from weekmart.operators.filters import KEYS
from weekmart.plans.summary import sort_summary, weekly_summary


@pytest.fixture()
def no_broadcasts(spark):
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    yield spark
    spark.conf.set(key, before)


def odd_tables(spark, scratch):
    """Shared, blank and missing names, members that come twice, nulls in facts, equal facts."""
    for name in ("lineitem", "orders", "nation", "customer", "supplier", "part"):
        t = spark.read.parquet(f"{SF_SMALL}/{name}.parquet")
        if name == "lineitem":
            t = t.withColumns({
                "l_partkey": F.when(F.col("l_orderkey") % 19 != 0, F.col("l_partkey")),
                "l_returnflag": F.when(F.col("l_orderkey") % 7 != 0, F.col("l_returnflag")),
                "l_linestatus": F.when(F.col("l_orderkey") % 5 != 0, F.lit("F")),
                "l_shipdate": F.when(F.col("l_orderkey") % 23 != 0, F.col("l_shipdate")),
                "l_quantity": F.when(F.col("l_orderkey") % 3 != 0, F.col("l_quantity"))})
            t = t.unionByName(t.where("l_orderkey % 2 = 0")).unionByName(
                t.limit(20).withColumns({c: F.lit(None).cast("double") for c in (
                    "l_quantity", "l_extendedprice", "l_discount", "l_tax")}).withColumn("l_suppkey", F.lit(-1)))
        if name == "supplier":
            t = t.withColumn("s_name", F.when(F.col("s_suppkey") % 5 != 0, F.concat(F.lit("s"), F.col("s_suppkey") % 3)))
            t = t.unionByName(t.where("s_suppkey % 5 < 2"))
        if name == "customer":
            t = t.withColumns({"c_name": F.when(F.col("c_custkey") % 4 != 0, F.concat(F.lit("c"), F.col("c_custkey") % 6)),
                               "c_mktsegment": F.when(F.col("c_custkey") % 3 != 0, F.col("c_mktsegment")),
                               "c_nationkey": F.when(F.col("c_custkey") % 2 != 0, F.col("c_nationkey"))})
            t = t.where("c_custkey % 11 <> 0").unionByName(t.where("c_custkey % 12 < 2"))
        if name == "part":
            t = t.withColumn("p_name", F.lit("p")).where("p_partkey % 13 <> 0")
            t = t.unionByName(t.where("p_partkey % 4 = 0")).unionByName(
                t.where("p_partkey % 6 = 0").withColumns({"p_size": F.lit(None).cast("int"), "p_retailprice": F.lit(1.5)}))
        if name == "orders":
            t = t.withColumn("o_orderpriority", F.when(F.col("o_orderkey") % 9 != 0, F.col("o_orderpriority")))
            t = t.where("o_orderkey % 17 <> 0").unionByName(t.where("o_orderkey % 10 = 0"))
        t.write.parquet(f"{scratch}/{name}.parquet")
    return scratch


def test_same_rows_as_the_keyed_summary(spark, scratch):
    src = odd_tables(spark, scratch)
    for where in (src, SF_SMALL):
        want, got = weekly_summary(spark, where), weekly_summary(spark, where, ordered=True)
        assert got.dtypes == want.dtypes
        n = want.count()
        assert n and got.count() == n and got.exceptAll(want).count() == 0


def test_rows_come_in_the_total_order(spark, scratch):
    src = odd_tables(spark, scratch)
    keys = O.DIMS_SAFE + KEYS
    rows = sort_summary(weekly_summary(spark, src, ordered=True), keys).select(*[F.col(f"`{k}`") for k in keys]).collect()
    # Nulls first, as the export sorts; text by its bytes.
    place = [tuple((v is not None, v.encode() if isinstance(v, str) else v or 0) for v in r) for r in rows]
    assert len(place) > 100 and place == sorted(place)


def test_the_total_order_takes_no_exchange_of_whole_rows(no_broadcasts):
    from weekmart.registry import QUERIES
    text = plan_text(QUERIES["weekly_sales_sorted"](no_broadcasts, SF_SMALL))
    above = text[:text.index("HashAggregate")]
    assert "Sort [" in above and not re.search(r"Exchange (hash|range)", above)
    assert len(re.findall("Exchange rangepartitioning", text)) == 1
    # The fact: by supplier, order and part, then by the order's ranges.
    assert len(re.findall(r"Exchange hashpartitioning\(l_", text)) == 3
