"""Hot keys: one key holding a third of all rows must not land in one task."""

import contextlib
import io
import os

from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from weekmart.operators.joins import join_dimension
from weekmart.plans.sales_cube import read_table
from weekmart.sinks.table import TableSink

SKEW_CONF = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
}


@contextlib.contextmanager
def conf(spark, values):
    saved = {k: spark.conf.get(k, None) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in saved.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def hot_fact(spark):
    """lineitem with a third of its rows moved onto one part key and one week."""
    li = read_table(spark, SF_SMALL, "lineitem")
    hot = F.col("l_orderkey") % 3 == 0
    out = (li.withColumn("l_partkey", F.when(hot, F.lit(7)).otherwise(F.col("l_partkey")))
             .withColumn("year_num", F.when(hot, F.lit(1999)).otherwise(F.lit(2000)))
             .withColumn("week_num", F.when(hot, F.lit(10)).otherwise((F.col("l_orderkey") % 52 + 1).cast("int"))))
    # The small table is one file (one input split); AQE splits a skewed
    # partition along map outputs, so stand in for many splits.
    return out.repartition(8)


def test_hot_join_key_is_split(spark):
    with conf(spark, SKEW_CONF):
        part = read_table(spark, SF_SMALL, "part")
        joined = join_dimension(hot_fact(spark), part, "l_partkey", "p_partkey")
        n = len(joined.collect())          # runs this plan; explain() then shows the final one
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            joined.explain()
        assert n == hot_fact(spark).count()
        assert "skew=true" in buf.getvalue()


def test_hot_period_is_written_by_several_tasks(spark, scratch):
    with conf(spark, {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "2k"}):
        t = TableSink(spark, "t_hot_" + scratch.rsplit("-", 1)[-1], location=f"{scratch}/t")
        # several input files = several map tasks (a repartition here would be
        # folded into the sink's own rebalance)
        hot_fact(spark).select("l_orderkey", "l_linenumber", "l_quantity", "year_num", "week_num") \
            .write.parquet(f"{scratch}/hot_input")
        df = spark.read.parquet(f"{scratch}/hot_input")
        t.upsert(df)
        hot_dir = f"{scratch.removeprefix('file:')}/t/year_num=1999/week_num=10"
        files = [f for f in os.listdir(hot_dir) if f.endswith(".parquet")]
        assert len(files) > 1
        assert t.read().count() == df.count()


def test_hot_group_is_combined_before_the_shuffle(spark):
    from weekmart.plans.summary import summarize
    fact = hot_fact(spark)
    out = summarize(fact, ["year_num", "week_num"], [("qty", F.col("l_quantity"))])
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        out.explain()
    text = buf.getvalue()
    # map-side combine first: a task sends one row per group, however hot
    assert text.index("Exchange hashpartitioning(year_num") < text.index("partial_sum(")
    # brute force over the same rows
    pdf = fact.select("year_num", "week_num", "l_quantity").toPandas()
    want = {(int(y), int(w)): q for (y, w), q in pdf.groupby(["year_num", "week_num"])["l_quantity"].sum().items()}
    got = {(r.year_num, r.week_num): r.qty for r in out.collect()}
    assert got.keys() == want.keys()
    assert all(abs(got[k] - want[k]) < 1e-6 for k in want)
    assert want[(1999, 10)] > 0.3 * pdf["l_quantity"].sum()
