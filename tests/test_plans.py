"""Plan shape checks: the properties that matter at scale."""

import contextlib
import datetime as dt
import io

from tests.conftest import SF_SMALL
from weekmart.plans import periods as P
from weekmart.plans.sales_cube import sales_cube
from weekmart.plans.summary import cube_summary, weekly_summary


def plan_text(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    return buf.getvalue()


def test_period_filter_reaches_the_scan(spark):
    weeks = P.last_quarter(spark, dt.date(2000, 3, 15))
    text = plan_text(weekly_summary(spark, SF_SMALL, periods=weeks))
    assert "GreaterThanOrEqual(l_shipdate" in text and "LessThan(l_shipdate" in text


def test_unused_dimension_arms_are_not_joined(spark):
    cube = sales_cube(spark, SF_SMALL, dims=["Goods[fg1_name]"])
    text = plan_text(cube_summary(cube, dims=["Goods[fg1_name]"]))
    assert "orders.parquet" not in text and "customer.parquet" not in text
    assert "supplier.parquet" not in text and "part.parquet" in text


def test_summary_aggregates_before_the_shuffle(spark):
    text = plan_text(weekly_summary(spark, SF_SMALL))
    assert "partial_sum" in text
    # the scan reads only the columns the summary needs
    assert "l_comment" not in text


def test_fact_rows_carry_no_names_through_exchanges(spark):
    """Without broadcasts: below the aggregation every exchange holds keys, codes and
    numbers only, and the names are looked up on the summed rows."""
    import re
    names = ("p_name", "p_type", "p_brand", "s_name", "c_name", "n_name", "c_mktsegment", "Agents_hybrid[name]",
             "Markets[doc_prefix_original]", "Channel_type[sell_channel_type_name]", "payment_code", "basis")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = weekly_summary(spark, SF_SMALL)
        plan = df._jdf.queryExecution().sparkPlan()
        found = []

        def holds_fact(node):
            return "l_quantity" in node.toString()

        def visit(node, below_sum):
            kind = node.nodeName()
            below_sum = below_sum or (kind.endswith("HashAggregate") and "__sum" in node.toString().split("\n")[0])
            output = re.findall(r"([^, ()]+)#\d+", node.output().mkString(", "))
            if below_sum and holds_fact(node) and kind.endswith(("Join", "HashAggregate", "Project")):
                found.append(output)
            for i in range(node.children().size()):
                visit(node.children().apply(i), below_sum)

        visit(plan, False)
        assert len(found) > 4
        assert not [o for o in found if set(o) & set(names)]
        text = plan_text(df)
        assert "partial_sum" in text and text.count("Exchange hashpartitioning(l_orderkey") == 1
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_members_that_share_their_names_share_a_group(spark, scratch):
    """Two suppliers, customers and parts of equal names, blank names and missing
    members: the same rows as grouping the joined cube."""
    from pyspark.sql import functions as F
    for name in ("lineitem", "orders", "nation", "customer", "supplier", "part"):
        t = spark.read.parquet(f"{SF_SMALL}/{name}.parquet")
        if name == "supplier":
            t = t.withColumn("s_name", F.when(F.col("s_suppkey") % 5 != 0, F.concat(F.lit("s"), F.col("s_suppkey") % 3)))
        if name == "customer":
            t = t.withColumn("c_name", F.when(F.col("c_custkey") % 4 != 0, F.concat(F.lit("c"), F.col("c_custkey") % 6)))
            t = t.withColumn("c_mktsegment", F.when(F.col("c_custkey") % 3 != 0, F.col("c_mktsegment"))).where("c_custkey % 11 <> 0")
        if name == "part":
            t = t.withColumn("p_name", F.lit("p")).where("p_partkey % 13 <> 0")
        if name == "orders":
            t = t.where("o_orderkey % 17 <> 0")
        t.write.parquet(f"{scratch}/{name}.parquet")
    from weekmart.plans.summary import to_sink_form
    for dims in (None, ["Goods[producer_name]", "Agents_hybrid[name]", "Goods[fg1_name]", "Goods[fg2_name]"],
                 ["Channel_type[sell_channel_type_name]", "Promo[basis]"], ["Goods[articul]", "Doc_types[name]"]):
        want = to_sink_form(cube_summary(sales_cube(spark, scratch, dims=dims), dims=dims))
        got = weekly_summary(spark, scratch, dims=dims)
        assert got.columns[:-7] == want.columns[:-7] and set(got.columns) == set(want.columns)
        rounded = lambda d: d.select(*[F.round(c, 6).alias(c) if t == "double" else F.col(f"`{c}`")
                                       for c, t in d.select(*[f"`{x}`" for x in want.columns]).dtypes])
        assert got.count() == want.count() and rounded(got).exceptAll(rounded(want)).count() == 0


def test_layout_join_needs_no_shuffle_and_prunes_weeks(spark, scratch):
    from weekmart.plans.layout import build_sales_layout
    db = "wm_layout_" + scratch.rsplit("-", 1)[-1]
    src = build_sales_layout(spark, SF_SMALL, db, f"{scratch}/layout", buckets=4)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        cube = sales_cube(spark, src, dims=["Agents_hybrid[name]"])
        text = plan_text(cube.base)
        assert "SortMergeJoin" in text
        assert "Exchange hashpartitioning(l_orderkey" not in text
        assert "Exchange hashpartitioning(o_orderkey" not in text
        weeks = P.last_quarter(spark, dt.date(2000, 3, 15))
        pruned = plan_text(weekly_summary(spark, src, periods=weeks))
        assert "PartitionFilters: [isnotnull(year_num" in pruned or "PartitionFilters: [((year_num" in pruned
        # one file per (week, bucket) group, not one per group per scan task
        import glob
        from pyspark.sql import functions as F
        from weekmart.plans.sales_cube import read_table
        files = glob.glob(f"{scratch.removeprefix('file:')}/layout/lineitem/year_num=*/week_num=*/*.parquet")
        groups = (spark.table(f"`{db}`.`lineitem`")
                  .select("year_num", "week_num", F.expr("pmod(hash(l_orderkey), 4)")).distinct().count())
        assert len(files) == groups
        assert spark.table(f"`{db}`.`lineitem`").count() == read_table(spark, SF_SMALL, "lineitem").count()
        # same rows as the plain-file source
        a = weekly_summary(spark, src, periods=weeks)
        b = weekly_summary(spark, SF_SMALL, periods=weeks)
        assert a.count() == b.count() and a.exceptAll(b).count() == 0
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_rows_dealt_by_part_are_not_dealt_again_for_the_sums(spark):
    """Without broadcasts: the price join deals the fact by part, and the sums and the
    part's names need no exchange of their own."""
    import re
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan_text(weekly_summary(spark, SF_SMALL))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "partial_sum" in text and "Exchange hashpartitioning(l_partkey" in text
    assert not re.search(r"Exchange hashpartitioning\([^)]*week_num", text)
    assert len(re.findall(r"Exchange hashpartitioning\(l_partkey", text)) == 1
