"""The weekly sales cube over the TPC-H-like tables.

Mapping of the cube's dimension columns onto the tables:

    Calendar[calendar_date]            serial day of l_shipdate
    Goods[fg1..fg4_name]               p_type, p_brand, p_size (text), p_name
    Goods[articul/articul_name]        p_partkey (text), p_name
    Goods[producer_name]               s_name
    Agents_hybrid[name]                c_name (through the order)
    Markets[doc_prefix_original]       customer's n_name
    Channel_type[sell_channel_type_name] c_mktsegment
    Price_types[name], [is_tender]     o_orderpriority, l_returnflag = 'R'
    Doc_types[name]                    o_orderstatus
    Credit_products[...]               inline members keyed by l_linestatus
    Promo[...]                         inline members keyed by l_returnflag

Join plan.  The snowflake arm order -> customer -> nation is collapsed
first (dimension-sized work), so the fact is joined once per arm: by
order key, part key and supplier key.  Whether an arm is broadcast is
decided by Spark from its size: the planner's estimate against
``spark.sql.autoBroadcastJoinThreshold`` and, at run time, AQE's measured
shuffle size; beyond those it is a shuffle (sort-merge) join, with AQE
splitting a skewed key's partition.  Inline dimensions have a fixed number
of members and are always broadcast.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weekmart.functions.dates import date_serial
from weekmart.operators.filters import with_period
from weekmart.operators.joins import join_dimension
from weekmart.plans.model import CubeModel, Measure

# The cube's grouping columns, in the query's order.
DIMENSIONS = [
    "Calendar[calendar_date]",
    "Goods[fg1_name]",
    "Goods[fg2_name]",
    "Goods[fg3_name]",
    "Goods[fg4_name]",
    "Goods[articul]",
    "Goods[articul_name]",
    "Goods[producer_name]",
    "Agents_hybrid[name]",
    "Markets[doc_prefix_original]",
    "Channel_type[sell_channel_type_name]",
    "Price_types[name]",
    "Price_types[is_tender]",
    "Doc_types[name]",
    "Credit_products[payment_code]",
    "Credit_products[payment_typ]",
    "Credit_products[product_types]",
    "Credit_products[bank_name]",
    "Credit_products[bank_credit_product_code]",
    "Credit_products[product_name]",
    "Credit_products[payment_count]",
    "Promo[promo_type_name]",
    "Promo[basis]",
]

# Measure name -> result caption, in the query's order.
MEASURE_CAPTIONS = [
    ("sell_qty", "Реалізація, к-сть"),
    ("sell_amount_nds", "Реалізація, грн."),
    ("buy_amount_nds", "Реалізація ЦЗ, грн."),
    ("profit_amount_nds", "Дохід, грн."),
    ("bonus_obtained_amount", "Отримані бонуси"),
    ("bonus_used_amount", "Використані бонуси"),
    ("credit_commission_amount", "Комісія по кредитам"),
]

# Inline dimension members.  Some fact keys have no member on purpose
# (linestatus 'O', returnflag 'N'): those facts keep null attributes.
CREDIT_PRODUCTS = [
    ("F", "CR-12", "credit", "instalment", "First Bank", "FB-12", "12 payments", 12),
    ("X", "CR-24", "credit", "instalment", "Second Bank", "SB-24", "24 payments", 24),
]
CREDIT_SCHEMA = ("cp_key string, payment_code string, payment_typ string, product_types string, "
                 "bank_name string, bank_credit_product_code string, product_name string, "
                 "payment_count long")
PROMO = [
    ("A", "discount", "weekly flyer"),
    ("R", "bonus", "loyalty card"),
]
PROMO_SCHEMA = "pr_key string, promo_type_name string, basis string"

MEASURE_INPUTS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "p_retailprice", "l_returnflag"]


def measures() -> list[Measure]:
    """The seven measures: products of the inputs as they are, summed exactly."""
    qty, price, disc, tax, retail = (F.col(c).cast("double") for c in MEASURE_INPUTS[:5])
    sell, buy, bonus = price * (F.lit(1.0) - disc), retail * qty, price * disc
    values = {
        "sell_qty": qty,
        "sell_amount_nds": sell,
        "buy_amount_nds": buy,
        "profit_amount_nds": sell - buy,
        "bonus_obtained_amount": bonus,
        "bonus_used_amount": F.when(F.col("l_returnflag") == "R", bonus),
        "credit_commission_amount": price * tax,
    }
    return [Measure(n, cap, values[n]) for n, cap in MEASURE_CAPTIONS]


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A source table: ``<dir>/<name>.parquet``, or ``<db>.<name>`` when the
    source is ``catalog:<db>`` (the layout written by plans.layout)."""
    if sf_dir.startswith("catalog:"):
        return spark.table(f"`{sf_dir.removeprefix('catalog:')}`.`{name}`")
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _values_frame(spark: SparkSession, rows, schema: str) -> DataFrame:
    """Small literal table as a SQL VALUES list (a local relation in the
    plan, no Python-side scan)."""
    names = [c.strip().split()[0] for c in schema.split(",")]
    types = [c.strip().split()[1] for c in schema.split(",")]

    def lit(v):
        return "NULL" if v is None else ("'" + v.replace("'", "''") + "'" if isinstance(v, str) else str(v))
    body = ", ".join("(" + ", ".join(lit(v) for v in r) + ")" for r in rows)
    df = spark.sql(f"SELECT * FROM VALUES {body} AS t({', '.join(names)})")
    return df.select(*[F.col(n).cast(t).alias(n) for n, t in zip(names, types)])


def inline_dimensions(spark: SparkSession) -> tuple[DataFrame, DataFrame]:
    return (_values_frame(spark, CREDIT_PRODUCTS, CREDIT_SCHEMA),
            _values_frame(spark, PROMO, PROMO_SCHEMA))


def order_dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    """orders -> customer -> nation collapsed into one order-keyed arm (read
    as is from a layout source, where it is stored bucketed by order key)."""
    if sf_dir.startswith("catalog:"):
        return spark.table(f"`{sf_dir.removeprefix('catalog:')}`.`order_dim`")
    nation = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    customer = read_table(spark, sf_dir, "customer").select(
        "c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    cust = join_dimension(customer, nation, "c_nationkey", "n_nationkey")
    orders = read_table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority")
    od = join_dimension(orders, cust, "o_custkey", "c_custkey")
    return od.select(
        "o_orderkey", "o_custkey",
        F.col("c_name").alias("Agents_hybrid[name]"),
        F.col("n_name").alias("Markets[doc_prefix_original]"),
        F.col("c_mktsegment").alias("Channel_type[sell_channel_type_name]"),
        F.col("o_orderpriority").alias("Price_types[name]"),
        F.col("o_orderstatus").alias("Doc_types[name]"),
    )


ORDER_ARM = ("Agents_hybrid[", "Markets[", "Channel_type[", "Price_types[name]", "Doc_types[")


def sales_cube(spark: SparkSession, sf_dir: str, fact: DataFrame | None = None,
               dims: list[str] | None = None) -> CubeModel:
    """Build the cube.  ``fact`` may be a pre-filtered lineitem frame (for
    example date-range pruned); by default the whole table.

    ``dims`` (qualified names) limits the cube to the dimension arms those
    columns need: every arm is a left join on the dimension's unique key,
    so an arm that no column uses cannot change the result and is not
    joined at all.  The part arm always stays (a measure uses its price)."""
    dims = list(DIMENSIONS if dims is None else dims)
    need_order = any(d.startswith(ORDER_ARM) for d in dims)
    need_supplier = "Goods[producer_name]" in dims
    need_credit = any(d.startswith("Credit_products[") for d in dims)
    need_promo = any(d.startswith("Promo[") for d in dims)

    li = fact if fact is not None else read_table(spark, sf_dir, "lineitem")
    li = li.drop("year_num", "week_num").select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
                   "l_extendedprice", "l_discount", "l_tax", "l_returnflag",
                   "l_linestatus", "l_shipdate")
    part = read_table(spark, sf_dir, "part").select(
        "p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice")

    # The part arm goes first, so that a category filter cuts the fact before it is
    # dealt by order key.  A stored layout is bucketed by order key: there the
    # order arm goes first and needs no exchange.
    x = li
    arms = [(part, "l_partkey", "p_partkey")]
    if need_order:
        arm = (order_dimension(spark, sf_dir), "l_orderkey", "o_orderkey")
        arms = [arm, *arms] if sf_dir.startswith("catalog:") else [*arms, arm]
    for dim, fact_key, dim_key in arms:
        x = join_dimension(x, dim, fact_key, dim_key)
    if need_supplier:
        supplier = read_table(spark, sf_dir, "supplier").select("s_suppkey", "s_name")
        x = join_dimension(x, supplier, "l_suppkey", "s_suppkey")
    credit, promo = inline_dimensions(spark)
    if need_credit:
        x = join_dimension(x, credit, "l_linestatus", "cp_key", bounded=True)
    if need_promo:
        x = join_dimension(x, promo, "l_returnflag", "pr_key", bounded=True)

    columns = {
        "Calendar[calendar_date]": date_serial("l_shipdate"),
        "Goods[fg1_name]": F.col("p_type"),
        "Goods[fg2_name]": F.col("p_brand"),
        "Goods[fg3_name]": F.col("p_size").cast("string"),
        "Goods[fg4_name]": F.col("p_name"),
        "Goods[articul]": F.col("l_partkey").cast("string"),
        "Goods[articul_name]": F.col("p_name"),
        "Goods[producer_name]": F.col("s_name"),
        "Agents_hybrid[name]": F.col("`Agents_hybrid[name]`"),
        "Markets[doc_prefix_original]": F.col("`Markets[doc_prefix_original]`"),
        "Channel_type[sell_channel_type_name]": F.col("`Channel_type[sell_channel_type_name]`"),
        "Price_types[name]": F.col("`Price_types[name]`"),
        "Price_types[is_tender]": F.col("l_returnflag") == "R",
        "Doc_types[name]": F.col("`Doc_types[name]`"),
        "Credit_products[payment_code]": F.col("payment_code"),
        "Credit_products[payment_typ]": F.col("payment_typ"),
        "Credit_products[product_types]": F.col("product_types"),
        "Credit_products[bank_name]": F.col("bank_name"),
        "Credit_products[bank_credit_product_code]": F.col("bank_credit_product_code"),
        "Credit_products[product_name]": F.col("product_name"),
        "Credit_products[payment_count]": F.col("payment_count"),
        "Promo[promo_type_name]": F.col("promo_type_name"),
        "Promo[basis]": F.col("basis"),
    }
    base = x.select("l_orderkey", "l_linenumber", "l_shipdate",
                    *[columns[d].alias(d) for d in dims], *MEASURE_INPUTS)
    base = with_period(base, "l_shipdate")
    return CubeModel(base=base, date_col="l_shipdate", dimensions=dims,
                     measures=measures(), filters={"fg1_name": "Goods[fg1_name]"})
