"""The summary with its aggregation below the joins to names.

Equal groups of names are equal groups of keys once each dimension's members that share
all wanted attributes go by one key (the smallest).  So the fact is joined to
key-to-key tables only, its measures are summed over those keys, and the names are
looked up on the summed rows.  Rows of the fact never carry a name through an exchange,
and a group that many rows share meets the names once.

    fact -- customer group and codes of the order -- supplier group -- part key and price
         -> partial and final sums on (date, week, part, customer, codes, supplier, flags);
            rows dealt by part for the price are not dealt again for the sums
         -> names by part, customer group and supplier group
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from weekmart.functions.dates import SERIAL_EPOCH, date_serial
from weekmart.functions.exact import exact_sums
from weekmart.operators.filters import KEYS, with_period
from weekmart.operators.joins import join_dimension
from weekmart.plans.sales_cube import (
    CREDIT_PRODUCTS, DIMENSIONS, MEASURE_INPUTS, PROMO, inline_dimensions, measures, order_dimension, read_table,
)

# Dimension column -> (arm, attribute).
_PART = {"Goods[fg1_name]": "p_type", "Goods[fg2_name]": "p_brand", "Goods[fg3_name]": "p_size",
         "Goods[fg4_name]": "p_name", "Goods[articul_name]": "p_name"}
_CREDIT = "Credit_products["
_PROMO = "Promo["
_CUSTOMER = ("Agents_hybrid[name]", "Markets[doc_prefix_original]", "Channel_type[sell_channel_type_name]")
_CODES = ("Price_types[name]", "Doc_types[name]")       # short codes of the order itself


def _q(name: str) -> Column:
    return F.col(f"`{name}`")


def member_groups(dim: DataFrame, key: str, attributes: list[str], group: str) -> tuple[DataFrame, DataFrame]:
    """(key, group) of each member and (group, attributes) of each group: members
    with equal attributes share a group, named by its smallest key.  Members whose
    attributes are all null belong to none, as facts without a member do."""
    dim = dim.select(key, *[_q(a) for a in attributes]).where(F.col(key).isNotNull())
    known = reduce(lambda a, b: a | b, [_q(a).isNotNull() for a in attributes])
    groups = dim.where(known).groupBy(*[_q(a) for a in attributes]).agg(F.min(key).alias(group))
    same = reduce(lambda a, b: a & b, [dim[f"`{a}`"].eqNullSafe(groups[f"`{a}`"]) for a in attributes])
    return dim.join(groups, same).select(key, group), groups


def _customers(spark: SparkSession, sf_dir: str, wanted: list[str]) -> DataFrame:
    """(c_custkey, wanted names) of each customer."""
    names = {"Agents_hybrid[name]": "c_name", "Markets[doc_prefix_original]": "n_name",
             "Channel_type[sell_channel_type_name]": "c_mktsegment"}
    customer = read_table(spark, sf_dir, "customer").select(
        "c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    if "Markets[doc_prefix_original]" in wanted:
        nation = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
        customer = join_dimension(customer, nation, "c_nationkey", "n_nationkey")
    return customer.select("c_custkey", *[F.col(names[d]).alias(d) for d in wanted])


def _with_order_keys(x: DataFrame, spark: SparkSession, sf_dir: str, of_customer: list[str],
                     codes: list[str]) -> tuple[DataFrame, DataFrame | None]:
    """The fact with its order's customer group and codes (priority, status), and the
    names of customer groups.  A stored layout joins the fact to orders first, as both
    are bucketed by order key; else orders take their customer group before."""
    stored = sf_dir.startswith("catalog:")
    if stored:
        orders = order_dimension(spark, sf_dir).select("o_orderkey", "o_custkey", *[_q(d) for d in codes])
    else:
        source = {"Price_types[name]": "o_orderpriority", "Doc_types[name]": "o_orderstatus"}
        orders = read_table(spark, sf_dir, "orders").select(
            "o_orderkey", "o_custkey", *[F.col(source[d]).alias(d) for d in codes])
    if not of_customer:
        return join_dimension(x, orders.drop("o_custkey"), "l_orderkey", "o_orderkey"), None
    by_customer, names = member_groups(_customers(spark, sf_dir, of_customer), "c_custkey",
                                       of_customer, "customer_group")
    if stored:
        x = join_dimension(x, orders, "l_orderkey", "o_orderkey")
        return join_dimension(x, by_customer, "o_custkey", "c_custkey").drop("o_custkey"), names
    orders = join_dimension(orders, by_customer, "o_custkey", "c_custkey").drop("o_custkey")
    return join_dimension(x, orders, "l_orderkey", "o_orderkey"), names


def _member(column: str, members: list[tuple]) -> Column:
    """The fact's key of an inline dimension, null where it has no member."""
    return F.when(F.col(column).isin([m[0] for m in members]), F.col(column))


def keyed_summary(spark: SparkSession, sf_dir: str, fact: DataFrame, dims: list[str] | None = None,
                  measure_names: list[str] | None = None, category: str | None = None) -> DataFrame:
    """``fact`` grouped by ``dims`` (qualified names) and week with the named
    measures: the same rows as grouping the joined cube.  Groups without any measure go."""
    dims = list(DIMENSIONS if dims is None else dims)
    chosen = [m for m in measures() if measure_names is None or m.name in measure_names]
    x = fact.drop(*KEYS).select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
        "l_returnflag", "l_linestatus", "l_shipdate")

    # Parts: the price is an input of the measures; a category leaves few parts.
    part = read_table(spark, sf_dir, "part").select(
        "p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice")
    if category:
        part = part.where(F.col("p_type") == F.lit(category))
    of_part = {d: _PART[d] for d in dims if d in _PART}
    attributes = list(dict.fromkeys(of_part.values()))
    priced = part.select("p_partkey", "p_retailprice")
    part_names, part_key = None, None
    if "Goods[articul]" in dims:
        part_key, part_names = "l_partkey", part.select("p_partkey", *attributes) if attributes else None
    elif attributes:
        by_part, part_names = member_groups(part, "p_partkey", attributes, "part_group")
        priced = join_dimension(priced, by_part.withColumnRenamed("p_partkey", "__p"), "p_partkey", "__p")
        part_key, part_names = "part_group", part_names.withColumnRenamed("part_group", "p_partkey")

    def with_price(x: DataFrame) -> DataFrame:
        return x.join(priced, x["l_partkey"] == priced["p_partkey"],
                      "inner" if category else "left").drop("p_partkey")

    # Groups of one part each: the price comes last, so that rows dealt by part for it
    # are grouped and meet the part's names where they are.  Else it comes first, as a
    # category then cuts the fact before it is dealt by order key.
    price_last = part_key == "l_partkey" and not category
    if not price_last:
        x = with_price(x)

    lookups: list[tuple[DataFrame, str, str]] = []
    keys: list[str] = []
    if part_key:
        keys.append(part_key)
        if part_names is not None:
            lookups.append((part_names, part_key, "p_partkey"))
    of_customer, codes = [d for d in _CUSTOMER if d in dims], [d for d in _CODES if d in dims]
    if of_customer or codes:
        x, customers = _with_order_keys(x, spark, sf_dir, of_customer, codes)
        keys += codes
        if customers is not None:
            keys.append("customer_group")
            lookups.append((customers.withColumnRenamed("customer_group", "__customer"),
                            "customer_group", "__customer"))
    if "Goods[producer_name]" in dims:
        supplier = read_table(spark, sf_dir, "supplier").select("s_suppkey", "s_name")
        by_supplier, suppliers = member_groups(supplier, "s_suppkey", ["s_name"], "supplier_group")
        x = join_dimension(x, by_supplier, "l_suppkey", "s_suppkey")
        keys.append("supplier_group")
        lookups.append((suppliers.withColumnRenamed("supplier_group", "__supplier"),
                        "supplier_group", "__supplier"))

    if price_last:
        x = with_price(x)

    # The day, the week and the inline dimensions' keys are computed from the fact row.
    x = with_period(x, "l_shipdate")
    computed = {
        "Calendar[calendar_date]": ("calendar_date", date_serial("l_shipdate")),
        "Price_types[is_tender]": ("is_tender", F.col("l_returnflag") == "R"),
    }
    if any(d.startswith(_CREDIT) for d in dims):
        computed[_CREDIT] = ("credit_key", _member("l_linestatus", CREDIT_PRODUCTS))
    if any(d.startswith(_PROMO) for d in dims):
        computed[_PROMO] = ("promo_key", _member("l_returnflag", PROMO))
    own = [(name, c) for d, (name, c) in computed.items() if d in dims or d in (_CREDIT, _PROMO)]
    keys += [name for name, _ in own] + KEYS
    sums = exact_sums(x.withColumns({name: c for name, c in own}), keys,
                      {m.caption: m.value for m in chosen}, drop_blank=True)

    for table, key, other in lookups:
        sums = join_dimension(sums, table, key, other)
    credit, promo = inline_dimensions(spark)
    if _CREDIT in computed:
        sums = join_dimension(sums, credit, "credit_key", "cp_key", bounded=True)
    if _PROMO in computed:
        sums = join_dimension(sums, promo, "promo_key", "pr_key", bounded=True)

    def column(d: str) -> Column:
        if d in computed:
            return F.col(computed[d][0])
        if d == "Goods[articul]":
            return F.col("l_partkey").cast("string")
        if d in of_part:
            return F.col(of_part[d]).cast("string")
        if d == "Goods[producer_name]":
            return F.col("s_name")
        if d.startswith((_CREDIT, _PROMO)):
            return F.col(d.partition("[")[2].rstrip("]"))
        return _q(d)

    return sums.select(*[column(d).alias(d) for d in dims], *KEYS, *[_q(m.caption) for m in chosen])


def _known(dim: DataFrame, attributes: list[str]) -> DataFrame:
    """Members with some attribute: the others count as no member, as in ``member_groups``."""
    return dim.where(reduce(lambda a, b: a | b, [_q(a).isNotNull() for a in attributes]))


# Flags of a fact in one number: the tender flag and its members of the inline dimensions.
_TENDERS = [None, False, True]
_CREDITS = [None, *[m[0] for m in CREDIT_PRODUCTS]]
_PROMOS = [None, *[m[0] for m in PROMO]]


def _flags() -> Column:
    def place(column: Column, values: list) -> Column:
        return F.coalesce(*[F.when(column == F.lit(v), F.lit(i)) for i, v in enumerate(values) if v is not None],
                          F.lit(0))
    tender = place(F.col("l_returnflag") == "R", _TENDERS)
    credit, promo = place(F.col("l_linestatus"), _CREDITS), place(F.col("l_returnflag"), _PROMOS)
    return tender + len(_TENDERS) * (credit + len(_CREDITS) * promo)


def _flag(values: list, below: int) -> Column:
    at = F.floor(F.col("flags") / below).cast("int") % len(values)
    return F.coalesce(*[F.when(at == i, F.lit(v)) for i, v in enumerate(values) if v is not None])


def ordered_summary(spark: SparkSession, sf_dir: str, fact: DataFrame) -> DataFrame:
    """The rows of ``keyed_summary`` for all dimensions and measures, in ranges of the export's
    order: an ``orderBy`` of the dimensions above it needs no exchange of its own.

    A total order must move names with each row once.  So the fact meets its names on the way,
    is dealt once by ranges of the order as names and measure inputs, which are narrower than
    sums, and is summed where it lies.  What follows from a column is made after the exchange."""
    x = fact.drop(*KEYS).select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
        _flags().alias("flags"), F.to_date("l_shipdate").alias("day"))
    supplier = read_table(spark, sf_dir, "supplier").select("s_suppkey", "s_name")
    x = join_dimension(x, _known(supplier, ["s_name"]), "l_suppkey", "s_suppkey").drop("l_suppkey")
    customers = _known(_customers(spark, sf_dir, list(_CUSTOMER)), list(_CUSTOMER))
    orders = read_table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", F.col("o_orderpriority").alias("Price_types[name]"),
        F.col("o_orderstatus").alias("Doc_types[name]"))
    orders = join_dimension(orders, customers, "o_custkey", "c_custkey").drop("o_custkey")
    x = join_dimension(x, orders, "l_orderkey", "o_orderkey").drop("l_orderkey")
    # Each row of a part has a price for the sums and a name for the result: a part of several
    # rows gives the sums over all their prices once for each.
    part = read_table(spark, sf_dir, "part").where("p_partkey is not null")
    attributes = list(dict.fromkeys(_PART.values()))
    numbered = part.select("p_partkey", *attributes, F.row_number().over(
        W.partitionBy("p_partkey").orderBy(*attributes)).alias("part_row"))
    priced = part.select(F.col("p_partkey").alias("__p"), "p_retailprice")
    x = join_dimension(x, numbered.join(priced, F.col("p_partkey") == F.col("__p")).drop("__p"),
                       "l_partkey", "p_partkey")

    x = x.withColumns({"calendar_date": date_serial("day"), "size": F.col("p_size").cast("string"),
                       "articul": F.col("l_partkey").cast("string")})
    order = ["calendar_date", "p_type", "p_brand", "size", "p_name", "articul", "p_name", "s_name",
             *_CUSTOMER, "Price_types[name]"]
    x = x.select(*[_q(c) for c in dict.fromkeys(order)], _q("Doc_types[name]"), "flags", "part_row",
                 *[c for c in MEASURE_INPUTS if c != "l_returnflag"])
    x = x.repartitionByRange(*[_q(c).asc_nulls_first() for c in order])
    x = x.withColumn("l_returnflag", F.when(_flag(_TENDERS, 1), F.lit("R")))
    keys = [*dict.fromkeys(order), "Doc_types[name]", "flags", "part_row"]
    sums = exact_sums(x, keys, {m.caption: m.value for m in measures()}, drop_blank=True)

    credit, promo = inline_dimensions(spark)
    sums = sums.withColumns({
        "is_tender": _flag(_TENDERS, 1), "credit_key": _flag(_CREDITS, len(_TENDERS)),
        "promo_key": _flag(_PROMOS, len(_TENDERS) * len(_CREDITS)),
        "day": F.date_add(F.lit(SERIAL_EPOCH), F.col("calendar_date").cast("int"))})
    sums = join_dimension(sums, credit, "credit_key", "cp_key", bounded=True)
    sums = join_dimension(sums, promo, "promo_key", "pr_key", bounded=True)
    sums = with_period(sums, "day")
    source = {"Calendar[calendar_date]": "calendar_date", "Goods[articul]": "articul", "Goods[producer_name]": "s_name",
              "Price_types[is_tender]": "is_tender", **_PART, "Goods[fg3_name]": "size"}

    def column(d: str) -> Column:
        return _q(source.get(d, d.partition("[")[2].rstrip("]") if d.startswith((_CREDIT, _PROMO)) else d))

    return sums.select(*[column(d).alias(d) for d in DIMENSIONS], *KEYS, *[_q(m.caption) for m in measures()])
