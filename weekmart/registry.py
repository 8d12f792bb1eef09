"""Every operator as a registered query over the driver's tables.

Each entry is ``key -> (spark, sf_dir) -> DataFrame``; ``ORACLES[key]`` is
the DuckDB SQL stating the same result.  Keys without an oracle are the
write/read-back operators whose rows depend on files Spark itself wrote.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weekmart import oracle_sql as O
from weekmart.functions.dates import (
    date_serial, parse_period_label, period_label, week_exists, week_monday,
)
from weekmart.functions.exact import exact_sums
from weekmart.functions.names import bare_names
from weekmart.functions.values import (
    coerce, finite, normalise_cells, number_to_text, text_to_serial,
)
from weekmart.operators.filters import KEYS, where_periods, with_period
from weekmart.plans import periods as P
from weekmart.plans.manifest import column_width_profile, manifest, manifest_stats
from weekmart.plans.sales_cube import DIMENSIONS, read_table, sales_cube
from weekmart.plans.summary import (
    bare_columns, cube_summary, sales_available_periods, sort_summary, to_sink_form,
    weekly_summary,
)

# Reference date of every period rule in the registered queries; the
# fixture's ship dates run from 1995-01-02 to 2001-11-04.
AS_OF = _dt.date(2000, 3, 15)
CATEGORY = "PROMO"

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def register(key: str, oracle: str | None = None):
    def deco(fn: Query) -> Query:
        QUERIES[key] = fn
        if oracle is not None:
            ORACLES[key] = oracle
        return fn
    return deco


# -- S1, J1, A1, O1: the cube and its summary ---------------------------------

BASE_INPUTS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "p_retailprice"]


@register("weekly_sales", O.summary_sql())
def q_weekly_sales(spark, sf):
    return weekly_summary(spark, sf)


CHANNEL_DIMS = ["Channel_type[sell_channel_type_name]", "Price_types[is_tender]", "Promo[promo_type_name]"]
CHANNEL_SQL = O.summary_sql(dims=["sell_channel_type_name", "is_tender", "promo_type_name"])


@register("channel_sales", CHANNEL_SQL)
def q_channel_sales(spark, sf):
    """Groups of many fact rows, many customers and many parts each."""
    return weekly_summary(spark, sf, dims=CHANNEL_DIMS)


@register("exact_sums", f"""SELECT l_returnflag, l_linestatus,
  {O.exact_sum_sql('l_extendedprice / 7')} AS seventh_of_price,
  {O.exact_sum_sql('(l_linenumber - 4) * l_extendedprice / 7')} AS balanced,
  {O.exact_sum_sql('CASE WHEN l_discount = 0 THEN NULL ELSE l_tax / 3 END')} AS third_of_tax
  FROM lineitem GROUP BY 1, 2""")
def q_exact_sums(spark, sf):
    price = F.col("l_extendedprice")
    return exact_sums(_lineitem(spark, sf), ["l_returnflag", "l_linestatus"], {
        "seventh_of_price": price / 7,
        "balanced": (F.col("l_linenumber") - 4) * price / 7,
        "third_of_tax": F.when(F.col("l_discount") != 0, F.col("l_tax") / 3)})


@register("weekly_sales_sorted", O.summary_sql(order=True))
def q_weekly_sales_sorted(spark, sf):
    df = weekly_summary(spark, sf, ordered=True)
    return sort_summary(df, O.DIMS_SAFE + KEYS)


def _cube_rows(spark, sf) -> DataFrame:
    cube = sales_cube(spark, sf)
    return cube.base.select("l_orderkey", "l_linenumber", *[F.col(f"`{d}`") for d in DIMENSIONS],
                            *KEYS, *BASE_INPUTS)


@register("cube_base", "WITH " + O.base_cte() + " SELECT l_orderkey, l_linenumber, "
          + ", ".join(f'"{d}"' for d in O.DIMS_SAFE) + ", year_num, week_num, "
          + ", ".join(BASE_INPUTS) + " FROM base")
def q_cube_base(spark, sf):
    return to_sink_form(_cube_rows(spark, sf))


@register("star_join", "WITH " + O.base_cte() + """ SELECT l_orderkey, l_linenumber,
  "Agents_hybrid_name", doc_prefix_original, "Doc_types_name", producer_name, fg1_name,
  payment_code, payment_count, promo_type_name, basis FROM base""")
def q_star_join(spark, sf):
    cube = sales_cube(spark, sf, dims=["Agents_hybrid[name]", "Markets[doc_prefix_original]",
                                        "Doc_types[name]", "Goods[producer_name]", "Goods[fg1_name]",
                                        "Credit_products[payment_code]",
                                        "Credit_products[payment_count]",
                                        "Promo[promo_type_name]", "Promo[basis]"])
    return to_sink_form(cube.base.select(
        "l_orderkey", "l_linenumber", "`Agents_hybrid[name]`", "`Markets[doc_prefix_original]`",
        "`Doc_types[name]`", "`Goods[producer_name]`", "`Goods[fg1_name]`",
        "`Credit_products[payment_code]`", "`Credit_products[payment_count]`",
        "`Promo[promo_type_name]`", "`Promo[basis]`"))


@register("bare_columns", "WITH " + O.base_cte() + " SELECT l_orderkey, l_linenumber, "
          + ", ".join(
              f'"{d}" AS "{n}"' for d, n in zip(O.DIMS_SAFE, bare_names(DIMENSIONS)))
          + ", year_num, week_num FROM base")
def q_bare_columns(spark, sf):
    cube = sales_cube(spark, sf)
    df = cube.base.select("l_orderkey", "l_linenumber", *[F.col(f"`{d}`") for d in DIMENSIONS], *KEYS)
    return bare_columns(df)


@register("safe_columns", O.summary_sql(dims=["fg1_name"]))
def q_safe_columns(spark, sf):
    cube = sales_cube(spark, sf, dims=["Goods[fg1_name]"])
    return to_sink_form(cube_summary(cube, dims=["Goods[fg1_name]"]))


@register("non_blank_groups", O.summary_sql(dims=["is_tender"], measures=["Використані_бонуси"]))
def q_non_blank_groups(spark, sf):
    cube = sales_cube(spark, sf, dims=["Price_types[is_tender]"])
    return to_sink_form(cube_summary(cube, dims=["Price_types[is_tender]"],
                                     measure_names=["bonus_used_amount"]))


@register("category_filter", O.summary_sql(where=f"fg1_name = '{CATEGORY}'"))
def q_category_filter(spark, sf):
    return weekly_summary(spark, sf, category=CATEGORY)


# -- S2, F3, F5, A2: available periods ----------------------------------------

@register("available_periods", O.AVAILABLE_SQL)
def q_available_periods(spark, sf):
    return sales_available_periods(spark, sf)


# -- W1..W10, J2, J3, U1..U3: period algebra ----------------------------------

def _avail(spark, sf):
    return sales_available_periods(spark, sf)


def _q_start(as_of: _dt.date, months_back: int = 0) -> tuple[int, int]:
    m = as_of.year * 12 + as_of.month - 1 - months_back
    return m // 12, m % 12 + 1


def _month_sql(y: int, m: int) -> str:
    return O.days_weeks_sql(_dt.date(y, m, 1), O.month_end(y, m))


def _quarter_sql(y: int, q: int) -> str:
    m0 = (q - 1) * 3 + 1
    return O.days_weeks_sql(_dt.date(y, m0, 1), O.month_end(y, m0 + 2))


_CUR_Q = (AS_OF.year, (AS_OF.month - 1) // 3 + 1)
_LAST_Q = (AS_OF.year - 1, 4) if _CUR_Q[1] == 1 else (AS_OF.year, _CUR_Q[1] - 1)
RANGE = ("1999-50", "2000-05")

PERIOD_RULES: dict[str, tuple[Callable, str]] = {
    "last_weeks": (lambda s: P.last_weeks(s, AS_OF, 6), O.last_weeks_sql(AS_OF, 6)),
    "rolling_weeks": (lambda s: P.rolling_weeks(s, AS_OF, 10), O.last_weeks_sql(AS_OF, 10)),
    "current_month": (lambda s: P.current_month(s, AS_OF), _month_sql(*_q_start(AS_OF))),
    "last_month": (lambda s: P.last_month(s, AS_OF), _month_sql(*_q_start(AS_OF, 1))),
    "current_quarter": (lambda s: P.current_quarter(s, AS_OF), _quarter_sql(*_CUR_Q)),
    "last_quarter": (lambda s: P.last_quarter(s, AS_OF), _quarter_sql(*_LAST_Q)),
    "year_to_date": (lambda s: P.year_to_date(s, AS_OF),
                     O.days_weeks_sql(_dt.date(AS_OF.year, 1, 1), AS_OF)),
    "weeks_in_month": (lambda s: P.weeks_in_month(s, 2000, 2), _month_sql(2000, 2)),
    "weeks_in_quarter": (lambda s: P.weeks_in_quarter(s, 1999, 4), _quarter_sql(1999, 4)),
    "quarter_union": (lambda s: P.weeks_in_quarter(s, 2000, 1), " UNION ".join(
        _month_sql(2000, m) for m in (1, 2, 3))),
    "period_range": (lambda s: P.period_range(s, *RANGE, AS_OF),
                     O.range_sql(P.parse_label(RANGE[0]), P.parse_label(RANGE[1]))),
}


def _rule_query(rule: Callable) -> Query:
    def q(spark, sf):
        return P.keep_available(rule(spark), _avail(spark, sf))
    return q


for _key, (_rule, _sql) in PERIOD_RULES.items():
    register(_key, O.semi_available(_sql))(_rule_query(_rule))


@register("resolve_periods", O.semi_available(O.range_sql((1999, 48), (2000, 3))))
def q_resolve_periods(spark, sf):
    cli = P.PeriodSpec(period="1999-48:2000-03")
    profile = P.PeriodSpec(rule="last-quarter")
    return P.resolve_periods(spark, AS_OF, _avail(spark, sf), cli, profile)


# Year to date as of late 2001: the data ends in 2001-W44, so the later
# weeks are asked for but missing.
LATE = _dt.date(2001, 12, 20)
_LATE_SQL = O.days_weeks_sql(_dt.date(2001, 1, 1), LATE)


@register("periods_available", O.semi_available(_LATE_SQL))
def q_periods_available(spark, sf):
    return P.keep_available(P.year_to_date(spark, LATE), _avail(spark, sf))


@register("periods_intersect", O.semi_available(_LATE_SQL))
def q_periods_intersect(spark, sf):
    return P.intersect_periods(P.year_to_date(spark, LATE), _avail(spark, sf))


@register("periods_missing", O.anti_available(_LATE_SQL))
def q_periods_missing(spark, sf):
    return P.missing_periods(P.year_to_date(spark, LATE), _avail(spark, sf))


# -- F1: period filter on the summary -----------------------------------------

@register("period_filter", O.summary_sql(where=O.in_periods(_quarter_sql(*_LAST_Q))))
def q_period_filter(spark, sf):
    wanted = P.keep_available(P.last_quarter(spark, AS_OF), _avail(spark, sf))
    return weekly_summary(spark, sf, periods=wanted)


# -- P3..P9, C2, C3, C5: names, values and dates ------------------------------

def _lineitem(spark, sf):
    return read_table(spark, sf, "lineitem")


@register("finite_values", """SELECT l_orderkey, l_linenumber,
  CASE WHEN l_discount = 0 THEN NULL ELSE l_extendedprice / l_discount END AS price_per_discount,
  l_extendedprice FROM lineitem""")
def q_finite_values(spark, sf):
    li = _lineitem(spark, sf)
    inf = F.lit(float("inf"))
    ratio = (F.when(F.col("l_discount") != 0, F.col("l_extendedprice") / F.col("l_discount"))
             .when(F.col("l_tax") == 0, F.lit(float("nan")))
             .when(F.col("l_returnflag") == "N", -inf)
             .otherwise(inf))
    return li.select("l_orderkey", "l_linenumber", finite(ratio).alias("price_per_discount"),
                     finite("l_extendedprice").alias("l_extendedprice"))


@register("with_period", f"""SELECT l_orderkey, l_linenumber,
  {O.ISO_Y.format(c='l_shipdate')} AS year_num, {O.ISO_W.format(c='l_shipdate')} AS week_num
  FROM lineitem""")
def q_with_period(spark, sf):
    return with_period(_lineitem(spark, sf), "l_shipdate").select(
        "l_orderkey", "l_linenumber", *KEYS)


@register("date_serial", f"""SELECT l_orderkey, l_linenumber,
  {O.SERIAL.format(c='l_shipdate')} AS calendar_date FROM lineitem""")
def q_date_serial(spark, sf):
    return _lineitem(spark, sf).select("l_orderkey", "l_linenumber",
                                       date_serial("l_shipdate").alias("calendar_date"))


_N2T = ("CASE WHEN {c} IS NULL OR isnan({c}) OR isinf({c}) THEN NULL "
        "WHEN {c} = round({c}) THEN CAST(CAST({c} AS DECIMAL(38,0)) AS VARCHAR) "
        "ELSE CAST({c} AS VARCHAR) END")


@register("number_to_text", f"""SELECT l_orderkey, l_linenumber,
  {_N2T.format(c='l_quantity')} AS qty_text,
  {_N2T.format(c='l_extendedprice')} AS price_text,
  {_N2T.format(c='l_discount')} AS discount_text,
  CASE WHEN l_discount = 0 THEN NULL ELSE {_N2T.format(c='l_tax')} END AS tax_text,
  CAST(l_linenumber AS VARCHAR) AS line_text
  FROM lineitem""")
def q_number_to_text(spark, sf):
    li = _lineitem(spark, sf)
    tax_or_inf = F.when(F.col("l_discount") == 0, F.lit(float("inf"))).otherwise(F.col("l_tax"))
    return li.select(
        "l_orderkey", "l_linenumber",
        number_to_text("l_quantity").alias("qty_text"),
        number_to_text("l_extendedprice").alias("price_text"),
        number_to_text("l_discount").alias("discount_text"),
        number_to_text(tax_or_inf).alias("tax_text"),
        number_to_text("l_linenumber", T.IntegerType()).alias("line_text"),
    )


@register("text_to_serial", f"""SELECT l_orderkey, l_linenumber,
  {O.SERIAL.format(c='l_shipdate')} AS serial_from_datetime,
  {O.SERIAL.format(c='l_shipdate')} AS serial_from_date,
  CAST(NULL AS BIGINT) AS serial_from_flag,
  CAST(NULL AS BIGINT) AS serial_from_bad_day
  FROM lineitem""")
def q_text_to_serial(spark, sf):
    li = _lineitem(spark, sf)
    return li.select(
        "l_orderkey", "l_linenumber",
        text_to_serial(F.date_format("l_shipdate", "yyyy-MM-dd HH:mm:ss")).alias("serial_from_datetime"),
        text_to_serial(F.date_format("l_shipdate", "yyyy-MM-dd")).alias("serial_from_date"),
        text_to_serial(F.col("l_returnflag")).alias("serial_from_flag"),
        text_to_serial(F.concat(F.date_format("l_shipdate", "yyyy-MM"), F.lit("-32")))
        .alias("serial_from_bad_day"),
    )


@register("normalise_cells", f"""SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice,
  {O.SERIAL.format(c='o_orderdate')} AS o_orderdate, o_orderpriority,
  CAST(o_totalprice AS DECIMAL(18,2)) > 100000 AS big_order FROM orders""")
def q_normalise_cells(spark, sf):
    o = read_table(spark, sf, "orders")
    o = o.withColumn("o_totalprice", F.col("o_totalprice").cast("decimal(18,2)"))
    o = o.withColumn("big_order", F.col("o_totalprice") > 100000)
    return normalise_cells(o)


_EV_TEXT = ("event_id", "user_id", "value", "event_type", "props")


def _dbl(c):
    return f"TRY_CAST({c} AS DOUBLE)"


def _long_sql(c):
    d = _dbl(c)
    return f"CASE WHEN {d} = round({d}) THEN CAST({d} AS BIGINT) END"


@register("coerce_types", f"""SELECT
  {_long_sql('CAST(event_id AS VARCHAR)')} AS event_id,
  {_long_sql('CAST(user_id AS VARCHAR)')} AS user_id,
  {_long_sql('CAST(value AS VARCHAR)')} AS value_whole,
  value AS value,
  COALESCE(event_type, '') AS event_type,
  {_long_sql('props')} AS props
  FROM events""")
def q_coerce_types(spark, sf):
    ev = read_table(spark, sf, "events")
    text = ev.select(*[F.col(c).cast("string").alias(c) for c in _EV_TEXT],
                     F.col("value").cast("string").alias("value_whole"))
    target = T.StructType([
        T.StructField("event_id", T.LongType()),
        T.StructField("user_id", T.LongType()),
        T.StructField("value_whole", T.LongType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("event_type", T.StringType(), nullable=False),
        T.StructField("props", T.LongType()),
        T.StructField("not_in_source", T.StringType()),
    ])
    return coerce(text, target)


@register("align_columns", f"""WITH x AS ({O.summary_sql(dims=['fg1_name'])})
  SELECT year_num, week_num, fg1_name, "Реалізація_грн" FROM x""")
def q_align_columns(spark, sf):
    from weekmart.operators.columns import align_columns
    cube = sales_cube(spark, sf, dims=["Goods[fg1_name]"])
    df = to_sink_form(cube_summary(cube, dims=["Goods[fg1_name]"]))
    target = T.StructType([T.StructField(n, T.StringType()) for n in
                           ("year_num", "week_num", "fg1_name", "Реалізація_грн", "missing_col")])
    return align_columns(df, target)


@register("week_monday", f"""WITH a AS ({O.AVAILABLE_SQL})
  SELECT year_num, week_num,
    {O.SERIAL.format(c="CAST(date_trunc('week', make_date(year_num, 1, 4)) AS DATE) + 7 * (week_num - 1)")} AS monday,
    TRUE AS round_trip FROM a""")
def q_week_monday(spark, sf):
    a = _avail(spark, sf)
    return a.select(*KEYS, date_serial(week_monday("year_num", "week_num")).alias("monday"),
                    week_exists("year_num", "week_num").alias("round_trip"))


@register("period_label", f"""WITH a AS ({O.AVAILABLE_SQL})
  SELECT year_num, week_num, printf('%d-%02d', year_num, week_num) AS label,
    year_num AS parsed_year, week_num AS parsed_week FROM a""")
def q_period_label(spark, sf):
    a = _avail(spark, sf).withColumn("label", period_label("year_num", "week_num"))
    y, w = parse_period_label("label")
    return a.select(*KEYS, "label", y.alias("parsed_year"), w.alias("parsed_week"))


# -- A4..A6, K17: profile and manifest ----------------------------------------

_PROFILE_NAMES = bare_names(DIMENSIONS)


def _profile_sql() -> str:
    parts = []
    for d, n in zip(O.DIMS_SAFE, _PROFILE_NAMES):
        n_sql = n.replace("'", "''")
        parts.append(
            f"SELECT '{n_sql}' AS column_name, CAST(GREATEST(COALESCE(MAX(length(CAST(\"{d}\" AS VARCHAR))), 0), "
            f"length('{n_sql}')) AS INTEGER) AS max_len FROM base")
    inner = " UNION ALL ".join(parts)
    return (f"WITH {O.base_cte()}, p AS ({inner}) SELECT column_name, max_len, "
            f"CAST(LEAST(max_len + 2, 100) AS INTEGER) AS width FROM p")


@register("column_width_profile", _profile_sql())
def q_column_width_profile(spark, sf):
    cube = sales_cube(spark, sf)
    df = bare_columns(cube.base.select(*[F.col(f"`{d}`") for d in DIMENSIONS]))
    return column_width_profile(df)


MANIFEST_RANGE = ("2001-40", "2002-05")
MANIFEST_AS_OF = _dt.date(2001, 6, 1)
_MANIFEST_WANTED = O.range_sql((2001, 40), (2002, 5))


def _manifest_sql() -> str:
    return (f"WITH wanted AS ({_MANIFEST_WANTED}), res AS ({O.summary_sql()}), "
            f"c AS (SELECT year_num, week_num, COUNT(*) AS n FROM res GROUP BY 1, 2) "
            f"SELECT w.year_num, w.week_num, printf('%d-%02d', w.year_num, w.week_num) AS period, "
            f"COALESCE(c.n, 0) AS row_count FROM wanted w LEFT JOIN c "
            f"ON w.year_num = c.year_num AND w.week_num = c.week_num")


def _manifest(spark, sf):
    wanted = P.period_range(spark, *MANIFEST_RANGE, MANIFEST_AS_OF)
    result = weekly_summary(spark, sf, periods=wanted)
    return manifest(result, wanted)


@register("run_manifest", _manifest_sql())
def q_run_manifest(spark, sf):
    return _manifest(spark, sf)


@register("manifest_stats", f"""WITH m AS ({_manifest_sql()}) SELECT
  CAST(COUNT(*) AS BIGINT) AS periods, CAST(SUM(row_count) AS BIGINT) AS total_rows,
  AVG(row_count) AS mean_rows, CAST(MIN(row_count) AS BIGINT) AS min_rows,
  CAST(MAX(row_count) AS BIGINT) AS max_rows,
  CAST(COUNT(*) FILTER (WHERE row_count = 0) AS BIGINT) AS empty_periods FROM m""")
def q_manifest_stats(spark, sf):
    return manifest_stats(_manifest(spark, sf))


# -- K2..K17, S3..S7, T2: sinks, files, back-load, streaming -------------------
#
# These write under the session's checkpoint folder (a fresh folder per
# call) and return what a reader then sees.  Their input is the weekly
# per-category summary of the whole fact table.

from weekmart.session import scratch_dir  # noqa: E402
from weekmart.sinks.base import fan_out  # noqa: E402
from weekmart.sinks.deliver import DeliverySink, read_delivered  # noqa: E402
from weekmart.sinks.dialects import column_type  # noqa: E402
from weekmart.sinks.files import ExportSpec, export_csv, export_periods  # noqa: E402
from weekmart.sinks.table import TableSink  # noqa: E402
from weekmart.plans.manifest import file_manifest, load_status, run_ledger  # noqa: E402
from weekmart.functions.sizes import human_size  # noqa: E402
from weekmart.sinks.ledger import CheckedSink, latest, load_periods  # noqa: E402
from weekmart.sinks.versions import VersionedSink  # noqa: E402
from weekmart.sources.period_files import (  # noqa: E402
    backfill, backfill_schema, period_files, plan_backfill, read_period_files,
)
from weekmart.sources.tables import column_facts  # noqa: E402
from weekmart.streaming.load import stream_load  # noqa: E402

COARSE_SQL = O.summary_sql(dims=["fg1_name"])
COARSE_COLS = ["fg1_name", "year_num", "week_num", *O.MEASURES_SQL]


def _coarse(spark, sf, where=None) -> DataFrame:
    cube = sales_cube(spark, sf, dims=["Goods[fg1_name]"])
    if where is not None:
        cube.base = cube.base.where(where)
    return to_sink_form(cube_summary(cube, dims=["Goods[fg1_name]"]))


def _table(spark, key: str, **kw) -> TableSink:
    d = scratch_dir(spark, key)
    return TableSink(spark, f"wm_{key}_{d.rsplit('-', 1)[-1]}", location=f"{d}/table", **kw)


def _typed(df: DataFrame) -> DataFrame:
    return df.select(*[F.col(f"`{c}`").cast("int").alias(c) if c in KEYS else F.col(f"`{c}`")
                       for c in df.columns])


def _cols_sql(cols) -> str:
    return ", ".join(f'"{c}"' for c in cols)


def _facts_sql(text: str, whole: str, real: str, where: str = "true") -> str:
    """Rows (column, type, filled) of the coarse summary for a set of type names."""
    def kind(c):
        return text if c == "fg1_name" else whole if c in KEYS else real
    parts = [f"SELECT '{c}' AS \"column\", '{kind(c)}' AS type, count(\"{c}\") AS filled "
             f"FROM s WHERE {where}" for c in COARSE_COLS]
    return f"WITH s AS ({COARSE_SQL}) " + " UNION ALL ".join(parts)


@register("table_create", _facts_sql("string", "int", "double"))
def q_table_create(spark, sf):
    """The table as created from the summary's columns and loaded whole."""
    t = _table(spark, "table_create")
    s = _coarse(spark, sf)
    t.setup(s)
    t.insert(s)
    return column_facts(t.read())


@register("target_schema", _facts_sql("string", "int", "double"))
def q_target_schema(spark, sf):
    t = _table(spark, "target_schema")
    s = _coarse(spark, sf)
    t.upsert(s)
    return column_facts(t.read(), {f.name: f.dataType.simpleString() for f in t.schema().fields})


@register("dialect_types", _facts_sql("VARCHAR", "BIGINT", "DOUBLE"))
def q_dialect_types(spark, sf):
    s = _coarse(spark, sf)
    return column_facts(s, {f.name: column_type(f.dataType, "duckdb") for f in s.schema.fields})


_COMMISSION = "Комісія_по_кредитам"


@register("evolve_add_column", f"""WITH s AS ({COARSE_SQL})
  SELECT {_cols_sql(c for c in COARSE_COLS if c != _COMMISSION)},
    CASE WHEN year_num = 2000 THEN "{_COMMISSION}" END AS "{_COMMISSION}" FROM s""")
def q_evolve_add_column(spark, sf):
    s = _coarse(spark, sf)
    t = _table(spark, "evolve")
    t.upsert(s.where(F.col("year_num") != 2000).drop(_COMMISSION))
    t.upsert(s.where(F.col("year_num") == 2000))
    return _typed(t.read())


_SIZE_SQL = O.summary_sql(dims=["fg3_name"], measures=["Реалізація_к_сть"])


@register("widen_to_text", f"""WITH s AS ({_SIZE_SQL})
  SELECT CASE WHEN year_num = 2000 THEN 'size ' || fg3_name ELSE fg3_name END AS fg3_name,
    year_num, week_num, "Реалізація_к_сть" FROM s""")
def q_widen_to_text(spark, sf):
    cube = sales_cube(spark, sf, dims=["Goods[fg3_name]"])
    s = to_sink_form(cube_summary(cube, dims=["Goods[fg3_name]"], measure_names=["sell_qty"]))
    t = _table(spark, "widen")
    first = s.where(F.col("year_num") != 2000).withColumn("fg3_name", F.col("fg3_name").cast("long"))
    t.upsert(first)
    second = s.where(F.col("year_num") == 2000).withColumn(
        "fg3_name", F.concat(F.lit("size "), F.col("fg3_name")))
    t.upsert(second)
    return _typed(t.read())


@register("versioned_widen", f"""WITH s AS ({_SIZE_SQL})
  SELECT CASE WHEN year_num = 2000 THEN 'size ' || fg3_name ELSE fg3_name END AS fg3_name,
    year_num, week_num, "Реалізація_к_сть" FROM s""")
def q_versioned_widen(spark, sf):
    """The older weeks' files keep their numbers."""
    cube = sales_cube(spark, sf, dims=["Goods[fg3_name]"])
    s = to_sink_form(cube_summary(cube, dims=["Goods[fg3_name]"], measure_names=["sell_qty"]))
    t = VersionedSink(spark, f"{scratch_dir(spark, 'versioned_widen')}/t")
    t.upsert(s.where(F.col("year_num") != 2000).withColumn("fg3_name", F.col("fg3_name").cast("long")))
    t.upsert(s.where(F.col("year_num") == 2000).withColumn(
        "fg3_name", F.concat(F.lit("size "), F.col("fg3_name"))))
    return _typed(t.read())


@register("case_insensitive_load", COARSE_SQL)
def q_case_insensitive_load(spark, sf):
    """A table whose columns are spelled in one case, loaded from frames and week files
    that spell them in another."""
    s = _coarse(spark, sf)
    t = _table(spark, "cases")
    t.setup(s.limit(0))
    upper = s.toDF(*[c.upper() for c in s.columns])
    t.upsert(upper.where("YEAR_NUM < 2000"))
    t.insert(upper.where("YEAR_NUM = 2000"))
    path = f"{scratch_dir(spark, 'cases_csv')}/csv"
    later = s.where("year_num > 2000")
    export_csv(later.toDF(*[c if c in KEYS else c.upper() for c in later.columns]), path)
    backfill(spark, path, t, "csv", schema=_csv_schema(s))
    return _typed(t.read())


_LM_SQL = _month_sql(*_q_start(AS_OF, 1))


@register("delete_period", f"""WITH s AS ({COARSE_SQL}) SELECT * FROM s
  WHERE NOT ({O.in_periods(_LM_SQL, avail=False)})""")
def q_delete_period(spark, sf):
    t = _table(spark, "delete")
    t.upsert(_coarse(spark, sf))
    from weekmart.operators.filters import collect_periods
    for y, w in collect_periods(P.last_month(spark, AS_OF)):
        t.delete_period(y, w)
    return _typed(t.read())


_PROFIT = "Дохід_грн"


@register("insert_rows", f"""WITH s AS ({COARSE_SQL})
  SELECT {_cols_sql(c for c in COARSE_COLS if c != _PROFIT)} FROM s""")
def q_insert_rows(spark, sf):
    s = _coarse(spark, sf)
    t = _table(spark, "insert", evolve=False)
    t.setup(s.drop(_PROFIT).limit(0))
    t.insert(s.withColumn("not_in_target", F.lit("x")))
    return _typed(t.read())


_LQ_WEEKS = _quarter_sql(*_LAST_Q)


# The whole summary, with the returned rows alone in the last quarter's weeks.
REPLACED_SQL = f"""WITH s AS ({COARSE_SQL}),
  r AS ({O.summary_sql(dims=['fg1_name'], where="l_returnflag = 'R'")})
  SELECT * FROM s WHERE NOT ({O.in_periods(_LQ_WEEKS, avail=False)})
  UNION ALL SELECT * FROM r WHERE {O.in_periods(_LQ_WEEKS, avail=False)}"""


@register("upsert_idempotent", REPLACED_SQL)
def q_upsert_idempotent(spark, sf):
    t = _table(spark, "upsert")
    s = _coarse(spark, sf)
    t.upsert(s)
    t.upsert(s)
    returns = where_periods(_coarse(spark, sf, where=F.col("l_returnflag") == "R"),
                            P.last_quarter(spark, AS_OF))
    t.upsert(returns)
    t.upsert(returns)
    return _typed(t.read())


_N_COARSE = f"(SELECT count(*) FROM ({COARSE_SQL}))"


@register("fan_out_status", f"""SELECT 'table' AS sink, 'ok' AS status, {_N_COARSE} AS rows
  UNION ALL SELECT 'delivery', 'ok', {_N_COARSE}
  UNION ALL SELECT 'unreachable_store', 'error', 0""")
def q_fan_out_status(spark, sf):
    d = scratch_dir(spark, "fan_out")
    table = _table(spark, "fan_out_t")
    table.name = "table"
    # The second store is not there: nothing can be written below a device.
    sinks = [table,
             DeliverySink(spark, name="unreachable_store", path="/dev/null/store", retries=1),
             DeliverySink(spark, name="delivery", path=f"{d}/drop")]
    return fan_out(_coarse(spark, sf), sinks).select("sink", "status", "rows")


def _refusing(spark, key: str):
    """A store that holds rows of one category back in 2000-W10 and 2001-W42."""
    week = F.col("year_num") * 100 + F.col("week_num")
    store = VersionedSink(spark, f"{scratch_dir(spark, key)}/t", name="inner")
    return CheckedSink(store, ~(week.isin(200010, 200142) & (F.col("fg1_name") == CATEGORY)),
                       "category refused", name="checked_store")


_REFUSED_SQL = f"""SELECT DISTINCT year_num, week_num FROM s
  WHERE year_num * 100 + week_num IN (200010, 200142) AND fg1_name = '{CATEGORY}'"""


def _ledger_sql(wanted: str, *sinks: str) -> str:
    parts = [f"""SELECT '{k}' AS sink, w.year_num, w.week_num,
      CASE WHEN c.n IS NULL THEN 'empty' WHEN {bad} THEN 'error' ELSE 'ok' END AS status,
      CASE WHEN c.n IS NULL OR {bad} THEN 0 ELSE c.n END AS rows
      FROM wanted w LEFT JOIN c USING (year_num, week_num) LEFT JOIN x ON w.year_num = x.year_num AND w.week_num = x.week_num"""
             for k, bad in ((k, "x.year_num IS NOT NULL" if k == "checked_store" else "false") for k in sinks)]
    return (f"WITH s AS ({COARSE_SQL}), x AS ({_REFUSED_SQL}), wanted AS ({wanted}), "
            "c AS (SELECT year_num, week_num, count(*) AS n FROM s GROUP BY ALL) " + " UNION ALL ".join(parts))


@register("period_ledger", _ledger_sql("SELECT DISTINCT year_num, week_num FROM s", "table", "checked_store"))
def q_period_ledger(spark, sf):
    """A store that refuses a week keeps no other week out: the ledger, checked
    against what the stores hold."""
    table = _table(spark, "ledger")
    table.name = "table"
    checked = _refusing(spark, "ledger_store")
    ledger = load_periods(_coarse(spark, sf), [table, checked])
    held = [t.read().groupBy(*KEYS).agg(F.count("*").alias("held")).withColumn("held_by", F.lit(n))
            for n, t in (("table", table), ("checked_store", checked.sink))]
    stored = held[0].unionByName(held[1])
    rows = ledger.select("sink", *KEYS, "status").join(
        stored, (F.col("sink") == F.col("held_by")) & (ledger["year_num"] == stored["year_num"])
        & (ledger["week_num"] == stored["week_num"]), "left")
    return rows.select("sink", ledger["year_num"], ledger["week_num"], "status",
                       F.coalesce("held", F.lit(0)).alias("rows"))


@register("run_ledger", f"""SELECT sink, year_num, week_num, printf('%d-%02d', year_num, week_num) AS period,
  status, rows FROM ({_ledger_sql(_MANIFEST_WANTED, "checked_store")})""")
def q_run_ledger(spark, sf):
    """The manifest of a run with refused and empty weeks, read from the kept ledger."""
    wanted = P.period_range(spark, *MANIFEST_RANGE, MANIFEST_AS_OF)
    kept = f"{scratch_dir(spark, 'kept_ledger')}/ledger"
    load_periods(where_periods(_coarse(spark, sf), wanted), [_refusing(spark, "run_ledger")], wanted, kept)
    return run_ledger(latest(spark, kept)).select("sink", *KEYS, "period", "status", "rows")


@register("readable_sizes", f"""SELECT l_orderkey, l_linenumber, bytes,
  CASE WHEN bytes < 1024 THEN printf('%d Б', bytes)
    WHEN bytes < 1048576 THEN printf('%.1f КБ', bytes / 1024.0::DOUBLE)
    WHEN bytes < 1073741824 THEN printf('%.2f МБ', bytes / 1048576.0::DOUBLE)
    ELSE printf('%.2f ГБ', bytes / 1073741824.0::DOUBLE) END AS size
  FROM (SELECT *, CAST(floor(l_extendedprice) AS BIGINT) * CAST(pow(32, l_linenumber - 1) AS BIGINT) AS bytes FROM lineitem)""")
def q_readable_sizes(spark, sf):
    b = F.floor("l_extendedprice") * F.pow(F.lit(32), F.col("l_linenumber") - 1).cast("long")
    return _lineitem(spark, sf).select("l_orderkey", "l_linenumber", b.alias("bytes"), human_size(b).alias("size"))


def _versions(spark, key: str) -> VersionedSink:
    return VersionedSink(spark, f"{scratch_dir(spark, key)}/t")


@register("versioned_upsert", REPLACED_SQL)
def q_versioned_upsert(spark, sf):
    t = _versions(spark, "versions")
    s = _coarse(spark, sf)
    t.upsert(s)
    returns = where_periods(_coarse(spark, sf, where=F.col("l_returnflag") == "R"),
                            P.last_quarter(spark, AS_OF))
    t.upsert(returns)
    t.upsert(returns)
    t.vacuum()
    return _typed(t.read())


@register("load_status", f"""SELECT 'ok' AS status, count(DISTINCT year_num * 100 + week_num) AS n,
  CAST(count(*) AS BIGINT) AS rows FROM ({COARSE_SQL})""")
def q_load_status(spark, sf):
    path, s = _export(spark, sf, "load_status")
    return load_status(backfill(spark, path, _table(spark, "load_status"), "csv",
                                schema=_csv_schema(s)))


@register("deliver_with_retry", COARSE_SQL)
def q_deliver_with_retry(spark, sf):
    """Delivered twice, by another task layout: the second replaces the first."""
    d = scratch_dir(spark, "deliver")
    sink = DeliverySink(spark, path=f"{d}/drop")
    sink.upsert(_coarse(spark, sf).repartition(5))
    sink.upsert(_coarse(spark, sf).coalesce(2))
    return _typed(_delivered(spark, d))


@register("deliver_smaller_week", REPLACED_SQL)
def q_deliver_smaller_week(spark, sf):
    d = scratch_dir(spark, "deliver_smaller")
    sink = DeliverySink(spark, path=f"{d}/drop")
    sink.upsert(_coarse(spark, sf))
    sink.upsert(where_periods(_coarse(spark, sf, where=F.col("l_returnflag") == "R"),
                              P.last_quarter(spark, AS_OF)))
    return _typed(_delivered(spark, d))


def _delivered(spark, d):
    return read_delivered(spark, f"{d}/drop")


def _export(spark, sf, key, **kw) -> tuple[str, DataFrame]:
    d = scratch_dir(spark, key)
    s = _coarse(spark, sf)
    export_csv(s, f"{d}/csv", **kw)
    return f"{d}/csv", s


def _csv_schema(s: DataFrame) -> T.StructType:
    return T.StructType([f for f in s.schema.fields if f.name not in KEYS])


@register("csv_roundtrip", COARSE_SQL)
def q_csv_roundtrip(spark, sf):
    path, s = _export(spark, sf, "csv_roundtrip", quoting="all")
    schema = T.StructType(_csv_schema(s).fields + [T.StructField(k, T.IntegerType()) for k in KEYS])
    return spark.read.schema(schema).option("header", "true").option("sep", ";").csv(path)


_WEEKS_SQL = f"SELECT DISTINCT year_num, week_num FROM ({COARSE_SQL})"


@register("period_layout", f"SELECT *, true AS has_files FROM ({_WEEKS_SQL})")
def q_period_layout(spark, sf):
    path, _ = _export(spark, sf, "period_layout")
    files = period_files(spark, path, "csv")
    return file_manifest(files).select(*KEYS, (F.col("files") > 0).alias("has_files"))


@register("export_manifest", f"""SELECT f.format, year_num, week_num, CAST(count(*) AS BIGINT) AS rows
  FROM ({COARSE_SQL}), (SELECT unnest(['csv', 'parquet']) AS format) f GROUP BY ALL""")
def q_export_manifest(spark, sf):
    """Both formats of one export, counted from the files."""
    d = scratch_dir(spark, "export_manifest")
    s = _coarse(spark, sf)
    export_periods(s, ExportSpec(fmt="both", root=d))
    counts = [read_period_files(spark, f"{d}/{fmt}", fmt, schema=_csv_schema(s)).groupBy(*KEYS)
              .agg(F.count("*").alias("rows")).select(F.lit(fmt).alias("format"), *KEYS, "rows")
              for fmt in ("csv", "parquet")]
    return counts[0].unionByName(counts[1])


@register("compressed_export", COARSE_SQL)
def q_compressed_export(spark, sf):
    """A gzip export and what reading it back gives."""
    s = _coarse(spark, sf)
    path = f"{scratch_dir(spark, 'compressed_export')}/csv"
    export_csv(s, path, compression="gzip")
    return _typed(read_period_files(spark, path, "csv", schema=_csv_schema(s)))


@register("period_file_listing", f"SELECT * FROM ({_WEEKS_SQL}) WHERE year_num = 2000")
def q_period_file_listing(spark, sf):
    path, _ = _export(spark, sf, "listing")
    return period_files(spark, path, "csv", year=2000).select(*KEYS).distinct()


@register("backfill_plan", f"SELECT * FROM ({_WEEKS_SQL}) WHERE year_num = 1999 AND week_num = 7")
def q_backfill_plan(spark, sf):
    path, _ = _export(spark, sf, "backfill_plan")
    return plan_backfill(spark, path, "csv", year=1999, week=7).select(*KEYS).distinct()


@register("backfill_schema", _facts_sql("string", "int", "double"))
def q_backfill_schema(spark, sf):
    path, _ = _export(spark, sf, "schema")
    rows = read_period_files(spark, path, "csv")
    types = {f.name: f.dataType.simpleString() for f in backfill_schema(spark, path, "csv").fields}
    return column_facts(rows, types)


@register("backfill_read", COARSE_SQL)
def q_backfill_read(spark, sf):
    path, s = _export(spark, sf, "backfill_read")
    return read_period_files(spark, path, "csv", schema=_csv_schema(s))


@register("backfill_load", COARSE_SQL)
def q_backfill_load(spark, sf):
    path, s = _export(spark, sf, "backfill_load")
    t = _table(spark, "backfill_load")
    status = backfill(spark, path, t, "csv", schema=_csv_schema(s))
    bad = status.where(F.col("status") != "ok").count()
    if bad:
        raise AssertionError(f"{bad} periods did not load")
    return _typed(t.read())


@register("stream_period_load", COARSE_SQL)
def q_stream_period_load(spark, sf):
    path, s = _export(spark, sf, "stream_src")
    t = _table(spark, "stream_load")
    ck = scratch_dir(spark, "stream_ckpt")
    q = stream_load(spark, path, t, ck, _csv_schema(s), "csv")
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()
    return _typed(t.read())


# -- A2: grouping without measures (distinct members) --------------------------

@register("distinct_keys", "WITH " + O.base_cte()
          + ' SELECT DISTINCT fg1_name, "Price_types_name" AS name FROM base')
def q_distinct_keys(spark, sf):
    from weekmart.plans.summary import summarize
    dims = ["Goods[fg1_name]", "Price_types[name]"]
    cube = sales_cube(spark, sf, dims=dims)
    return to_sink_form(summarize(cube.base, dims, []))


# -- §3.1: one whole run (periods -> summary -> sinks -> manifest) -------------

@register("weekly_export_run", f"""WITH wanted AS ({O.semi_available(_LQ_WEEKS)}),
  res AS ({O.summary_sql()}),
  c AS (SELECT year_num, week_num, COUNT(*) AS n FROM res GROUP BY 1, 2)
  SELECT w.year_num, w.week_num, printf('%d-%02d', w.year_num, w.week_num) AS period,
    COALESCE(c.n, 0) AS row_count FROM wanted w LEFT JOIN c
    ON w.year_num = c.year_num AND w.week_num = c.week_num""")
def q_weekly_export_run(spark, sf):
    from weekmart.run import run_weekly_export
    spec = ExportSpec(fmt="table", sinks=[_table(spark, "run")])
    run = run_weekly_export(spark, sf, AS_OF, None, P.PeriodSpec(rule="last-quarter"), spec=spec)
    bad = run.sinks.where(F.col("status") != "ok").count()
    if bad:
        raise AssertionError("a sink failed")
    return run.manifest


# -- storage layout: the same quarter read from the week-partitioned, ----------
# -- order-key-bucketed layout (partition pruning, shuffle-free order join) ----

@register("period_filter_layout", O.summary_sql(where=O.in_periods(_quarter_sql(*_LAST_Q))))
def q_period_filter_layout(spark, sf):
    from weekmart.plans.layout import build_sales_layout
    d = scratch_dir(spark, "layout")
    src = build_sales_layout(spark, sf, f"wm_layout_{d.rsplit('-', 1)[-1]}", d, buckets=4)
    wanted = P.keep_available(P.last_quarter(spark, AS_OF), _avail(spark, src))
    return weekly_summary(spark, src, periods=wanted)
