"""DuckDB SQL that states, independently of the Spark code, what each
registered query must return on the driver's tables."""

from __future__ import annotations

import datetime as _dt

from weekmart.plans.sales_cube import CREDIT_PRODUCTS, PROMO

SERIAL = "CAST(datediff('day', DATE '1899-12-30', CAST({c} AS DATE)) AS BIGINT)"
ISO_Y = "CAST(isoyear({c}) AS INTEGER)"
ISO_W = "CAST(weekofyear({c}) AS INTEGER)"


def _lit(v) -> str:
    if v is None:
        return "NULL"
    if isinstance(v, str):
        return "'" + v.replace("'", "''") + "'"
    return str(v)


def _values(rows) -> str:
    return ", ".join("(" + ", ".join(_lit(v) for v in r) + ")" for r in rows)


def base_cte() -> str:
    """One row per lineitem with every cube column (sink names) and the
    measure inputs."""
    return f"""
od AS (
  SELECT o.o_orderkey, c.c_name, n.n_name, c.c_mktsegment, o.o_orderpriority, o.o_orderstatus
  FROM orders o
  LEFT JOIN customer c ON o.o_custkey = c.c_custkey
  LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
),
credit(cp_key, payment_code, payment_typ, product_types, bank_name,
       bank_credit_product_code, product_name, payment_count) AS (
  VALUES {_values(CREDIT_PRODUCTS)}
),
promo(pr_key, promo_type_name, basis) AS (VALUES {_values(PROMO)}),
base AS (
  SELECT l.l_orderkey, l.l_linenumber, l.l_shipdate,
    {SERIAL.format(c='l.l_shipdate')} AS calendar_date,
    p.p_type AS fg1_name, p.p_brand AS fg2_name, CAST(p.p_size AS VARCHAR) AS fg3_name,
    p.p_name AS fg4_name, CAST(l.l_partkey AS VARCHAR) AS articul, p.p_name AS articul_name,
    s.s_name AS producer_name, od.c_name AS "Agents_hybrid_name",
    od.n_name AS doc_prefix_original, od.c_mktsegment AS sell_channel_type_name,
    od.o_orderpriority AS "Price_types_name", (l.l_returnflag = 'R') AS is_tender,
    od.o_orderstatus AS "Doc_types_name",
    cr.payment_code, cr.payment_typ, cr.product_types, cr.bank_name,
    cr.bank_credit_product_code, cr.product_name, CAST(cr.payment_count AS BIGINT) AS payment_count,
    pr.promo_type_name, pr.basis,
    {ISO_Y.format(c='l.l_shipdate')} AS year_num, {ISO_W.format(c='l.l_shipdate')} AS week_num,
    l.l_quantity, l.l_extendedprice, l.l_discount, l.l_tax, p.p_retailprice, l.l_returnflag
  FROM lineitem l
  LEFT JOIN od ON l.l_orderkey = od.o_orderkey
  LEFT JOIN part p ON l.l_partkey = p.p_partkey
  LEFT JOIN supplier s ON l.l_suppkey = s.s_suppkey
  LEFT JOIN credit cr ON l.l_linestatus = cr.cp_key
  LEFT JOIN promo pr ON l.l_returnflag = pr.pr_key
)"""


DIMS_SAFE = [
    "calendar_date", "fg1_name", "fg2_name", "fg3_name", "fg4_name", "articul",
    "articul_name", "producer_name", "Agents_hybrid_name", "doc_prefix_original",
    "sell_channel_type_name", "Price_types_name", "is_tender", "Doc_types_name",
    "payment_code", "payment_typ", "product_types", "bank_name",
    "bank_credit_product_code", "product_name", "payment_count", "promo_type_name", "basis",
]

_SELL, _BUY, _BONUS = "l_extendedprice * (1 - l_discount)", "p_retailprice * l_quantity", \
    "l_extendedprice * l_discount"


def exact_sum_sql(value: str) -> str:
    """The exact sum of doubles: each is a whole number of 2^-80, added as HUGEINT."""
    return f"(CAST(SUM(CAST(({value}) * pow(2, 80) AS HUGEINT)) AS DOUBLE) / pow(2, 80))"


MEASURES_SQL = {
    "Реалізація_к_сть": exact_sum_sql("l_quantity"),
    "Реалізація_грн": exact_sum_sql(_SELL),
    "Реалізація_ЦЗ_грн": exact_sum_sql(_BUY),
    "Дохід_грн": exact_sum_sql(f"{_SELL} - {_BUY}"),
    "Отримані_бонуси": exact_sum_sql(_BONUS),
    "Використані_бонуси": exact_sum_sql(f"CASE WHEN l_returnflag = 'R' THEN {_BONUS} END"),
    "Комісія_по_кредитам": exact_sum_sql("l_extendedprice * l_tax"),
}


def _qi(name: str) -> str:
    return '"' + name.replace('"', '""') + '"'


def summary_sql(dims: list[str] | None = None, measures: list[str] | None = None,
                where: str = "TRUE", order: bool = False) -> str:
    dims = (DIMS_SAFE if dims is None else dims) + ["year_num", "week_num"]
    ms = list(MEASURES_SQL) if measures is None else measures
    cols = ", ".join(_qi(d) for d in dims)
    aggs = ", ".join(f"CAST({MEASURES_SQL[m]} AS DOUBLE) AS {_qi(m)}" for m in ms)
    having = " OR ".join(f"{MEASURES_SQL[m]} IS NOT NULL" for m in ms)
    sql = (f"WITH {base_cte()}\nSELECT {cols}, {aggs} FROM base WHERE {where} "
           f"GROUP BY {cols} HAVING {having}")
    if order:
        sql += " ORDER BY " + ", ".join(f"{_qi(d)} ASC NULLS FIRST" for d in dims)
    return sql


AVAILABLE_SQL = f"""
SELECT year_num, week_num FROM (
  SELECT {ISO_Y.format(c='l_shipdate')} AS year_num, {ISO_W.format(c='l_shipdate')} AS week_num,
         SUM(l_quantity) AS q
  FROM lineitem WHERE l_shipdate IS NOT NULL GROUP BY 1, 2
) WHERE q IS NOT NULL"""


def days_weeks_sql(lo: _dt.date, hi: _dt.date) -> str:
    """Distinct ISO weeks touched by the days lo..hi."""
    return (f"SELECT DISTINCT {ISO_Y.format(c='d')} AS year_num, {ISO_W.format(c='d')} AS week_num "
            f"FROM (SELECT CAST(generate_series AS DATE) AS d FROM generate_series("
            f"DATE '{lo}', DATE '{hi}', INTERVAL 1 DAY))")


def month_end(y: int, m: int) -> _dt.date:
    nxt = _dt.date(y + (m == 12), m % 12 + 1, 1)
    return nxt - _dt.timedelta(days=1)


def last_weeks_sql(as_of: _dt.date, n: int) -> str:
    return (f"SELECT DISTINCT {ISO_Y.format(c='d')} AS year_num, {ISO_W.format(c='d')} AS week_num "
            f"FROM (SELECT CAST(DATE '{as_of}' - CAST(7 * i AS INTEGER) AS DATE) AS d "
            f"FROM range(0, {n}) t(i))")


def range_sql(a: tuple[int, int], b: tuple[int, int]) -> str:
    """Weeks from ISO week a to ISO week b, both included (DuckDB's own
    ISO calendar: every day between the two Mondays' weeks)."""
    lo = _dt.date.fromisocalendar(*a, 1)
    hi = _dt.date.fromisocalendar(*b, 7)
    return days_weeks_sql(lo, hi)


def semi_available(wanted_sql: str) -> str:
    return (f"WITH wanted AS ({wanted_sql}), available AS ({AVAILABLE_SQL}) "
            f"SELECT w.year_num, w.week_num FROM wanted w SEMI JOIN available a "
            f"ON w.year_num = a.year_num AND w.week_num = a.week_num")


def anti_available(wanted_sql: str) -> str:
    return (f"WITH wanted AS ({wanted_sql}), available AS ({AVAILABLE_SQL}) "
            f"SELECT w.year_num, w.week_num FROM wanted w ANTI JOIN available a "
            f"ON w.year_num = a.year_num AND w.week_num = a.week_num")


def in_periods(wanted_sql: str, avail: bool = True) -> str:
    src = semi_available(wanted_sql) if avail else wanted_sql
    return f"year_num * 100 + week_num IN (SELECT year_num * 100 + week_num FROM ({src}))"
