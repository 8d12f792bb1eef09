"""The weekly summary: filter, group, measure, name, clean.

``weekly_summary`` is the whole Spark form of one export run:
resolve periods -> prune the fact scan to their dates -> keys of the star's
arms -> sums by those keys -> names of the 23 cube columns (``keyed``) -> drop
blank groups -> bare names -> safe names, ±inf -> null.  One Catalyst
plan covers every period at once; partial (map-side) aggregation runs
before the shuffle, so a hot group is combined in each task first.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from weekmart.functions.dates import iso_week, iso_year
from weekmart.functions.exact import exact_sums
from weekmart.functions.names import bare_names, safe_names
from weekmart.functions.values import finite_frame
from weekmart.operators.filters import KEYS, where_periods, with_period
from weekmart.plans.model import CubeModel
from weekmart.plans.keyed import keyed_summary, ordered_summary
from weekmart.plans.sales_cube import read_table


def _q(name: str) -> Column:
    return F.col(f"`{name}`")


def summarize(df: DataFrame, dims: list[str], measures: list[tuple[str, Column]],
              drop_blank: bool = True) -> DataFrame:
    """Group by ``dims`` with the named exact sums of ``measures``.  A group is kept
    only if at least one measure is non-blank.  Without measures this is the
    distinct combinations of ``dims``."""
    if not measures:
        return df.select(*[_q(d) for d in dims]).distinct()
    return exact_sums(df, dims, dict(measures), drop_blank)


def available_periods(fact: DataFrame, date_col: str = "l_shipdate",
                      qty_col: str = "l_quantity") -> DataFrame:
    """Distinct (year_num, week_num) whose quantity is not blank.  Reads
    two columns; partial aggregation leaves one row per week per task."""
    y = iso_year(date_col).try_cast("int")
    w = iso_week(date_col).try_cast("int")
    return (fact.select(y.alias("year_num"), w.alias("week_num"), F.col(qty_col).alias("q"))
            .where(F.col("year_num").isNotNull() & F.col("week_num").isNotNull())
            .groupBy(*KEYS).agg(F.sum("q").alias("q"))
            .where(F.col("q").isNotNull())
            .select(*KEYS))


def sales_available_periods(spark: SparkSession, sf_dir: str) -> DataFrame:
    return available_periods(read_table(spark, sf_dir, "lineitem"))


def bare_columns(df: DataFrame) -> DataFrame:
    return df.toDF(*bare_names(df.columns))


def safe_columns(df: DataFrame) -> DataFrame:
    return df.toDF(*safe_names(df.columns))


def cube_summary(cube: CubeModel, dims: list[str] | None = None,
                 measure_names: list[str] | None = None, with_keys: bool = True,
                 drop_blank: bool = True) -> DataFrame:
    """Grouped cube result with cube names (qualified dims, measure captions)."""
    dims = list(cube.dimensions if dims is None else dims)
    if with_keys:
        dims = dims + KEYS
    ms = cube.measures if measure_names is None else [cube.measure(n) for n in measure_names]
    return summarize(cube.base, dims, [(m.caption, m.value) for m in ms], drop_blank=drop_blank)


def to_sink_form(df: DataFrame) -> DataFrame:
    """Cube names -> bare names -> safe identifiers; ±inf/NaN -> null."""
    return finite_frame(safe_columns(bare_columns(df)))


def weekly_summary(spark: SparkSession, sf_dir: str, periods: DataFrame | None = None,
                   category: str | None = None, dims: list[str] | None = None,
                   measure_names: list[str] | None = None, ordered: bool = False) -> DataFrame:
    """The export's result in sink form for the given periods (all weeks
    when ``periods`` is None), optionally for one ``fg1_name`` category.  ``ordered`` deals
    the same rows by ranges of the export's order, for a sort (``sort_summary``) above."""
    fact = read_table(spark, sf_dir, "lineitem")
    if periods is not None:
        if sf_dir.startswith("catalog:"):
            # The layout is partitioned by period: prune directories directly.
            fact = where_periods(fact, periods)
        else:
            fact = where_periods(with_period(fact, "l_shipdate"), periods, "l_shipdate")
    # A stored layout has its own way of meeting the orders, and a choice of columns is narrow.
    if ordered and not (sf_dir.startswith("catalog:") or category or dims or measure_names):
        return safe_columns(bare_columns(ordered_summary(spark, sf_dir, fact)))
    # The exact sums are finite or null, and no other column is a double.
    return safe_columns(bare_columns(
        keyed_summary(spark, sf_dir, fact, dims, measure_names, category)))


def sort_summary(df: DataFrame, keys: list[str]) -> DataFrame:
    """Ascending on every grouping column (nulls first), as the export orders
    rows.  Range-partitioned sort: no single task holds a whole week."""
    return df.orderBy(*[_q(k).asc_nulls_first() for k in keys])
