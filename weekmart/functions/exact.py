"""Exact sums of doubles.

A double is cut into four whole numbers, its bits from 2^10 up, from 2^-22, from
2^-54 and from 2^-86; each part is summed as a long inside whole-stage codegen.
Whole-number sums do not depend on the order, so partial sums merge to the same total
however the rows are dealt, and only the total is rounded to a double.

Every value of at most 2^73 whose last bit is worth 2^-86 or more is exact: all
doubles from 2^-33 on.  Smaller bits are cut off.  A group may hold 2^31 rows.  A
larger value raises under ANSI mode."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WIDTH = 32
UNITS = (10, -22, -54, -86)      # powers of two that one in each part is worth


def _power(n: int) -> Column:
    return F.lit(2.0 ** n)


def parts(value: Column) -> list[Column]:
    """``value`` as whole numbers of each unit, cut towards zero."""
    out, rest = [], value
    for unit in UNITS:
        whole = (rest * _power(-unit)).cast("long")
        out.append(whole)
        # Exact: the difference of a double and its own leading bits.
        rest = rest - whole.cast("double") * _power(unit)
    return out


def rounded(sums: list[Column]) -> Column:
    """The total of summed parts as a double.  Carries leave parts of at most half
    the next unit, so that adding them from small to large loses no digits."""
    parts_now, out = list(sums), []
    for i in range(len(sums) - 1, 0, -1):
        carry = F.shiftright(parts_now[i] + F.lit(1 << (WIDTH - 1)), WIDTH)
        out.append(parts_now[i] - F.shiftleft(carry, WIDTH))
        parts_now[i - 1] = parts_now[i - 1] + carry
    out.append(parts_now[0])
    d3, d2, d1, d0 = (p.cast("double") * _power(u) for p, u in zip(out, reversed(UNITS)))
    return (d0 + d1) + (d2 + d3)


def _finite(value: Column) -> Column:
    return F.abs(value) < F.lit(float("inf"))            # NaN is the largest value


def exact_sums(df: DataFrame, keys: list[str], values: dict[str, Column],
               drop_blank: bool = False) -> DataFrame:
    """``df`` grouped by ``keys`` with the exact sum of each double column in ``values``.
    Nulls are left out; no value gives null, and so does any NaN or infinite one.  With
    ``drop_blank`` groups in which no measure has a value go.

    The parts are columns of the aggregate and put together in a projection above it,
    where Spark evaluates each common expression once; blank groups are told by the
    parts, as a filter above would repeat the projection."""
    columns, totals, filled = [], [], F.lit(False)
    for i, (name, value) in enumerate(values.items()):
        value = value.cast("double")
        names = [f"__sum{i}_{j}" for j in range(len(UNITS))]
        columns += [F.sum(p).alias(n) for n, p in zip(names, parts(F.when(_finite(value), value)))]
        columns.append(F.bool_or(~_finite(value)).alias(f"__odd{i}"))
        # Not null as soon as the measure had a value, finite or not.
        filled = filled | F.col(f"__odd{i}").isNotNull()
        # Zeros for nulls and no condition around the total: so the generated code
        # shares its steps and stays small enough for the JVM's compiler.
        total = rounded([F.coalesce(n, F.lit(0)) for n in names])
        totals.append((total + F.when(~F.col(f"__odd{i}"), F.lit(0.0))).alias(name))
    quoted = [F.col("`" + k.replace("`", "``") + "`") for k in keys]
    sums = df.groupBy(*quoted).agg(*columns)
    return (sums.where(filled) if drop_blank else sums).select(*quoted, *totals)
