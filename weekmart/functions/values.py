"""Value cleaning and type alignment, all as built-in column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weekmart.functions.dates import date_serial

# Fixed value: date text accepted for serial conversion -- a date, optionally
# followed by a space and a time of day.
DATE_TEXT_PATTERN = r"^\d{4}-\d{2}-\d{2}( \d{2}:\d{2}:\d{2})?$"

_INF = float("inf")
_FLOATS = (T.FloatType, T.DoubleType)
_INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_DATES = (T.DateType, T.TimestampType, T.TimestampNTZType)


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def finite(c) -> Column:
    """+inf, -inf and NaN -> null; other values unchanged."""
    c = _c(c)
    return F.when(F.isnan(c) | (F.abs(c) == F.lit(_INF)), F.lit(None)).otherwise(c)


def finite_frame(df: DataFrame) -> DataFrame:
    """Apply :func:`finite` to every float/double column."""
    cols = [
        finite(F.col(f"`{f.name}`")).cast(f.dataType).alias(f.name)
        if isinstance(f.dataType, _FLOATS) else F.col(f"`{f.name}`")
        for f in df.schema.fields
    ]
    return df.select(*cols)


def _plain(text: Column) -> Column:
    """Number text in plain notation: ``1.25E7`` -> ``12500000``, ``1.0E-5`` ->
    ``0.00001``; digits are moved, never recomputed.  A fraction of zeros goes."""
    sign = F.when(F.startswith(text, F.lit("-")), "-").otherwise("")
    parts = F.split(F.ltrim(text, F.lit("-")), "[eE]")
    mantissa = F.split(parts[0], r"\.")
    whole, fraction = mantissa[0], F.coalesce(F.get(mantissa, F.lit(1)), F.lit(""))
    digits = F.concat(whole, fraction)
    # Where the point stands among the digits.
    point = F.length(whole) + F.coalesce(F.get(parts, F.lit(1)).cast("int"), F.lit(0))
    zeros = lambda n: F.repeat(F.lit("0"), F.greatest(n, F.lit(0)))
    before = F.concat(F.substring(digits, F.lit(1), F.greatest(point, F.lit(0))),
                      zeros(point - F.length(digits)))
    after = F.concat(zeros(-point), F.substring(digits, F.greatest(point, F.lit(0)) + 1,
                                                F.length(digits)))
    before = F.ltrim(before, F.lit("0"))
    after = F.rtrim(after, F.lit("0"))
    out = F.concat(sign, F.when(before == "", "0").otherwise(before),
                   F.when(after == "", "").otherwise(F.concat(F.lit("."), after)))
    return F.when(out == "-0", "0").otherwise(out)


def _shortest(text: Column) -> Column:
    """:func:`_plain`, which few numbers need: text without an exponent is plain but
    for the zeros behind its point."""
    trimmed = F.rtrim(F.rtrim(text, F.lit("0")), F.lit("."))
    return F.when(F.contains(text, F.lit("E")), _plain(text)) \
        .when(~F.contains(text, F.lit(".")), text).when(trimmed == "-0", "0").otherwise(trimmed)


def number_to_text(c, dtype: T.DataType = T.DoubleType()) -> Column:
    """Number -> text for a text target, in plain notation from the shortest
    digits that give the same number: whole numbers lose the '.0' (3.0 -> '3',
    1e20 -> '100000000000000000000'), NaN/inf -> null, decimals keep every digit."""
    c = _c(c)
    if isinstance(dtype, _INTEGRAL):
        return c.cast("string")
    if isinstance(dtype, T.DecimalType):
        return _shortest(c.cast("string"))
    return _shortest(finite(c).cast("string"))


def text_to_serial(c) -> Column:
    """'YYYY-MM-DD[ HH:MM:SS]' text -> serial day; other or invalid text -> null."""
    c = _c(c)
    ts = F.coalesce(
        F.try_to_timestamp(c, F.lit("yyyy-MM-dd HH:mm:ss")),
        F.try_to_timestamp(c, F.lit("yyyy-MM-dd")),
    )
    return F.when(c.rlike(DATE_TEXT_PATTERN), date_serial(ts))


def coerce_column(c, source: T.DataType, target: T.DataType, nullable: bool = True) -> Column:
    """Coerce one column to a target type; a value that does not convert
    becomes null (never the whole column left as is)."""
    c = _c(c)
    if isinstance(target, _INTEGRAL):
        if isinstance(source, _INTEGRAL):
            return c.cast(target)
        if isinstance(source, T.StringType):
            d = F.trim(c).try_cast("double")
            exact = F.trim(c).try_cast(target)
            return F.coalesce(exact, F.when(d == F.rint(d), d.try_cast(target)))
        if isinstance(source, _DATES):
            return date_serial(c).cast(target)
        d = c.try_cast("double")
        return F.when(d == F.rint(d), d.try_cast(target))
    if isinstance(target, _FLOATS):
        out = (F.trim(c) if isinstance(source, T.StringType) else c).try_cast(target)
        return out
    if isinstance(target, T.StringType):
        if isinstance(source, (T.FloatType, T.DoubleType, T.DecimalType)):
            out = number_to_text(c, source)
        else:
            out = c.cast("string")
        return out if nullable else F.coalesce(out, F.lit(""))
    if isinstance(target, (T.TimestampType, T.TimestampNTZType)):
        if isinstance(source, T.StringType):
            return F.try_to_timestamp(c).cast(target)
        return c.try_cast(target)
    if isinstance(target, T.DateType):
        if isinstance(source, T.StringType):
            return F.to_date(F.try_to_timestamp(c))
        return c.try_cast(target)
    if isinstance(target, T.BooleanType):
        return c.try_cast(target)
    return c.try_cast(target)


def coerce(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Align a frame to a target schema: keep the target's columns that the
    frame has, whatever their case (in the target's order), and coerce each to
    the target type."""
    from weekmart.operators.columns import matched
    df, have = matched(df, schema.fieldNames())
    cols = []
    for f in schema.fields:
        if f.name in have:
            column, source = have[f.name]
            cols.append(coerce_column(column, source, f.dataType, f.nullable).alias(f.name))
    return df.select(*cols)


def normalise_cells(df: DataFrame) -> DataFrame:
    """Result-cell normal form: dates/timestamps -> serial day (long),
    decimals/floats -> double, integers -> long, text and booleans as is,
    anything else -> text."""
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        t = f.dataType
        if isinstance(t, _DATES):
            c = date_serial(c)
        elif isinstance(t, (T.DecimalType, T.FloatType, T.DoubleType)):
            c = c.cast("double")
        elif isinstance(t, _INTEGRAL):
            c = c.cast("long")
        elif isinstance(t, (T.StringType, T.BooleanType, T.NullType)):
            pass
        else:
            c = c.cast("string")
        cols.append(c.alias(f.name))
    return df.select(*cols)
