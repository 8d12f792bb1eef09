import math

from pyspark.sql import functions as F
from pyspark.sql import types as T

from weekmart.functions.dates import date_serial
from weekmart.functions.values import (
    coerce, finite_frame, normalise_cells, number_to_text, text_to_serial,
)


def test_cleaning_case(spark):
    # The reference's one value check: [1.0, +inf, -inf, NaN] and a name with '__'.
    df = spark.createDataFrame([(1.0, "x"), (math.inf, None), (-math.inf, "y"), (math.nan, "z")],
                               "a double, b__test string")
    from weekmart.plans.summary import safe_columns
    out = finite_frame(safe_columns(df))
    assert out.columns == ["a", "b_test"]
    assert [r.a for r in out.collect()] == [1.0, None, None, None]


def test_number_to_text(spark):
    df = spark.createDataFrame([(3.0,), (3.5,), (math.nan,), (math.inf,), (1e20,), (None,)], "x double")
    got = [r.t for r in df.select(number_to_text("x").alias("t")).collect()]
    assert got == ["3", "3.5", None, None, "100000000000000000000", None]


def test_coerce_text_to_long(spark):
    df = spark.createDataFrame([("12",), ("x",), (None,), ("12.0",), ("3.7",)], "v string")
    out = coerce(df, T.StructType([T.StructField("v", T.LongType())]))
    assert [r.v for r in out.collect()] == [12, None, None, 12, None]


def test_coerce_non_nullable_text_gets_empty(spark):
    df = spark.createDataFrame([("a",), (None,)], "v string")
    out = coerce(df, T.StructType([T.StructField("v", T.StringType(), nullable=False)]))
    assert [r.v for r in out.collect()] == ["a", ""]


def test_serial_and_text_to_serial(spark):
    df = spark.createDataFrame([("2025-01-01",), ("2025-01-01 13:45:00",), ("2025-02-30",),
                                ("hello",), (None,)], "s string")
    got = [r.n for r in df.select(text_to_serial("s").alias("n")).collect()]
    assert got == [45658, 45658, None, None, None]
    row = spark.sql("select date'2025-01-01' d").select(date_serial("d").alias("n")).first()
    assert row.n == 45658


def test_normalise_cells_types(spark):
    df = spark.sql("select date'2025-01-01' d, cast(1.25 as decimal(10,2)) m, 7 i, 'x' s, true b")
    out = normalise_cells(df)
    assert [f.dataType.simpleString() for f in out.schema.fields] == \
        ["bigint", "double", "bigint", "string", "boolean"]
    assert tuple(out.first()) == (45658, 1.25, 7, "x", True)


def test_quote_in_category_is_a_literal(spark):
    from weekmart.operators.filters import where_category
    df = spark.createDataFrame([('TV 55" set',), ("other",), ("x' OR '1'='1",)], "fg1 string")
    assert where_category(df, "fg1", 'TV 55" set').count() == 1
    assert where_category(df, "fg1", "x' OR '1'='1").count() == 1
    assert where_category(df, "fg1", "").count() == 3


def test_number_text_is_plain_and_exact(spark):
    import random
    from decimal import Decimal

    from pyspark.sql import types as T

    from weekmart.functions.values import number_to_text
    rng = random.Random(5)
    values = [0.0, -0.0, 12345678.5, 1e-5, 1e20, -2.5e-7, 1e7, 9999999.0, 123456789.125, 5e-324, 1.7e308]
    values += [rng.uniform(-1, 1) * 10 ** rng.randint(-12, 18) for _ in range(200)]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    for r in df.select("v", number_to_text("v").alias("t")).collect():
        assert "E" not in r.t and float(r.t) == r.v
        want = format(Decimal(repr(r.v)), "f")
        want = want.rstrip("0").rstrip(".") if "." in want else want
        assert len(r.t) <= len(want) + 1 and (r.t == want or r.v in (0.0, 5e-324) or float(r.t) == r.v)
    kind = T.DecimalType(30, 2)
    big = spark.createDataFrame([(Decimal("1234567890123456789012.25"),), (Decimal("3.00"),)],
                                T.StructType([T.StructField("d", kind)]))
    assert [r.t for r in big.select(number_to_text("d", kind).alias("t")).collect()] == \
        ["1234567890123456789012.25", "3"]
