"""Exact sums of doubles."""

import math
import random

from pyspark.sql import functions as F

from weekmart.functions.exact import exact_sums


def test_sums_are_correctly_rounded_in_any_order(spark):
    rng = random.Random(1)
    make = [lambda: rng.uniform(-1e6, 1e6), lambda: rng.random() / 7, lambda: -rng.random() * 1e-5,
            lambda: 1e12 * rng.random(), lambda: rng.randint(-5, 5) / 3, lambda: rng.uniform(0, 1e5) / 7]
    rows = [(g, rng.choice(make)()) for g in range(200) for _ in range(rng.randint(1, 40))]
    rows += [(900, 1e15), (900, 1e-7), (900, -1e15)]
    df = spark.createDataFrame(rows, "g int, x double")
    one = {r.g: r.s for r in exact_sums(df.coalesce(1), ["g"], {"s": F.col("x")}).collect()}
    many = {r.g: r.s for r in exact_sums(df.repartition(9), ["g"], {"s": F.col("x")}).collect()}
    assert one == many and one[900] == 1e-7
    want = {g: math.fsum(x for k, x in rows if k == g) for g in one}
    assert all(abs(one[g] - want[g]) <= math.ulp(want[g]) for g in one)
    assert sum(one[g] != want[g] for g in one) <= 2     # ties of the last rounding only


def test_blank_and_odd_values(spark):
    nan, inf = math.nan, math.inf
    df = spark.createDataFrame([(1, None, None), (2, nan, 1.0), (2, 1.0, None), (3, inf, None), (4, 0.055, 0.0)],
                               "g int, x double, y double")
    sums = {"x": F.col("x"), "y": F.col("y")}
    assert {r.g: (r.x, r.y) for r in exact_sums(df, ["g"], sums).collect()} == \
        {1: (None, None), 2: (None, 1.0), 3: (None, None), 4: (0.055, 0.0)}
    assert {r.g for r in exact_sums(df, ["g"], sums, drop_blank=True).collect()} == {2, 3, 4}
