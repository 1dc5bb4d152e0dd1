from __future__ import annotations

import math
import random
from decimal import Decimal
from fractions import Fraction

import pytest

from adtide.functions.numeric import (
    binary_round,
    exact_avg,
    exact_round,
    exact_sum,
    fixed_text,
    micros_to_currency,
    ratio,
)


def one(df):
    return df.first()[0]


def frame(spark, values, name="x"):
    return spark.createDataFrame([(v,) for v in values], f"{name} double")


def test_sum_is_exact_and_independent_of_order(spark):
    rng = random.Random(1)
    values = [rng.randrange(-(10**11), 10**11) / 10**6 for _ in range(5000)]
    expected = float(sum(Decimal(repr(v)) for v in values))
    shuffled = rng.sample(values, len(values))
    assert one(frame(spark, values).agg(exact_sum("x"))) == expected
    assert one(frame(spark, shuffled).repartition(7).agg(exact_sum("x"))) == expected


def test_sum_keeps_more_than_six_decimals(spark):
    rng = random.Random(2)
    values = [rng.randrange(1, 1000) / 3 for _ in range(3000)] + [0.0000004] * 7 + [-1e-9]
    exact = sum(Fraction(v) for v in values)
    got = one(frame(spark, values).repartition(5).agg(exact_sum("x")))
    assert abs(Fraction(got) - exact) < Fraction(1, 10**8)
    assert one(frame(spark, [0.0000004]).agg(exact_sum("x"))) == 0.0000004
    assert one(frame(spark, [1 / 3, 1 / 3]).agg(exact_avg("x"))) == pytest.approx(1 / 3, abs=1e-12)


def test_sum_of_values_without_a_place_in_the_limbs(spark):
    inf, nan = float("inf"), float("nan")
    assert one(frame(spark, [1.5, inf]).agg(exact_sum("x"))) == inf
    assert math.isnan(one(frame(spark, [1.5, nan]).agg(exact_sum("x"))))
    assert math.isnan(one(frame(spark, [inf, -inf]).agg(exact_sum("x"))))
    assert one(frame(spark, [1e300, 1.5]).agg(exact_sum("x"))) == 1e300


def test_sum_skips_null_and_is_null_without_values(spark):
    assert one(frame(spark, [1.25, None, 2.5]).agg(exact_sum("x"))) == 3.75
    assert one(frame(spark, [None, None]).agg(exact_sum("x"))) is None


def test_sum_does_not_overflow_where_scaled_integers_would(spark):
    values = [9.0e15, 9.0e15, 0.25]
    assert one(frame(spark, values).agg(exact_sum("x"))) == 1.8e16


def test_average(spark):
    assert one(frame(spark, [1.0, 2.0, None]).agg(exact_avg("x"))) == 1.5
    assert one(frame(spark, [None]).agg(exact_avg("x"))) is None


def test_sql_rounding_goes_away_from_zero_on_printed_digits(spark):
    df = frame(spark, [2.675, 0.125, -2.675, 1.005])
    rounded = [row[0] for row in df.select(exact_round("x", 2)).collect()]
    assert rounded == [2.68, 0.13, -2.68, 1.01]


def test_zero_divisor_gives_null(spark):
    df = spark.createDataFrame([(1, 0), (3, 8)], "a bigint, b bigint")
    assert [r[0] for r in df.select(ratio("a * 100D", "b", 2)).collect()] == [None, 37.5]


def test_binary_rounding_matches_python(spark):
    rng = random.Random(7)
    values = [2.675, 0.125, 0.375, 60.15, 60.25, 60.35, 60.45, 1.005, -2.675, -0.125, 0.0]
    values += [rng.randrange(10**7) / 1000 for _ in range(3000)]
    values += [rng.randrange(10**6) / 8 for _ in range(500)]
    values += [rng.uniform(-1e9, 1e9) for _ in range(2000)]
    df = frame(spark, values)
    for digits in (1, 2, 4):
        got = df.select("x", binary_round("x", digits), fixed_text("x", digits)).collect()
        wrong = [
            (x, r, t)
            for x, r, t in got
            if r != round(x, digits)
            or float(t) != float(f"{x:.{digits}f}")
            or len(t.rsplit(".", 1)[1]) != digits
        ]
        assert wrong == []


def test_micros(spark):
    df = spark.createDataFrame([(12_345_678,), (None,)], "m bigint")
    assert [r[0] for r in df.select(micros_to_currency("m")).collect()] == [12.345678, None]
