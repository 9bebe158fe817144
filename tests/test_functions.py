import math

import duckdb
import pytest

from overlake.functions import format_overs, overs_decimal, ratio, round_half_up, to_int


def value(spark, col):
    return spark.range(1).select(col.alias("v")).first().v


@pytest.mark.parametrize(
    "text, expected",
    [("12", 12), ("12.7", 12), ("-3.9", -3), ('"12"', 12), ('"12.7"', None), ('"x"', None), (None, None),
     ("99999999999", None), ('""', None), ("null", None), ("[1]", None), ("true", 1)],
)
def test_to_int(spark, text, expected):
    assert value(spark, to_int("cast(NULL AS variant)" if text is None else f"parse_json('{text}')")) == expected


def test_rounding_equals_floating_point_round(spark):
    pairs = [(n, d) for n in range(0, 400, 3) for d in range(1, 130)]
    df = spark.createDataFrame(pairs, "n int, d int")
    ours = {(r.n, r.d): (r.a, r.b) for r in df.select(
        "n", "d", ratio("n", "d", 2, times=100).alias("a"), ratio("n", "d", 1).alias("b")).collect()}
    theirs = duckdb.sql(
        """select n::int, d::int, round(n * 100.0 / d, 2), round(n::double / d, 1)
           from range(0, 400, 3) a(n), range(1, 130) b(d)"""
    ).fetchall()
    assert len(theirs) == len(ours)
    assert all(ours[(n, d)] == (a, b) for n, d, a, b in theirs)


def test_ratio_by_zero_and_null_is_null(spark):
    assert value(spark, ratio("5", "0")) is None
    assert value(spark, ratio("5", "cast(NULL AS int)")) is None
    assert value(spark, ratio("1", "3", None)) == 1 / 3


def test_order_of_factors(spark):
    assert value(spark, ratio("7", "3", None, then_times=6)) == 7 / 3 * 6
    assert value(spark, ratio("7", "3", None, times=6)) == 7 * 6 / 3


@pytest.mark.parametrize("balls, text, number", [(0, "0.0", 0.0), (25, "4.1", 4.1), (24, "4.0", 4.0), (5, "0.5", 0.5)])
def test_overs(spark, balls, text, number):
    assert value(spark, format_overs(str(balls))) == text
    assert math.isclose(value(spark, overs_decimal(str(balls), "6")), number)


def test_overs_without_length(spark):
    assert value(spark, overs_decimal("5", "0")) is None
    assert value(spark, round_half_up("2.5D", 0)) == 3.0
