from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from waybill.functions import columns as C


def one(spark, value, kind, expression):
    df = spark.createDataFrame([(value,)], f"x {kind}")
    return df.select(expression(F.col("x"))).first()[0]


@pytest.mark.parametrize(
    "raw, clean",
    [
        ("8 (9) 1", "+791"),
        ("9161234567", "+9161234567"),
        ("+7 916 123-45-67", "+79161234567"),
        ("88", "+78"),
        ("8", "+7"),
        ("n/a", None),
        ("", None),
        (None, None),
        ("٨٩ 1", "+٨٩1"),  # digits of other scripts are digits, but no leading 8
    ],
)
def test_phone(spark, raw, clean):
    assert one(spark, raw, "string", C.phone_col) == clean


@pytest.mark.parametrize(
    "text, first, second",
    [
        ("A , B, C", "A", "B"),
        ("A", None, None),
        ("A,", "A", ""),
        (",B", "", "B"),
        ("\tA ,　B\x1c,C", "A", "B"),
        ("", None, None),
        (None, None, None),
    ],
)
def test_comma_part(spark, text, first, second):
    assert one(spark, text, "string", lambda c: C.comma_part(c, 1)) == first
    assert one(spark, text, "string", lambda c: C.comma_part(c, 2)) == second


def test_whitespace_is_what_python_strips():
    assert all(f"{w}x{w}".strip() == "x" for w in C.WHITESPACE)
    assert len(C.WHITESPACE) == sum(chr(i).isspace() for i in range(0x110000))


@pytest.mark.parametrize("value, whole", [(2.0, 2), (-3.0, -3), (None, None), (float("nan"), None)])
def test_to_int(spark, value, whole):
    def cast(c):
        return C.to_int(c, T.DoubleType(), T.LongType())

    assert one(spark, value, "double", cast) == whole


def test_to_int_fails_on_fractions_unless_told_otherwise(spark):
    def cast(strict):
        return lambda c: C.to_int(c, T.DoubleType(), T.IntegerType(), strict)

    with pytest.raises(Exception, match="not a whole number: 1.5"):
        one(spark, 1.5, "double", cast(True))
    assert one(spark, 1.5, "double", cast(False)) == 1


@pytest.mark.parametrize(
    "above, below, rounded",
    [
        (1005, 1000, "1.01"),  # a tie that binary doubles would round down
        (-1005, 1000, "-1.01"),
        (1, 3, "0.33"),
        (2, 3, "0.67"),
        (0, 5, "0.00"),
        (5, 0, None),
        (10**15 + 5, 10**3, "1000000000000.01"),
        (4999999, 10**9, "0.00"),  # just below a tie
        (5000000, 10**9, "0.01"),
        (-1, 3, "-0.33"),
    ],
)
def test_ratio(spark, above, below, rounded):
    df = spark.createDataFrame([(above, below)], "a bigint, b bigint")
    found = df.select(C.ratio(F.col("a"), F.col("b"))).first()[0]
    assert found == (None if rounded is None else Decimal(rounded))


@pytest.mark.parametrize(
    "above, below, exact",
    [
        (10**16 - 1, 8, "1249999999999999.88"),  # a tie: ....875
        (10**16 + 4, 8, "1250000000000000.50"),
        (-(10**18), 3, "-333333333333333333.33"),
        (10**25, 7, "1428571428571428571428571.43"),
    ],
)
def test_large_ratios_are_exact(spark, above, below, exact):
    df = spark.createDataFrame([(str(above), below)], "a string, b bigint")
    found = df.select(C.ratio(F.col("a").cast("decimal(38, 0)"), F.col("b"))).first()[0]
    assert found == Decimal(exact)


def test_amounts_do_not_overflow_and_keep_the_discount_of_canceled_lines(spark):
    df = spark.createDataFrame(
        [(30_000, 2_000_000, 0, None), (3, 10, 3, 4), (2, 5, None, 1)],
        "item_quantity int, item_price int, item_canceled_quantity int, item_discount int",
    )
    found = df.select(C.line_turnover(), C.line_revenue()).collect()
    assert [tuple(r) for r in found] == [(6 * 10**10, 6 * 10**10), (26, -4), (9, 9)]


def test_order_city_prefers_an_empty_city_to_none(spark):
    df = spark.createDataFrame(
        [("A", "B"), (None, "B"), (None, None), ("", "B")], "d string, s string"
    )
    found = [r[0] for r in df.select(C.order_city(F.col("d"), F.col("s"))).collect()]
    assert found == ["A", "B", "UNKNOWN", ""]
