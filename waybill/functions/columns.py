"""Column expressions: text clean-up, integer casts, amounts, ratios.

Built-in functions only, so all of them stay inside whole-stage codegen.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Everything Unicode counts as white space; Spark's own trim knows only the blank.
WHITESPACE = "".join(chr(code) for code in range(0x3001) if chr(code).isspace())

# Cancellation reasons that are the service's own fault.
SERVICE_ERRORS = ("Ошибка приложения", "Проблемы с оплатой")
# Fixed value: city of an order that has none.
NO_CITY = "UNKNOWN"


def phone_col(raw: Column) -> Column:
    """Digits of a phone with a leading plus; a leading 8 becomes 7; no digits -> null."""
    digits = F.nullif(F.regexp_replace(raw, r"\P{Nd}", ""), F.lit(""))
    return F.concat(F.lit("+"), F.regexp_replace(digits, "^8", "7"))


def comma_part(text: Column, number: int) -> Column:
    """Stripped part of a comma-separated text (from 1); null when there is no comma.

    A part that exists but is empty stays an empty string.
    """
    part = F.split_part(text, F.lit(","), F.lit(number))
    return F.when(F.contains(text, F.lit(",")), F.btrim(part, F.lit(WHITESPACE)))


def to_int(value: Column, have: T.DataType, want: T.DataType, strict: bool = True) -> Column:
    """Cast to a nullable integer type; NaN becomes null.

    Spark truncates fractions silently; in strict mode they fail the job instead.
    """
    if isinstance(have, (T.FloatType, T.DoubleType)):
        value = F.when(~F.isnan(value), value)
    if strict and isinstance(have, (T.FloatType, T.DoubleType, T.DecimalType)):
        message = F.concat(F.lit("not a whole number: "), value.cast("string"))
        value = F.when(value.isNull() | (value == F.floor(value)), value).otherwise(
            F.raise_error(message)
        )
    return value.cast(want)


def whole_number_text(value: Column, strict: bool = True) -> Column:
    """A phone that a file stores as a double, as text: its digits in full and one
    decimal, never with an exponent. NaN becomes null; fractions fail in strict mode."""
    value = F.when(~F.isnan(value), value.cast("double"))
    text = value.cast("decimal(38, 1)").cast("string")
    if not strict:
        return text
    message = F.concat(F.lit("not a whole number: "), value.cast("string"))
    return F.when(value.isNull() | (value == F.floor(value)), text).otherwise(F.raise_error(message))


def unfit(value: Column, have: T.DataType, want: T.DataType) -> Column | None:
    """Whether a strict cast of ``value`` fails: it has a fraction, or is too large for the type.
    None if it can't fail. NaN is a missing value, which never does."""
    given, wrong = value.isNotNull(), F.lit(False)
    if isinstance(have, (T.FloatType, T.DoubleType)):
        given = given & ~F.isnan(value)
    if isinstance(have, (T.FloatType, T.DoubleType, T.DecimalType)):
        wrong = F.floor(value) != value
    elif have == want or not isinstance(have, T.IntegralType):
        return None
    if isinstance(want, T.IntegralType):
        wrong = wrong | value.try_cast(want).isNull()
    return given & wrong


def order_city(delivery_city: Column, store_city: Column) -> Column:
    return F.coalesce(delivery_city, store_city, F.lit(NO_CITY))


def is_service_error(reason: Column) -> Column:
    return reason.isin(*SERVICE_ERRORS)


def date_parts(moment: Column) -> list[Column]:
    return [
        F.year(moment).alias("year_num"),
        F.month(moment).alias("month_num"),
        F.dayofmonth(moment).alias("day_num"),
    ]


def line_turnover() -> Column:
    """Ordered amount of an order line. 64-bit, as quantity x price may pass an INT."""
    quantity = F.col("item_quantity").cast("long")
    return quantity * F.col("item_price") - F.coalesce("item_discount", F.lit(0))


def line_revenue() -> Column:
    """Amount kept after cancellations; the discount is subtracted in full."""
    canceled = F.coalesce("item_canceled_quantity", F.lit(0))
    kept = F.col("item_quantity").cast("long") - canceled
    return kept * F.col("item_price") - F.coalesce("item_discount", F.lit(0))


def ratio(numerator: Column, denominator: Column) -> Column:
    """Quotient rounded half away from zero to two places, as DECIMAL(38, 2); null for a
    zero denominator.

    Worked out in whole hundredths, as doubles would misplace exact ties: in 64 bits
    where the numbers allow it, which is nearly always, else in wide decimals.
    """
    size, below = F.abs(numerator), F.nullif(denominator, F.lit(0))
    short = size.cast("long") * 200 + below
    long = size.cast("decimal(34, 0)") * 200 + below
    twice = below.cast("decimal(20, 0)") * 2
    whole = "decimal(35, 0)"
    hundredths = F.when(
        (size < 10**16) & (below < 10**16), F.call_function("div", short, below * 2).cast(whole)
    ).otherwise(
        # Without its remainder the decimal divides exactly; "div" on decimals
        # would wrap around silently beyond 64 bits.
        ((long - long % twice) / twice).cast(whole)
    )
    signed = F.when(numerator < 0, -hundredths).otherwise(hundredths)
    return (signed * F.lit(Decimal("0.01"))).cast("decimal(38, 2)")
