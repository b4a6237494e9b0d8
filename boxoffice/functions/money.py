"""Exact money and rates.

Sums run on whole cents (bigint, so they stay in generated code and combine before the
shuffle); averages and percentages divide whole numbers and round half away from zero. Doubles
appear only as the final ``cents / 100``, so the result does not depend on the order of rows.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

# Fixed value: raw money as declared, nine decimals.
MONEY = DecimalType(38, 9)
RATE = DecimalType(12, 8)
# A product of this and a rate has 37 digits, so Spark keeps all its decimals.
_EXACT = "DECIMAL(24,9)"
WHOLE = DecimalType(19, 0)


def to_usd(face_value: Column, rate: Column) -> Column:
    """Face value in dollars, rounded once, to the cent; a missing rate counts as 1.

    Up to 10^15 the product is exact before it is rounded; beyond that Spark keeps six decimals of it.
    """
    known_rate = F.coalesce(rate.cast(RATE), F.lit(1).cast(RATE))
    money = face_value.cast(MONEY)
    exact = F.round(money.try_cast(_EXACT) * known_rate, 2).cast("double")
    return F.coalesce(exact, F.round(money * known_rate, 2).cast("double"))


def cents(amount: Column) -> Column:
    """Whole cents of an amount that is already rounded to the cent."""
    return F.rint(amount * 100).cast("bigint")


def dollars(amount_in_cents: Column) -> Column:
    return amount_in_cents.cast("double") / 100


def half_away(numerator: Column, divisor: Column, factor: int = 1) -> Column:
    """``numerator * factor / divisor`` as a bigint, half away from zero; NULL for divisor 0."""
    twice = numerator.cast(WHOLE) * F.lit(2 * factor).cast(DecimalType(9, 0))
    size = F.abs(divisor.cast(WHOLE))
    magnitude = F.call_function("div", F.abs(twice) + size, F.nullif(size * F.lit(2), F.lit(0)))
    negative = (numerator < 0) != (divisor < 0)
    return F.when(negative, -magnitude).otherwise(magnitude)


def average_cents(total_cents: Column, count: Column) -> Column:
    return dollars(half_away(total_cents, count))


def percent(part: Column, whole: Column, places: int = 2) -> Column:
    """``part / whole`` in percent with ``places`` decimals; NULL for whole 0."""
    scale = 10**places
    return half_away(part, whole, 100 * scale).cast("double") / scale


def percent_label(part: Column, whole: Column) -> Column:
    """The percentage as text, always one decimal; NULL stays NULL."""
    value = percent(part, whole, 1)
    return F.when(value.isNotNull(), F.format_string("%.1f", value))
