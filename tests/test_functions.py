import datetime as dt
from decimal import Decimal
from fractions import Fraction

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from boxoffice.functions import dates, keys, money, text
from conftest import rows_of


def one(spark, *columns):
    return tuple(spark.range(1).select(*columns).first())


def test_text(spark):
    raw = F.lit("  tIcKeT hub ")
    assert one(spark, text.title_case(raw), text.upper_code(raw), text.lower_code(raw)) == (
        "Ticket Hub",
        "TICKET HUB",
        "ticket hub",
    )
    assert one(spark, text.title_case(F.lit("ab-cd"))) == ("Ab-cd",)


@pytest.mark.parametrize(
    ("value", "rate", "usd"),
    [
        ("10.005", None, 10.01),
        ("10.00", 1.09, 10.9),
        ("-10.005", None, -10.01),
        ("0.50", 0.01, 0.01),
        ("39742.47", 0.00075, 29.81),
        (None, 1.09, None),
    ],
)
def test_to_usd_rounds_half_away_from_zero(spark, value, rate, usd):
    assert one(spark, money.to_usd(F.lit(value).cast("decimal(20,4)"), F.lit(rate).cast("double"))) == (usd,)


def test_cents_round_trip(spark):
    amounts = spark.range(0, 200_000).select((F.col("id").cast("double") / 100).alias("usd"), "id")
    assert amounts.where(money.cents(F.col("usd")) != F.col("id")).count() == 0


def exact(numerator, divisor, factor):
    quotient = Fraction(numerator * factor, divisor)
    size = int(abs(quotient) + Fraction(1, 2))
    return -size if quotient < 0 else size


def test_half_away_agrees_with_fractions(spark):
    pairs = [(n, d, exact(n, d, 100)) for n in range(-25, 26) for d in (-8, -3, 1, 2, 3, 7, 8, 16)]
    df = spark.createDataFrame(pairs, "n bigint, d bigint, expected bigint")
    assert df.where(~money.half_away(F.col("n"), F.col("d"), 100).eqNullSafe(F.col("expected"))).count() == 0


@settings(max_examples=10, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 10**14), st.integers(1, 10**12)), min_size=1, max_size=20))
def test_half_away_on_large_amounts(spark, pairs):
    df = spark.createDataFrame([(n, d, exact(n, d, 100)) for n, d in pairs], "n bigint, d bigint, expected bigint")
    assert df.where(~money.half_away(F.col("n"), F.col("d"), 100).eqNullSafe(F.col("expected"))).count() == 0


def test_share_of_amounts_beyond_bigint(spark):
    """Numerator times factor exceeds 64 bits; the decimal step holds it."""
    n, d = 9 * 10**17, 10**18
    assert one(spark, money.percent(F.lit(n), F.lit(d), 4)) == (90.0,)


def test_division_by_zero_and_null(spark):
    assert one(
        spark,
        money.percent(F.lit(1), F.lit(0)),
        money.percent(F.lit(None).cast("bigint"), F.lit(3)),
        money.percent_label(F.lit(1), F.lit(0)),
        money.percent_label(F.lit(1), F.lit(3)),
        money.percent_label(F.lit(2), F.lit(2)),
    ) == (None, None, None, "33.3", "100.0")


def test_average_midpoint(spark):
    assert one(spark, money.average_cents(F.lit(7948493), F.lit(2))) == (39742.47,)


def test_surrogate_key(spark):
    first = keys.surrogate_key(F.lit(dt.date(2024, 1, 2)), F.lit("a"), F.lit(None).cast("string"))
    assert one(spark, first, F.md5(F.lit("2024-01-02-a-_null_"))) == (one(spark, first)[0],) * 2


def test_dates(spark):
    moment = dates.as_instant("2024-01-04T12:00:00")
    result = one(
        spark,
        dates.year_month(F.lit(dt.date(2024, 3, 9))),
        dates.days_between(F.lit(dt.date(2024, 3, 1)), F.lit(dt.date(2024, 2, 28))),
        F.date_format(dates.lookback_start(moment), "yyyy-MM-dd HH:mm"),
    )
    assert result == ("2024-03", 2, "2024-01-01 12:00")


def test_strict_and_lenient_cast(spark):
    from boxoffice.operators.conform import conform
    from pyspark.sql.types import LongType, StructField, StructType

    schema = StructType([StructField("n", LongType(), False, {"comment": "count"})])
    df = spark.createDataFrame([("1",), ("x",)], "n string")
    assert rows_of(conform(df, schema, lenient=True)) == [(1,), (None,)]
    assert conform(df, schema).schema["n"].metadata == {"comment": "count"}
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        conform(df, schema).collect()


def test_money_type_is_exact(spark):
    assert one(spark, F.lit("0.1").cast(money.MONEY)) == (Decimal("0.10"),)
