"""Measures of ticket rows, for any grain."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from boxoffice.functions.money import cents

# Life-cycle states of a ticket.
BOOKED, CANCELLED, REFUNDED = "booked", "cancelled", "refunded"
STATUSES = (BOOKED, CANCELLED, REFUNDED)

_USD_CENTS = "face_value_usd"


def in_status(status: str) -> Column:
    return F.col("ticket_status") == status


def count_status(status: str) -> Column:
    return F.count_if(in_status(status))


def usd_cents_where(condition: Column) -> Column:
    """Cents of the rows that meet the condition; other rows add 0, unknown values add nothing.

    A group whose only such rows have no value therefore sums to NULL, not to 0.
    """
    return F.sum(F.when(condition, cents(F.col(_USD_CENTS))).otherwise(F.lit(0).cast("bigint")))


def usd_cents(status: str) -> Column:
    return usd_cents_where(in_status(status))


def valued(status: str) -> Column:
    """Rows of a status that have a value: the divisor of its average."""
    return F.count_if(in_status(status) & F.col(_USD_CENTS).isNotNull())
