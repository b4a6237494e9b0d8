"""Declared tables: raw schemas with null modes, keys, physical layout and ownership."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql.types import (
    BooleanType,
    DataType,
    DateType,
    DoubleType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

from boxoffice.functions.money import MONEY

TEXT, WHOLE, DAY, INSTANT, FLAG = StringType(), LongType(), DateType(), TimestampType(), BooleanType()


def _field(name: str, kind: DataType, note: str, required: bool = False, pii: bool = False) -> StructField:
    return StructField(name, kind, not required, {"comment": note, "pii": pii})


# A last column that raw tables may carry beside the declared ones: the value by which a source dealt its rows to
# tasks. The key of a record determines it, so all versions of a record lie together.
DEALT_BY = "dealt_by"

# The declared raw tables.
RAW: dict[str, StructType] = {
    "tickets": StructType(
        [
            _field("ticket_id", TEXT, "ticket sold", required=True),
            _field("event_id", TEXT, "event the ticket admits to", required=True),
            _field("customer_id", TEXT, "buyer", required=True),
            _field("ticket_type", TEXT, "kind of ticket"),
            _field("face_value", MONEY, "price in the currency of the sale"),
            _field("currency", TEXT, "three-letter currency code"),
            _field("purchase_timestamp", INSTANT, "when it was bought", required=True),
            _field("ticket_status", TEXT, "booked, cancelled or refunded", required=True),
            _field("discount_code", TEXT, "promotion used, if any"),
            _field("platform_source", TEXT, "name of the selling platform"),
            _field("channel_id", TEXT, "sales channel", required=True),
            _field("ingested_at", INSTANT, "when this version arrived", required=True),
        ]
    ),
    "events": StructType(
        [
            _field("event_id", TEXT, "event", required=True),
            _field("event_name", TEXT, "title"),
            _field("event_category", TEXT, "kind of event"),
            _field("venue_name", TEXT, "venue"),
            _field("venue_city", TEXT, "city of the venue"),
            _field("venue_country", TEXT, "country of the venue"),
            _field("event_date", DAY, "scheduled day"),
            _field("event_capacity", WHOLE, "seats"),
            _field("platform_source", TEXT, "platform that reported the event"),
            _field("ingested_at", INSTANT, "when this version arrived", required=True),
        ]
    ),
    "customers": StructType(
        [
            _field("customer_id", TEXT, "customer", required=True),
            _field("first_name", TEXT, "given name", pii=True),
            _field("last_name", TEXT, "family name", pii=True),
            _field("email", TEXT, "mail address", pii=True),
            _field("phone", TEXT, "telephone number", pii=True),
            _field("country_of_residence", TEXT, "country"),
            _field("signup_date", DAY, "first registration"),
            _field("loyalty_tier", TEXT, "loyalty level"),
            _field("platform_source", TEXT, "platform of registration"),
            _field("ingested_at", INSTANT, "when this version arrived", required=True),
        ]
    ),
    "channels": StructType(
        [
            _field("channel_id", TEXT, "sales channel", required=True),
            _field("channel_name", TEXT, "display name", required=True),
            _field("channel_type", TEXT, "direct, partner or vendor", required=True),
            _field("channel_description", TEXT, "free text"),
            _field("platform_id", TEXT, "platform that owns the channel", required=True),
            _field("is_active", FLAG, "open for sales"),
            _field("launch_date", DAY, "first day of sales"),
            _field("ingested_at", INSTANT, "when this version arrived", required=True),
        ]
    ),
    "platforms": StructType(
        [
            _field("platform_id", TEXT, "platform", required=True),
            _field("platform_name", TEXT, "display name", required=True),
            _field("platform_region", TEXT, "home region"),
            _field("launch_date", DAY, "first day of operation"),
            _field("is_active", FLAG, "in operation"),
        ]
    ),
}

# The declared seed.
SEED = StructType(
    [
        _field("from_currency", TEXT, "currency converted from"),
        _field("to_currency", TEXT, "currency converted to"),
        _field("rate", DoubleType(), "units of to_currency for one of from_currency"),
        _field("effective_date", DAY, "first day the rate holds"),
    ]
)


@dataclass(frozen=True)
class Table:
    """How a built table is keyed, laid out and owned."""

    name: str
    layer: str
    keys: tuple[str, ...]
    incremental: bool = False
    partition_by: str | None = None
    cluster_by: tuple[str, ...] = ()
    pii: bool = False
    owner: str | None = None
    team: str | None = None


# Keys and layout of the built tables. Owner and team are the caller's to give.
TABLES: dict[str, Table] = {
    t.name: t
    for t in (
        Table("events", "silver", ("event_id",), True, cluster_by=("venue_country", "event_date")),
        Table(
            "customers", "silver", ("customer_id",), True, cluster_by=("country_of_residence", "loyalty_tier"), pii=True
        ),
        Table(
            "tickets",
            "silver",
            ("ticket_id",),
            True,
            partition_by="purchase_date",
            cluster_by=("ticket_status", "platform_source"),
        ),
        Table("platforms", "silver", ("platform_id",)),
        Table("channels", "silver", ("channel_id",), True),
        Table(
            "ticket_sales_daily",
            "gold",
            ("daily_sales_key",),
            partition_by="sale_date",
            cluster_by=("platform_region", "channel_type"),
        ),
        Table("event_performance", "gold", ("event_id",), cluster_by=("event_category", "venue_country")),
        Table(
            "customer_behaviour", "gold", ("customer_id",), cluster_by=("loyalty_tier", "country_of_residence"), pii=True
        ),
        Table("regional_summary", "gold", ("platform_region", "year_month"), cluster_by=("platform_region",)),
        Table("channel_performance", "gold", ("channel_id", "year_month"), cluster_by=("channel_type",)),
    )
}


def pii_columns(df: DataFrame) -> list[str]:
    """Columns marked as personal data; the mark travels with the column through projections."""
    return [field.name for field in df.schema.fields if field.metadata.get("pii")]
