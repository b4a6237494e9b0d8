"""Silver tables: the newest version of every record, cleaned and typed.

Three steps for each table: ``shape_*`` cleans every version, ``newest`` keeps one per key and
``is_published`` tells whether that one belongs in the table. The newest version is chosen
before the filter, so a bad one hides an older good one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from boxoffice.functions.dates import days_between
from boxoffice.functions.money import MONEY, RATE, to_usd
from boxoffice.functions.text import lower_code, title_case, upper_code
from boxoffice.operators.dedup import any_per_key, latest_per_key
from boxoffice.schemas import DEALT_BY, TABLES
from boxoffice.tables import Tables

HOME_CURRENCY = "USD"
ARRIVED = "ingested_at"
LOADED_AT = "_loaded_at"


def shape_events(raw: DataFrame) -> DataFrame:
    return raw.select(
        "event_id",
        title_case(F.col("event_name")).alias("event_name"),
        title_case(F.col("event_category")).alias("event_category"),
        title_case(F.col("venue_name")).alias("venue_name"),
        title_case(F.col("venue_city")).alias("venue_city"),
        upper_code(F.col("venue_country")).alias("venue_country"),
        F.col("event_date").cast("date").alias("event_date"),
        F.col("event_capacity").cast("bigint").alias("event_capacity"),
        upper_code(F.col("platform_source")).alias("platform_source"),
        ARRIVED,
    )


def shape_customers(raw: DataFrame) -> DataFrame:
    """Personal data passes unchanged and keeps its mark in the column metadata."""
    return raw.select(
        "customer_id",
        "first_name",
        "last_name",
        "email",
        "phone",
        upper_code(F.col("country_of_residence")).alias("country_of_residence"),
        F.col("signup_date").cast("date").alias("signup_date"),
        upper_code(F.col("loyalty_tier")).alias("loyalty_tier"),
        upper_code(F.col("platform_source")).alias("platform_source"),
        ARRIVED,
    )


def shape_platforms(raw: DataFrame) -> DataFrame:
    return raw.select(
        "platform_id",
        title_case(F.col("platform_name")).alias("platform_name"),
        upper_code(F.col("platform_region")).alias("platform_region"),
        F.col("launch_date").cast("date").alias("launch_date"),
        F.col("is_active").cast("boolean").alias("is_active"),
    )


def shape_channels(raw: DataFrame, as_of: Column) -> DataFrame:
    """The age counts up to ``as_of``."""
    launched = F.col("launch_date").cast("date")
    return raw.select(
        "channel_id",
        title_case(F.col("channel_name")).alias("channel_name"),
        upper_code(F.col("channel_type")).alias("channel_type"),
        F.trim("channel_description").alias("channel_description"),
        "platform_id",
        F.col("is_active").cast("boolean").alias("is_active"),
        launched.alias("launch_date"),
        days_between(as_of, launched).alias("channel_age_days"),
        ARRIVED,
    )


def current_rates(seed: DataFrame) -> DataFrame:
    """The latest dollar rate of every currency: one row each, so the join cannot repeat tickets."""
    dollar_rates = seed.where(F.col("to_currency") == HOME_CURRENCY)
    return latest_per_key(dollar_rates, ["from_currency"], "effective_date").select(
        F.col("from_currency"), F.col("rate").cast(RATE).alias("rate")
    )


def with_usd(tickets: DataFrame, rates: DataFrame) -> DataFrame:
    """Adds ``face_value_usd`` and whether its rate was unknown (then 1.0 is used).

    The rates are as small as the seed that holds them, which Spark sees; it broadcasts them.
    """
    priced = tickets.withColumn("currency", upper_code(F.col("currency"))).join(
        rates, F.col("currency") == F.col("from_currency"), "left"
    )
    return priced.select(
        *tickets.columns,
        to_usd(F.col("face_value"), F.col("rate")).alias("face_value_usd"),
        F.col("rate").isNull().alias("is_rate_missing"),
    )


def shape_tickets(raw: DataFrame, rates: DataFrame) -> DataFrame:
    return with_usd(raw, rates).select(
        "ticket_id",
        "event_id",
        "customer_id",
        "channel_id",
        upper_code(F.col("ticket_type")).alias("ticket_type"),
        F.col("face_value").cast(MONEY).alias("face_value"),
        "currency",
        "face_value_usd",
        F.col("purchase_timestamp").cast("timestamp").alias("purchase_timestamp"),
        F.to_date("purchase_timestamp").alias("purchase_date"),
        lower_code(F.col("ticket_status")).alias("ticket_status"),
        "discount_code",
        upper_code(F.col("platform_source")).alias("platform_source"),
        ARRIVED,
        "is_rate_missing",
        *[name for name in raw.columns if name == DEALT_BY],
    )


def newest(shaped: DataFrame, name: str) -> DataFrame:
    """One version per key; a record without a key can never be published, so it goes first."""
    keys = list(TABLES[name].keys)
    keyed = shaped.dropna(subset=keys)
    if ARRIVED not in shaped.columns:
        return any_per_key(keyed, keys)
    within = [name for name in shaped.columns if name == DEALT_BY]
    return latest_per_key(keyed, keys, ARRIVED, audit=LOADED_AT, within=within).drop(DEALT_BY)


def is_published(name: str) -> Column:
    """Whether a newest version belongs in the table; never NULL."""
    if name == "events":
        return F.col("event_date").isNotNull()
    if name == "tickets":
        return F.col("event_id").isNotNull() & F.col("customer_id").isNotNull()
    if name == "channels":
        return F.coalesce(F.col("is_active"), F.lit(False))
    return F.lit(True)


def table_of(shaped: DataFrame, name: str) -> DataFrame:
    return newest(shaped, name).where(is_published(name))


def build_silver(raw: Tables, seed: DataFrame, as_of: Column) -> Tables:
    return Tables(
        {
            "tickets": lambda: table_of(shape_tickets(raw.tickets, current_rates(seed)), "tickets"),
            "events": lambda: table_of(shape_events(raw.events), "events"),
            "customers": lambda: table_of(shape_customers(raw.customers), "customers"),
            "channels": lambda: table_of(shape_channels(raw.channels, as_of), "channels"),
            "platforms": lambda: table_of(shape_platforms(raw.platforms), "platforms"),
        }
    )
