"""Gold tables: reports at a stated grain.

Tickets are aggregated to a grain of plain ids before anything is joined that the aggregate does
not need, so descriptions are attached to report rows, not to tickets. Only what decides whether
a ticket counts, or in which group, is looked up per ticket.

Reports with distinct counts first roll the measures up to the ids that are counted. All figures
come from those rows, so tickets are read once and never copied for a distinct count.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from boxoffice.functions.dates import days_between, year_month
from boxoffice.functions.keys import surrogate_key
from boxoffice.functions.money import average_cents, dollars, percent, percent_label
from boxoffice.functions.text import upper_code
from boxoffice.operators.joins import attach, dimension, lookup
from boxoffice.operators.kpi import BOOKED, CANCELLED, REFUNDED, count_status, in_status, usd_cents, valued
from boxoffice.operators.ranking import top_k_per_group
from boxoffice.operators.share import share_of_total
from boxoffice.tables import Tables

# Channel types reported side by side.
SPLIT_TYPES = ("DIRECT", "PARTNER", "VENDOR")

MONTH = "year_month"
REGION_MONTH = ["platform_region", MONTH]


def _of_known_events(tickets: DataFrame, silver: Tables) -> DataFrame:
    """Tickets whose event exists; no event column is needed, so this is an existence test."""
    return lookup(tickets, dimension(silver.events.select("event_id")), "event_id", "left_semi")


def _platform_names(silver: Tables, *columns: str) -> DataFrame:
    """Platforms by the name tickets carry, compared in one case."""
    return silver.platforms.select(upper_code(F.col("platform_name")).alias("platform_source"), *columns)


def _or_zero(value: Column, matched: Column) -> Column:
    """0 for a row without any ticket; a NULL that tickets sum to stays."""
    return F.when(matched.isNull(), F.lit(0).cast("bigint")).otherwise(value)


_MEASURES = ("total", "booked", "cancelled", "refunded", "priced", "booked_cents")


def rolled_up(tickets: DataFrame, *grain: Column | str) -> DataFrame:
    """Measures of tickets, and their last day of sale where it is known, at a grain of ids."""
    last = [F.max("purchase_date").alias("last_purchase_date")] if "purchase_date" in tickets.columns else []
    return tickets.groupBy(*grain).agg(
        F.count("*").alias("total"),
        count_status(BOOKED).alias("booked"),
        count_status(CANCELLED).alias("cancelled"),
        count_status(REFUNDED).alias("refunded"),
        valued(BOOKED).alias("priced"),
        usd_cents(BOOKED).alias("booked_cents"),
        *last,
    )


def _summed(*names: str) -> list[Column]:
    """Measures of a coarser grain from those of a finer one."""
    return [F.sum(name).alias(name) for name in names or _MEASURES]


def _first(counted: str, *group: str, by: str) -> Column:
    """1 on one row of each ``counted`` id of a group, 0 on its other rows, which differ in ``by``.

    Its sum is the distinct count, without a copy of the rows for every id that is counted.
    """
    first = F.row_number().over(Window.partitionBy(*group, counted).orderBy(by)) == 1
    return (first & F.col(counted).isNotNull()).cast("bigint")


def ticket_sales_daily(silver: Tables) -> DataFrame:
    """Event x day x platform x channel. Closed channels share one row with no channel."""
    return daily_report(daily_rows(silver))


def daily_rows(silver: Tables) -> DataFrame:
    """What a row of the daily table is made of."""
    channels = dimension(silver.channels.select("channel_id", "channel_name", "channel_type"))
    sold = silver.tickets.select(
        F.col("purchase_date").alias("sale_date"),
        "event_id",
        "platform_source",
        F.col("channel_id").alias("sold_through"),
        "customer_id",
        "ticket_status",
        "face_value_usd",
    )
    sold = lookup(sold, channels.select("channel_id"), "sold_through", "left", table_key="channel_id")
    measured = sold.groupBy("sale_date", "event_id", "platform_source", "channel_id").agg(
        count_status(BOOKED).alias("tickets_sold"),
        count_status(CANCELLED).alias("tickets_cancelled"),
        count_status(REFUNDED).alias("tickets_refunded"),
        F.count("*").alias("total_ticket_events"),
        usd_cents(BOOKED).alias("booked_cents"),
        usd_cents(REFUNDED).alias("refunded_cents"),
        F.count_distinct("customer_id").alias("unique_customers"),
    )
    events = silver.events.select("event_id", "event_name", "event_category", "venue_country")
    platforms = _platform_names(silver, "platform_id", "platform_name", "platform_region")
    placed = measured.join(events, "event_id").join(platforms, "platform_source")
    return attach(placed, channels, "channel_id", "left")


def daily_report(rows: DataFrame) -> DataFrame:
    """The daily table from its rows, each on its own: its key is wide, so it is made behind the last shuffle."""
    return rows.select(
        "sale_date",
        "event_id",
        "event_name",
        "event_category",
        "venue_country",
        "platform_id",
        "platform_name",
        "platform_region",
        "channel_id",
        "channel_name",
        "channel_type",
        surrogate_key(
            F.col("sale_date"), F.col("event_id"), F.col("platform_id"), F.col("venue_country"), F.col("channel_id")
        ).alias("daily_sales_key"),
        "tickets_sold",
        "tickets_cancelled",
        "tickets_refunded",
        "total_ticket_events",
        dollars(F.col("booked_cents")).alias("revenue_usd"),
        dollars(F.col("refunded_cents")).alias("refund_value_usd"),
        # The channel is part of the grain, so its own figures are the row's figures.
        F.col("tickets_sold").alias("tickets_sold_by_channel"),
        dollars(F.col("booked_cents")).alias("revenue_by_channel_usd"),
        "unique_customers",
    )


def event_performance(silver: Tables) -> DataFrame:
    measured = rolled_up(
        silver.tickets.select("event_id", "customer_id", "channel_id", "ticket_status", "face_value_usd"),
        "event_id",
        "customer_id",
        "channel_id",
    )
    counted = measured.withColumn("customers", _first("customer_id", "event_id", by="channel_id"))
    by_channel = counted.groupBy("event_id", "channel_id").agg(*_summed(*_MEASURES, "customers"))
    per_event = by_channel.groupBy("event_id").agg(
        *_summed(*_MEASURES, "customers"), F.count("channel_id").alias("channels")
    )
    joined = silver.events.join(per_event, "event_id", "left")
    matched = F.col("total")
    sold = _or_zero(F.col("booked"), matched)
    return joined.select(
        "event_id",
        "event_name",
        "event_category",
        "venue_name",
        "venue_city",
        "venue_country",
        "event_date",
        "event_capacity",
        "platform_source",
        _or_zero(F.col("total"), matched).alias("total_ticket_events"),
        sold.alias("tickets_sold"),
        _or_zero(F.col("cancelled"), matched).alias("tickets_cancelled"),
        _or_zero(F.col("refunded"), matched).alias("tickets_refunded"),
        dollars(_or_zero(F.col("booked_cents"), matched)).alias("total_revenue_usd"),
        average_cents(F.col("booked_cents"), F.col("priced")).alias("avg_ticket_price_usd"),
        percent(sold, F.col("event_capacity")).alias("sell_through_rate_pct"),
        percent(F.col("cancelled"), F.col("total")).alias("cancellation_rate_pct"),
        percent(F.col("refunded"), F.col("total")).alias("refund_rate_pct"),
        _or_zero(F.col("customers"), matched).alias("unique_customers"),
        _or_zero(F.col("channels"), matched).alias("channel_count"),
    )


def preferred_channel(silver: Tables) -> DataFrame:
    """The active channel through which a customer booked most tickets; ties go to the lowest id."""
    booked = silver.tickets.where(in_status(BOOKED)).groupBy("customer_id", "channel_id").agg(
        F.count("*").alias("booked")
    )
    named = attach(booked, dimension(silver.channels.select("channel_id", "channel_name")), "channel_id", "inner")
    best = top_k_per_group(named, ["customer_id"], [F.desc("booked"), F.asc("channel_id")])
    return best.select("customer_id", F.col("channel_name").alias("preferred_channel"))


def customer_behaviour(silver: Tables, as_of: Column) -> DataFrame:
    measured = rolled_up(
        silver.tickets.select(
            "customer_id", "event_id", "channel_id", "ticket_status", "face_value_usd", "purchase_date"
        ),
        "customer_id",
        "event_id",
        "channel_id",
    )
    # An event counts once for a customer: with the first of its channels.
    counted = measured.withColumn("events", _first("event_id", "customer_id", by="channel_id"))
    by_channel = counted.groupBy("customer_id", "channel_id").agg(
        *_summed(*_MEASURES, "events"), F.max("last_purchase_date").alias("last_purchase_date")
    )
    names = silver.channels.select("channel_id", "channel_name", F.lit(True).alias("active"))
    named = attach(by_channel, dimension(names), "channel_id", "left")
    # Most booked tickets first, then the lowest id; a channel without any does not count.
    preference = F.when(F.col("active") & (F.col("booked") > 0), F.struct(-F.col("booked"), F.col("channel_id")))
    per_customer = named.groupBy("customer_id").agg(
        *_summed(*_MEASURES, "events"),
        F.max("last_purchase_date").alias("last_purchase_date"),
        F.min_by("channel_name", preference).alias("preferred_channel"),
    )
    joined = silver.customers.join(per_customer, "customer_id", "left")
    matched = F.col("total")
    return joined.select(
        "customer_id",
        "first_name",
        "last_name",
        "email",
        "phone",
        "country_of_residence",
        "signup_date",
        "loyalty_tier",
        "platform_source",
        days_between(as_of, F.col("signup_date")).alias("customer_tenure_days"),
        _or_zero(F.col("total"), matched).alias("total_ticket_events"),
        _or_zero(F.col("booked"), matched).alias("total_tickets_purchased"),
        _or_zero(F.col("cancelled"), matched).alias("total_cancellations"),
        _or_zero(F.col("refunded"), matched).alias("total_refunds"),
        dollars(_or_zero(F.col("booked_cents"), matched)).alias("lifetime_spend_usd"),
        average_cents(F.col("booked_cents"), F.col("priced")).alias("avg_spend_per_ticket_usd"),
        "last_purchase_date",
        days_between(as_of, F.col("last_purchase_date")).alias("days_since_last_purchase"),
        _or_zero(F.col("events"), matched).alias("unique_events_attended"),
        "preferred_channel",
    )


def placed_tickets(silver: Tables, *further: str) -> DataFrame:
    """Tickets of known events with their platform's region and the month of sale.

    Spark broadcasts the platforms while their files are small. If it does not, adaptive
    execution splits a large platform, as every aggregate that follows shuffles by other keys.
    """
    sold = silver.tickets.select(
        "event_id",
        "customer_id",
        "channel_id",
        "platform_source",
        "ticket_status",
        "face_value_usd",
        year_month(F.col("purchase_date")).alias(MONTH),
        *further,
    )
    return _of_known_events(sold, silver).join(_platform_names(silver, "platform_region"), "platform_source")


def channel_sales_by_region(silver: Tables, placed: DataFrame | None = None) -> DataFrame:
    """Region x month x channel, with the channel's name and type where it is active."""
    placed = placed_tickets(silver) if placed is None else placed
    sums = placed.groupBy(*REGION_MONTH, F.col("channel_id").alias("sold_through")).agg(
        count_status(BOOKED).alias("booked"),
        count_status(CANCELLED).alias("cancelled"),
        count_status(REFUNDED).alias("refunded"),
        usd_cents(BOOKED).alias("booked_cents"),
    )
    channels = silver.channels.select("channel_id", "channel_name", "channel_type")
    return sums.join(channels, F.col("sold_through") == F.col("channel_id"), "left")


def top_channel(by_channel: DataFrame) -> DataFrame:
    """The channel name with most revenue per region and month; ties go to the lowest name."""
    named = by_channel.where(F.col("channel_name").isNotNull())
    revenue = named.groupBy(*REGION_MONTH, "channel_name").agg(F.sum("booked_cents").alias("revenue_cents"))
    best = top_k_per_group(revenue, REGION_MONTH, [F.desc_nulls_last("revenue_cents"), F.asc("channel_name")])
    return best.select(*REGION_MONTH, F.col("channel_name").alias("top_channel_by_revenue"), "revenue_cents")


def regional_summary(silver: Tables) -> DataFrame:
    """Region x month.

    Revenue, active channels and the top channel come from one chain of ever smaller aggregates;
    the ticket counts and the two distinct counts from rows that hold a customer and event once a group.
    """
    placed = placed_tickets(silver)
    by_channel = channel_sales_by_region(silver, placed)
    zero = F.lit(0).cast("bigint")
    of_type = {
        kind: F.sum(F.when(F.col("channel_type") == kind, F.col("booked_cents")).otherwise(zero))
        for kind in SPLIT_TYPES
    }
    by_name = by_channel.groupBy(*REGION_MONTH, "channel_name").agg(
        *_summed("booked_cents"),
        *[cents.alias(kind) for kind, cents in of_type.items()],
        F.sum(F.when(F.col("channel_id").isNull(), F.col("booked_cents")).otherwise(zero)).alias("unattributed"),
        F.count("channel_id").alias("active_channels"),
    )
    # Most revenue first, none at all last, then the lowest name; a group without region or month has no top channel.
    revenue = F.col("booked_cents")
    ranked = F.col("channel_name").isNotNull()
    for name in REGION_MONTH:
        ranked = ranked & F.col(name).isNotNull()
    place = F.when(ranked, F.struct(revenue.isNull(), -revenue, F.col("channel_name")))
    base = by_name.groupBy(*REGION_MONTH).agg(
        F.sum("booked_cents").alias("total_cents"),
        *_summed(*of_type, "unattributed", "active_channels"),
        F.min_by("channel_name", place).alias("top_channel_by_revenue"),
    )
    met = rolled_up(placed, *REGION_MONTH, "customer_id", "event_id")
    counted = met.withColumn("customers", _first("customer_id", *REGION_MONTH, by="event_id"))
    by_event = counted.groupBy(*REGION_MONTH, "event_id").agg(*_summed("booked", "cancelled", "refunded", "customers"))
    reach = by_event.groupBy(*REGION_MONTH).agg(
        F.sum("booked").alias("tickets_sold"),
        F.sum("cancelled").alias("tickets_cancelled"),
        F.sum("refunded").alias("tickets_refunded"),
        F.sum("customers").alias("unique_customers"),
        F.count("event_id").alias("unique_events"),
    )
    # Both sides hold every group once, a group of platforms without region included.
    same_group = F.lit(True)
    for name in REGION_MONTH:
        same_group = same_group & base[name].eqNullSafe(reach[name])
    joined = base.join(reach, same_group).drop(*[reach[name] for name in REGION_MONTH])
    total = F.col("total_cents")
    label = [
        part
        for kind in SPLIT_TYPES
        for part in (F.lit(f"{kind}: "), percent_label(F.col(kind), total), F.lit("% | "))
    ]
    return joined.select(
        *REGION_MONTH,
        "tickets_sold",
        "tickets_cancelled",
        "tickets_refunded",
        dollars(total).alias("total_revenue_usd"),
        "unique_customers",
        "unique_events",
        "active_channels",
        "top_channel_by_revenue",
        *[percent(F.col(kind), total).alias(f"{kind.lower()}_revenue_pct") for kind in SPLIT_TYPES],
        F.concat(*label[:-1], F.lit("%")).alias("direct_vs_partner_vs_vendor_split"),
        percent(F.col("unattributed"), total).alias("unattributed_revenue_pct"),
    )


def channel_performance(silver: Tables) -> DataFrame:
    """Channel x month, active channels only; the share is of the revenue of those channels."""
    sold = silver.tickets.select(
        year_month(F.col("purchase_date")).alias(MONTH),
        "channel_id",
        "event_id",
        "customer_id",
        "ticket_status",
        "face_value_usd",
    )
    measured = rolled_up(_of_known_events(sold, silver), MONTH, "channel_id", "customer_id", "event_id")
    counted = measured.withColumn("unique_customers", _first("customer_id", MONTH, "channel_id", by="event_id"))
    by_event = counted.groupBy(MONTH, "channel_id", "event_id").agg(*_summed(*_MEASURES, "unique_customers"))
    monthly = by_event.groupBy(MONTH, "channel_id").agg(
        *_summed(*_MEASURES, "unique_customers"), F.count("event_id").alias("unique_events")
    )
    channels = silver.channels.select("channel_id", "channel_name", "channel_type", "platform_id")
    platforms = silver.platforms.select("platform_id", "platform_name", "platform_region")
    attributed = monthly.join(channels, "channel_id").join(platforms, "platform_id")
    # A month has one row a channel here.
    shared = share_of_total(attributed, [MONTH], "booked_cents", "channel_revenue_share_pct", small_groups=True)
    return shared.select(
        MONTH,
        "channel_id",
        "channel_name",
        "channel_type",
        "platform_id",
        "platform_name",
        "platform_region",
        F.col("booked").alias("total_tickets_sold"),
        F.col("cancelled").alias("total_cancelled"),
        F.col("refunded").alias("total_refunded"),
        dollars(F.col("booked_cents")).alias("total_revenue_usd"),
        average_cents(F.col("booked_cents"), F.col("priced")).alias("avg_ticket_price_usd"),
        percent(F.col("cancelled"), F.col("total")).alias("cancellation_rate"),
        percent(F.col("refunded"), F.col("total")).alias("refund_rate"),
        "unique_customers",
        "unique_events",
        "channel_revenue_share_pct",
    )
