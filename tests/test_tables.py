import datetime as dt

import pytest
from pyspark.sql import functions as F

from boxoffice.functions.dates import as_day
from boxoffice.plans import gold
from boxoffice.plans.silver import build_silver, current_rates
from boxoffice.schemas import pii_columns
from conftest import at, channel, customer, event, platform, rates, raw_tables, rows_of, ticket

AS_OF = "2024-06-01"


def silver_of(spark, seed=None, **rows):
    return build_silver(raw_tables(spark, **rows), rates(spark) if seed is None else seed, as_day(AS_OF))


def test_silver_events(spark):
    silver = silver_of(
        spark,
        events=[
            event("e1", ingested_at=at(1)),
            event("e1", event_name="rock day", ingested_at=at(2)),
            event("e2", ingested_at=at(1)),
            event("e2", event_date=None, ingested_at=at(2)),
            event(None),
        ],
    )
    # The newest version of e2 is unusable; the older good one does not come back.
    assert rows_of(silver.events, "event_id", "event_name", "venue_country", "venue_name") == [
        ("e1", "Rock Day", "NO", "Big Hall")
    ]


def test_silver_customers_keep_personal_data_marked(spark):
    silver = silver_of(spark, customers=[customer("c1"), customer("c1", phone="2", ingested_at=at(3))])
    assert rows_of(silver.customers, "customer_id", "phone", "country_of_residence", "loyalty_tier") == [
        ("c1", "2", "NO", "GOLD")
    ]
    assert pii_columns(silver.customers) == ["first_name", "last_name", "email", "phone"]
    assert pii_columns(silver.events) == []


def test_silver_platforms_and_channels(spark):
    silver = silver_of(
        spark,
        platforms=[platform("p1"), platform("p1"), platform(None)],
        channels=[
            channel("ch1"),
            channel("ch2", ingested_at=at(1)),
            channel("ch2", is_active=False, ingested_at=at(2)),
            channel("ch3", is_active=None),
        ],
    )
    assert rows_of(silver.platforms, "platform_id", "platform_name", "platform_region") == [("p1", "Ticket Hub", "EU")]
    assert rows_of(silver.channels, "channel_id", "channel_name", "channel_type", "channel_age_days") == [
        ("ch1", "Mobile App", "DIRECT", 517)
    ]


def test_silver_tickets(spark):
    silver = silver_of(
        spark,
        tickets=[
            ticket("t1", currency=" eur "),
            ticket("t2", currency="XXX"),
            ticket("t3", currency=None),
            ticket("t4", face_value=None),
            ticket("t5", event_id=None),
            ticket("t6", ingested_at=at(1)),
            ticket("t6", ingested_at=at(2), ticket_status="REFUNDED "),
        ],
    )
    columns = ("ticket_id", "currency", "face_value_usd", "is_rate_missing", "ticket_status", "platform_source")
    assert rows_of(silver.tickets, *columns) == [
        ("t1", "EUR", 10.9, False, "booked", "TICKET HUB"),
        ("t2", "XXX", 10.0, True, "booked", "TICKET HUB"),
        ("t3", None, 10.0, True, "booked", "TICKET HUB"),
        ("t4", "USD", None, False, "booked", "TICKET HUB"),
        ("t6", "USD", 10.0, False, "refunded", "TICKET HUB"),
    ]


def test_a_second_rate_does_not_repeat_tickets(spark):
    seed = rates(spark, [("EUR", 1.0, "2024-01-01"), ("EUR", 2.0, "2024-02-01"), ("USD", 1.0, "2024-01-01")])
    assert current_rates(seed).count() == 2
    silver = silver_of(spark, seed, tickets=[ticket("t1", currency="EUR")])
    assert rows_of(silver.tickets, "ticket_id", "face_value_usd") == [("t1", 20.0)]


def test_event_performance(spark):
    silver = silver_of(
        spark,
        events=[
            event("e1", event_capacity=2),
            event("e2", event_capacity=0),
            event("e3", event_capacity=None),
            event("e4"),
            event("e5"),
        ],
        tickets=[
            ticket("t1", face_value="10.01"),
            ticket("t2", face_value="10.00", customer_id="c2", channel_id="ch9"),
            ticket("t3", ticket_status="cancelled"),
            ticket("t4", event_id="e2"),
            ticket("t5", event_id="e3"),
            ticket("t6", event_id="e5", face_value=None),
        ],
    )
    result = gold.event_performance(silver)
    columns = (
        "event_id total_ticket_events tickets_sold tickets_cancelled total_revenue_usd avg_ticket_price_usd "
        "sell_through_rate_pct cancellation_rate_pct unique_customers channel_count"
    ).split()
    assert rows_of(result, *columns) == [
        ("e1", 3, 2, 1, 20.01, 10.01, 100.0, 33.33, 2, 2),
        ("e2", 1, 1, 0, 10.0, 10.0, None, 0.0, 1, 1),
        ("e3", 1, 1, 0, 10.0, 10.0, None, 0.0, 1, 1),
        ("e4", 0, 0, 0, 0.0, None, 0.0, None, 0, 0),
        # Booked, but of unknown value: the revenue is unknown, not 0.
        ("e5", 1, 1, 0, None, None, 50.0, 0.0, 1, 1),
    ]


def test_customer_behaviour(spark):
    silver = silver_of(
        spark,
        customers=[customer("c1"), customer("c2"), customer("c3")],
        channels=[
            channel("ch1", channel_name="b"),
            channel("ch2", channel_name="a"),
            channel("ch3", is_active=False),
        ],
        tickets=[
            ticket("t1", channel_id="ch1"),
            ticket("t2", channel_id="ch2", purchase_timestamp=at(20)),
            ticket("t3", channel_id="ch3"),
            ticket("t4", channel_id="ch3"),
            ticket("t5", channel_id="ch2", ticket_status="cancelled", event_id="e2"),
            ticket("t6", customer_id="c2", channel_id="ch3"),
        ],
    )
    result = gold.customer_behaviour(silver, as_day(AS_OF))
    columns = (
        "customer_id total_ticket_events total_tickets_purchased lifetime_spend_usd avg_spend_per_ticket_usd "
        "last_purchase_date days_since_last_purchase unique_events_attended preferred_channel"
    ).split()
    assert rows_of(result, *columns) == [
        # One booking each through the active channels: the lowest id wins, closed ones do not count.
        ("c1", 5, 4, 40.0, 10.0, dt.date(2024, 1, 20), 133, 2, "B"),
        ("c2", 1, 1, 10.0, 10.0, dt.date(2024, 1, 1), 152, 1, None),
        ("c3", 0, 0, 0.0, None, None, None, 0, None),
    ]


def sales(spark):
    return silver_of(
        spark,
        channels=[channel("ch1"), channel("ch2", channel_type="partner"), channel("ch9", is_active=False)],
        tickets=[
            ticket("t1", face_value="30.00"),
            ticket("t2", face_value="50.00", channel_id="ch2"),
            ticket("t3", face_value="20.00", channel_id="ch9"),
            ticket("t4", face_value="20.00", channel_id="ch8"),
            ticket("t5", face_value="7.00", event_id="unknown"),
            ticket("t6", face_value="7.00", platform_source="elsewhere"),
            ticket("t7", ticket_status="cancelled", purchase_timestamp=at(40 - 10)),
            ticket("t8", ticket_status="cancelled", purchase_timestamp=dt.datetime(2024, 2, 1, tzinfo=dt.timezone.utc)),
        ],
    )


def test_daily_sales(spark):
    result = gold.ticket_sales_daily(sales(spark))
    columns = "sale_date channel_id tickets_sold tickets_cancelled revenue_usd unique_customers".split()
    assert rows_of(result, *columns) == [
        (dt.date(2024, 1, 1), "ch1", 1, 0, 30.0, 1),
        (dt.date(2024, 1, 1), "ch2", 1, 0, 50.0, 1),
        # Closed and unknown channels share the row without a channel; its customer counts once.
        (dt.date(2024, 1, 1), None, 2, 0, 40.0, 1),
        (dt.date(2024, 1, 30), "ch1", 0, 1, 0.0, 1),
        (dt.date(2024, 2, 1), "ch1", 0, 1, 0.0, 1),
    ]
    assert result.select("daily_sales_key").distinct().count() == 5


def test_regional_summary(spark):
    result = gold.regional_summary(sales(spark))
    columns = (
        "platform_region year_month tickets_sold tickets_cancelled total_revenue_usd active_channels "
        "top_channel_by_revenue direct_revenue_pct partner_revenue_pct unattributed_revenue_pct "
        "direct_vs_partner_vs_vendor_split"
    ).split()
    assert rows_of(result, *columns) == [
        ("EU", "2024-01", 4, 1, 120.0, 2, "Mobile App", 25.0, 41.67, 33.33, "DIRECT: 25.0% | PARTNER: 41.7% | VENDOR: 0.0%"),
        ("EU", "2024-02", 0, 1, 0.0, 1, "Mobile App", None, None, None, None),
    ]


def test_region_without_name_is_kept(spark):
    silver = silver_of(spark, platforms=[platform(platform_region=None)])
    assert rows_of(gold.regional_summary(silver), "platform_region", "tickets_sold", "top_channel_by_revenue") == [
        (None, 1, None)
    ]


def test_channel_performance(spark):
    result = gold.channel_performance(sales(spark))
    columns = "year_month channel_id total_tickets_sold total_revenue_usd channel_revenue_share_pct".split()
    # t6 counts here: the platform is that of the channel.
    assert rows_of(result, *columns) == [
        ("2024-01", "ch1", 2, 37.0, 42.5287),
        ("2024-01", "ch2", 1, 50.0, 57.4713),
        ("2024-02", "ch1", 0, 0.0, None),
    ]


@pytest.mark.parametrize("name", ["ticket_sales_daily", "regional_summary", "channel_performance"])
def test_gold_does_not_depend_on_broadcasts(spark, name, monkeypatch):
    """The same rows when every lookup takes the salted path."""
    silver = sales(spark)
    expected = rows_of(getattr(gold, name)(silver))
    monkeypatch.setattr(gold, "dimension", lambda df: gold_dimension(df, 0))
    assert rows_of(getattr(gold, name)(silver)) == expected


def gold_dimension(df, rows):
    from boxoffice.operators.joins import dimension

    return dimension(df, rows)


def test_revenue_agrees_across_grains(spark):
    silver = sales(spark)
    daily = gold.ticket_sales_daily(silver).agg(F.sum("revenue_usd")).first()[0]
    monthly = gold.regional_summary(silver).agg(F.sum("total_revenue_usd")).first()[0]
    assert daily == monthly == 120.0
