import datetime as dt
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from boxoffice.operators.conform import conform  # noqa: E402
from boxoffice.schemas import RAW, SEED  # noqa: E402
from boxoffice.session import build_session  # noqa: E402
from boxoffice.tables import Tables  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        "local[8]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "4g",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
            "spark.local.dir": str(tmp_path_factory.mktemp("local")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def at(day: int, hour: int = 0) -> dt.datetime:
    """A moment in January 2024."""
    return dt.datetime(2024, 1, day, hour, tzinfo=dt.timezone.utc)


def ticket(ticket_id="t1", **changes):
    row = {
        "ticket_id": ticket_id,
        "event_id": "e1",
        "customer_id": "c1",
        "ticket_type": " vip",
        "face_value": "10.00",
        "currency": "USD",
        "purchase_timestamp": at(1),
        "ticket_status": " Booked",
        "discount_code": None,
        "platform_source": " ticket hub",
        "channel_id": "ch1",
        "ingested_at": at(2),
    }
    return {**row, **changes}


def event(event_id="e1", **changes):
    row = {
        "event_id": event_id,
        "event_name": "  rock nIGHT",
        "event_category": "concert",
        "venue_name": "big hall ",
        "venue_city": "oslo",
        "venue_country": "no",
        "event_date": dt.date(2024, 5, 1),
        "event_capacity": 2,
        "platform_source": "ticket hub",
        "ingested_at": at(1),
    }
    return {**row, **changes}


def customer(customer_id="c1", **changes):
    row = {
        "customer_id": customer_id,
        "first_name": "Ada",
        "last_name": "Berg",
        "email": "ada@example.org",
        "phone": "1",
        "country_of_residence": " no",
        "signup_date": dt.date(2023, 1, 1),
        "loyalty_tier": "gold ",
        "platform_source": "ticket hub",
        "ingested_at": at(1),
    }
    return {**row, **changes}


def channel(channel_id="ch1", **changes):
    row = {
        "channel_id": channel_id,
        "channel_name": "mobile app",
        "channel_type": "direct",
        "channel_description": " by phone ",
        "platform_id": "p1",
        "is_active": True,
        "launch_date": dt.date(2023, 1, 1),
        "ingested_at": at(1),
    }
    return {**row, **changes}


def platform(platform_id="p1", **changes):
    row = {
        "platform_id": platform_id,
        "platform_name": "  tIcKeT hub ",
        "platform_region": "eu",
        "launch_date": dt.date(2020, 1, 1),
        "is_active": True,
    }
    return {**row, **changes}


_TEXT_FIRST = {"decimal(38,9)": "string"}


def frame(spark, name, rows):
    """Rows as a raw table; money is given as text so that no digit is lost."""
    schema = RAW[name]
    columns = [f"{f.name} {_TEXT_FIRST.get(f.dataType.simpleString(), f.dataType.simpleString())}" for f in schema]
    data = [tuple(row[f.name] for f in schema) for row in rows]
    return conform(spark.createDataFrame(data, ", ".join(columns)), schema)


def raw_tables(spark, **rows):
    defaults = {
        "tickets": [ticket()],
        "events": [event()],
        "customers": [customer()],
        "channels": [channel()],
        "platforms": [platform()],
    }
    chosen = {**defaults, **rows}
    return Tables({name: (lambda name=name: frame(spark, name, chosen[name])) for name in RAW})


def rates(spark, rows=(("USD", 1.0, "2024-01-01"), ("EUR", 1.09, "2024-01-01"))):
    data = [(code, "USD", rate, dt.date.fromisoformat(day)) for code, rate, day in rows]
    return spark.createDataFrame(data, "from_currency string, to_currency string, rate double, effective_date date").to(
        SEED
    )


def rows_of(df, *columns):
    """Rows as a sorted list of tuples."""
    picked = df.select(*columns) if columns else df
    return sorted((tuple(row) for row in picked.collect()), key=lambda r: [(v is None, str(v)) for v in r])
