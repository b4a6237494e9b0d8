"""The registered queries: every table and operator over the star-schema tables of a folder."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, DecimalType, TimestampType

from boxoffice.functions import text
from boxoffice.functions.dates import as_day, as_instant, days_between, year_month
from boxoffice.functions.keys import surrogate_key
from boxoffice.functions.money import average_cents, dollars, percent
from boxoffice.operators import joins, kpi, quality
from boxoffice.operators.conform import missing_required
from boxoffice.operators.dedup import any_per_key, latest_per_key
from boxoffice.operators.merge import high_water_mark, lookback, merge_literal
from boxoffice.operators.ranking import mode_per_group, top_k_per_group
from boxoffice.operators.share import share_of_total
from boxoffice.operators.sketch import distinct_sketches, error_bound, merged_sketches
from boxoffice.plans import gold, silver
from boxoffice.plans.build import run, shapes
from boxoffice.plans.checks import check_layer
from boxoffice.plans.incremental import build_incremental
from boxoffice.schemas import RAW, TABLES, pii_columns
from boxoffice.session import scratch_path
from boxoffice.sources import star_schema
from boxoffice.sources.raw import land, read_raw
from boxoffice.sources.seeds import read_rates
from boxoffice.sources.store import LayerStore
from boxoffice.streaming.streams import dedup_exact, dedup_replays, file_stream, read_deduplicated, stream_upsert
from boxoffice.tables import Tables

Query = Callable[[SparkSession, str], DataFrame]

# Today and now of the registered queries, pinned so that their answers do not age.
AS_OF = "2002-01-01"
RUN_TS = "2002-01-01T06:00:00"
# Where the incremental queries split the tickets by arrival.
CUT = "1998-06-01T00:00:00"

_REGISTRY: dict[str, Query] = {}


def registered() -> dict[str, Query]:
    return dict(_REGISTRY)


def presented(df: DataFrame) -> DataFrame:
    """Days and instants as ISO text and decimals as doubles: one form in every engine."""

    def plain(field):
        column = F.col(field.name)
        if isinstance(field.dataType, DateType):
            column = column.cast("string")
        elif isinstance(field.dataType, TimestampType):
            column = F.date_format(column, "yyyy-MM-dd HH:mm:ss")
        elif isinstance(field.dataType, DecimalType):
            column = column.cast("double")
        return column.alias(field.name)

    return df.select(*[plain(field) for field in df.schema.fields])


def query(build: Query) -> Query:
    _REGISTRY[build.__name__] = lambda spark, folder: presented(build(spark, folder))
    return build


def _raw(spark: SparkSession, folder: str):
    return star_schema.raw_from_star(spark, folder)


def _silver(spark: SparkSession, folder: str) -> Tables:
    return silver.build_silver(_raw(spark, folder), read_rates(spark), as_day(AS_OF))


def _sold(spark: SparkSession, folder: str) -> DataFrame:
    return _silver(spark, folder).tickets


# Sources, projections and scalar functions


@query
def scan_raw_tickets(spark, folder):
    return star_schema.raw_tickets(spark, folder)


@query
def scan_raw_events(spark, folder):
    return star_schema.raw_events(spark, folder)


@query
def scan_raw_customers(spark, folder):
    return star_schema.raw_customers(spark, folder)


@query
def scan_raw_channels(spark, folder):
    return star_schema.raw_channels(spark, folder)


@query
def scan_raw_platforms(spark, folder):
    return star_schema.raw_platforms(spark, folder)


@query
def seed_rates(spark, folder):
    """Use of the seed: raw tickets and their face value by currency, with its rate."""
    used = (
        star_schema.raw_tickets(spark, folder)
        .groupBy(text.upper_code(F.col("currency")).alias("currency"))
        .agg(F.count("*").alias("ticket_rows"), F.sum("face_value").alias("face_value"))
    )
    rates = silver.current_rates(read_rates(spark))
    return used.join(rates, F.col("currency") == F.col("from_currency"), "left").drop("from_currency")


@query
def seed_from_csv(spark, folder):
    """The same use of a seed that was written as a CSV file with header and read with declared types."""
    path = scratch_path(spark, "seed")
    read_rates(spark).write.option("header", True).csv(path)
    used = star_schema.raw_tickets(spark, folder).groupBy(text.upper_code(F.col("currency")).alias("currency")).count()
    rates = silver.current_rates(read_rates(spark, path))
    joined = used.join(rates, F.col("currency") == F.col("from_currency"))
    return joined.select("currency", F.col("count").alias("ticket_rows"), "rate")


@query
def clean_text(spark, folder):
    return star_schema.raw_events(spark, folder).select(
        "event_id",
        text.title_case(F.col("venue_name")).alias("title"),
        text.upper_code(F.col("venue_country")).alias("upper_code"),
        text.lower_code(F.col("event_category")).alias("lower_code"),
        F.concat(text.upper_code(F.col("platform_source")), F.lit("/"), F.trim("event_name")).alias("joined"),
    )


@query
def cast_types(spark, folder):
    """Strict casts from text and back, over every order line; the lenient cast gives NULL."""
    line = star_schema.table(spark, folder, "lineitem")
    as_text = line.select(
        F.col("l_orderkey").cast("string").alias("whole"),
        F.to_date("l_shipdate").cast("string").alias("day"),
        F.col("l_shipdate").cast("string").alias("instant"),
        F.col("l_extendedprice").cast("decimal(18,2)").cast("string").alias("price"),
        F.when(F.col("l_returnflag") == "N", "true").otherwise("false").alias("flag"),
        "l_linestatus",
    )
    return as_text.select(
        F.col("whole").cast("bigint").alias("whole"),
        F.col("day").cast("date").alias("day"),
        F.col("instant").cast("timestamp").alias("instant"),
        F.to_date(F.col("instant").cast("timestamp")).alias("day_of_instant"),
        F.col("price").cast("decimal(18,2)").alias("price"),
        F.col("flag").cast("boolean").alias("flag"),
        F.col("l_linestatus").try_cast("bigint").alias("not_a_number"),
    )


@query
def date_parts(spark, folder):
    """Month label and day differences of every channel and its sales month."""
    return star_schema.raw_channels(spark, folder).select(
        "channel_id",
        year_month(F.col("launch_date")).alias("launch_month"),
        days_between(as_day(AS_OF), F.col("launch_date")).alias("age_days"),
    )


@query
def surrogate_keys(spark, folder):
    return star_schema.raw_tickets(spark, folder).select(
        "ticket_id",
        "ingested_at",
        surrogate_key(
            F.col("ticket_id"), F.col("currency"), F.col("discount_code"), F.to_date("purchase_timestamp")
        ).alias("version_key"),
    )


# One row per key


@query
def dedup_latest(spark, folder):
    return latest_per_key(star_schema.raw_tickets(spark, folder), ["ticket_id"], "ingested_at")


@query
def dedup_any(spark, folder):
    bought = star_schema.raw_tickets(spark, folder).select("customer_id", "platform_source", "ticket_type")
    return any_per_key(bought, ["customer_id"])


@query
def currency_normalise(spark, folder):
    priced = silver.with_usd(star_schema.raw_tickets(spark, folder), silver.current_rates(read_rates(spark)))
    return priced.select("ticket_id", "ingested_at", "currency", "face_value", "face_value_usd", "is_rate_missing")


# Silver tables


@query
def silver_events(spark, folder):
    return _silver(spark, folder).events


@query
def silver_customers(spark, folder):
    return _silver(spark, folder).customers


@query
def silver_tickets(spark, folder):
    return _sold(spark, folder)


@query
def silver_platforms(spark, folder):
    return _silver(spark, folder).platforms


@query
def silver_channels(spark, folder):
    return _silver(spark, folder).channels


# Joins


@query
def tickets_of_open_channels(spark, folder):
    """Existence test: tickets sold through an active channel."""
    tables = _silver(spark, folder)
    open_channels = joins.dimension(tables.channels.select("channel_id"))
    return joins.lookup(
        tables.tickets.select("ticket_id", "channel_id", "face_value_usd"), open_channels, "channel_id", "left_semi"
    )


@query
def tickets_with_channel(spark, folder):
    """Left join that keeps tickets of closed channels, shuffled by key and salt as for a large table."""
    tables = _silver(spark, folder)
    named = joins.dimension(tables.channels.select("channel_id", "channel_name"), broadcast_bytes=0)
    return joins.lookup(tables.tickets.select("ticket_id", "channel_id"), named, "channel_id", "left")


# Aggregates, ranking, shares


@query
def status_measures(spark, folder):
    """Counts, sums, averages and rates per platform and month."""
    grouped = (
        _sold(spark, folder)
        .groupBy("platform_source", year_month(F.col("purchase_date")).alias("year_month"))
        .agg(
            F.count("ticket_id").alias("total"),
            kpi.count_status(kpi.BOOKED).alias("booked"),
            kpi.count_status(kpi.CANCELLED).alias("cancelled"),
            kpi.count_status(kpi.REFUNDED).alias("refunded"),
            kpi.valued(kpi.BOOKED).alias("priced"),
            kpi.usd_cents(kpi.BOOKED).alias("booked_cents"),
            kpi.usd_cents(kpi.REFUNDED).alias("refunded_cents"),
            F.max("purchase_date").alias("last_purchase_date"),
        )
    )
    return grouped.select(
        "platform_source",
        "year_month",
        "total",
        "booked",
        "cancelled",
        "refunded",
        dollars(F.col("booked_cents")).alias("revenue_usd"),
        dollars(F.col("refunded_cents")).alias("refund_value_usd"),
        average_cents(F.col("booked_cents"), F.col("priced")).alias("avg_price_usd"),
        percent(F.col("cancelled"), F.col("total")).alias("cancellation_rate_pct"),
        "last_purchase_date",
    )


@query
def distinct_reach(spark, folder):
    """Several distinct counts in one aggregate."""
    return (
        _sold(spark, folder)
        .groupBy("platform_source")
        .agg(
            F.count_distinct("customer_id").alias("unique_customers"),
            F.count_distinct("event_id").alias("unique_events"),
            F.count_distinct("channel_id").alias("unique_channels"),
        )
    )


@query
def approximate_reach(spark, folder):
    """Customers per region and month by merged daily sketches, held against the exact number."""
    tables = _silver(spark, folder)
    placed = gold.placed_tickets(tables, "purchase_date")
    daily = distinct_sketches(placed, ["platform_region", "purchase_date"], "customer_id")
    months = daily.withColumn("year_month", year_month(F.col("purchase_date")))
    merged = merged_sketches(months, ["platform_region", "year_month"])
    exact = placed.groupBy("platform_region", "year_month").agg(F.count_distinct("customer_id").alias("customers"))
    both = merged.join(exact, ["platform_region", "year_month"])
    off = F.abs(F.col("estimate") - F.col("customers"))
    return both.select(
        "platform_region",
        "year_month",
        "customers",
        (off <= F.greatest(F.lit(1), F.col("customers") * error_bound())).alias("is_close"),
    )


@query
def revenue_share(spark, folder):
    revenue = (
        _sold(spark, folder)
        .groupBy(year_month(F.col("purchase_date")).alias("year_month"), "channel_id")
        .agg(kpi.usd_cents(kpi.BOOKED).alias("booked_cents"))
    )
    shared = share_of_total(revenue, ["year_month"], "booked_cents", "share_pct")
    return shared.select("year_month", "channel_id", dollars(F.col("booked_cents")).alias("revenue_usd"), "share_pct")


@query
def top_events(spark, folder):
    """The three events with most revenue per platform."""
    revenue = (
        _sold(spark, folder)
        .groupBy("platform_source", "event_id")
        .agg(kpi.usd_cents(kpi.BOOKED).alias("revenue_cents"))
    )
    best = top_k_per_group(
        revenue, ["platform_source"], [F.desc_nulls_last("revenue_cents"), F.asc("event_id")], k=3
    )
    return best.select("platform_source", "event_id", dollars(F.col("revenue_cents")).alias("revenue_usd"))


@query
def usual_currency(spark, folder):
    """The most frequent currency of every customer."""
    return mode_per_group(_sold(spark, folder), ["customer_id"], "currency")


@query
def preferred_channel(spark, folder):
    return gold.preferred_channel(_silver(spark, folder))


@query
def top_channel(spark, folder):
    best = gold.top_channel(gold.channel_sales_by_region(_silver(spark, folder)))
    return best.select(
        "platform_region", "year_month", "top_channel_by_revenue", dollars(F.col("revenue_cents")).alias("revenue_usd")
    )


@query
def type_split(spark, folder):
    return gold.regional_summary(_silver(spark, folder)).select(
        "platform_region",
        "year_month",
        "direct_revenue_pct",
        "partner_revenue_pct",
        "vendor_revenue_pct",
        "unattributed_revenue_pct",
        "direct_vs_partner_vs_vendor_split",
    )


# Gold tables


@query
def gold_ticket_sales_daily(spark, folder):
    return gold.ticket_sales_daily(_silver(spark, folder))


@query
def gold_event_performance(spark, folder):
    return gold.event_performance(_silver(spark, folder))


@query
def gold_customer_behaviour(spark, folder):
    return gold.customer_behaviour(_silver(spark, folder), as_day(AS_OF))


@query
def gold_regional_summary(spark, folder):
    return gold.regional_summary(_silver(spark, folder))


@query
def gold_channel_performance(spark, folder):
    return gold.channel_performance(_silver(spark, folder))


# Data checks


@query
def check_not_null(spark, folder):
    unpriced = quality.not_null(star_schema.raw_tickets(spark, folder), "currency")
    return unpriced.select("ticket_id", "ingested_at", "channel_id")


@query
def check_required(spark, folder):
    """Required columns of the declared schema that came without a value."""
    return missing_required(star_schema.raw_tickets(spark, folder), RAW["tickets"]).select("ticket_id", "ingested_at")


@query
def check_required_loss(spark, folder):
    """The same check on tickets that lost their buyer with the last day of every month."""
    raw = star_schema.raw_tickets(spark, folder)
    bought = F.to_date("purchase_timestamp")
    lost = F.when(bought != F.last_day(bought), F.col("customer_id"))
    return missing_required(raw.withColumn("customer_id", lost), RAW["tickets"]).select("ticket_id", "ingested_at")


@query
def check_unique(spark, folder):
    return quality.unique(star_schema.raw_tickets(spark, folder), "ticket_id")


@query
def check_accepted_values(spark, folder):
    offending = quality.accepted_values(star_schema.raw_tickets(spark, folder), "ticket_status", kpi.STATUSES)
    return offending.select("ticket_id", "ingested_at", "ticket_status")


@query
def check_relationships(spark, folder):
    tables = _silver(spark, folder)
    return quality.relationships(tables.tickets, "channel_id", tables.channels, "channel_id").select(
        "ticket_id", "channel_id"
    )


@query
def assert_revenue_non_negative(spark, folder):
    return quality.revenue_non_negative(_sold(spark, folder))


@query
def assert_sell_through_rate(spark, folder):
    return quality.sell_through_within_capacity(gold.event_performance(_silver(spark, folder)))


@query
def assert_channel_revenue_share_sums_to_100(spark, folder):
    return quality.shares_sum_to_100(gold.channel_performance(_silver(spark, folder)))


@query
def assert_shares_of_a_short_report(spark, folder):
    """Months whose shares no longer add up when the report has lost a channel type."""
    report = gold.channel_performance(_silver(spark, folder)).where(F.col("channel_type") != "DIRECT")
    return quality.shares_sum_to_100(report)


@query
def monthly_share_totals(spark, folder):
    return quality.monthly_shares(gold.channel_performance(_silver(spark, folder)))


@query
def check_report_raw(spark, folder):
    return check_layer("raw", _raw(spark, folder))


# Late data, upserts, sinks, streams


@query
def incremental_lookback(spark, folder):
    tickets = star_schema.raw_tickets(spark, folder)
    return lookback(tickets, "ingested_at", high_water_mark(tickets, "ingested_at"))


@query
def landing_lookback(spark, folder):
    """Customers landed by day of arrival, and those of the last days read back: other folders are not opened."""
    landing = scratch_path(spark, "landing")
    land(star_schema.raw_customers(spark, folder), landing, "customers")
    customers = read_raw(spark, landing).customers
    recent = lookback(customers, "ingested_at", high_water_mark(customers, "ingested_at"))
    return recent.select(*RAW["customers"].names)


def _two_runs(spark: SparkSession, folder: str, purpose: str) -> LayerStore:
    """Tickets that arrived before the cut, then an incremental run over all of them."""
    store = LayerStore(spark, scratch_path(spark, purpose))
    tickets = star_schema.raw_tickets(spark, folder, dealt=True)
    shape = shapes(read_rates(spark), as_day(AS_OF), as_instant(RUN_TS))["tickets"]
    build_incremental(store, tickets.where(F.col("ingested_at") < as_instant(CUT)), "tickets", shape)
    build_incremental(store, tickets, "tickets", shape)
    return store


@query
def upsert_latest(spark, folder):
    return _two_runs(spark, folder, "upsert").read("silver", "tickets").drop("_loaded_at")


@query
def merge_plain(spark, folder):
    """A plain merge as one DataFrame: matched rows replaced, none deleted."""
    raw = star_schema.raw_channels(spark, folder)
    early = F.col("launch_date") < F.lit("1995-06-01").cast("date")
    changed = raw.where(~early).unionByName(raw.where(early & (F.col("channel_type") == "vendor")))
    old = silver.table_of(silver.shape_channels(raw.where(early), as_day(AS_OF)), "channels")
    new = silver.table_of(silver.shape_channels(changed, as_day("2002-02-01")), "channels")
    return merge_literal(old, new, TABLES["channels"].keys)


@query
def sink_daily(spark, folder):
    """The daily table written by day, clustered, and read back."""
    store = LayerStore(spark, scratch_path(spark, "sink"))
    table = TABLES["ticket_sales_daily"]
    rows = gold.daily_rows(_silver(spark, folder))
    store.replace(rows, "gold", table.name, [table.partition_by], table.cluster_by, finish=gold.daily_report)
    return store.read("gold", table.name)


def _pipeline(spark: SparkSession, folder: str, purpose: str) -> tuple[LayerStore, DataFrame]:
    base = scratch_path(spark, purpose)
    report = run(spark, _raw(spark, folder), base, AS_OF, RUN_TS)
    return LayerStore(spark, base), report


@query
def selected_events_view(spark, folder):
    """A run of one named table, read through its view, with the audit column."""
    base = scratch_path(spark, "selected")
    raw = _raw(spark, folder)
    run(spark, raw, base, AS_OF, RUN_TS, layers=("seeds", "silver"), tables=("currency_rates", "events"))
    name = LayerStore(spark, base).view("silver", "events")
    return spark.sql(f"SELECT event_id, event_name, event_capacity, _loaded_at FROM {name}")


@query
def personal_data(spark, folder):
    """Columns of stored customers that their metadata marks as personal, and how many rows fill them."""
    base = scratch_path(spark, "personal")
    raw = _raw(spark, folder)
    run(spark, raw, base, AS_OF, RUN_TS, layers=("seeds", "silver"), tables=("currency_rates", "customers"))
    customers = LayerStore(spark, base).read("silver", "customers")
    names = pii_columns(customers)
    notes = {name: customers.schema[name].metadata["comment"] for name in names}
    counts = customers.agg(*[F.count(name).alias(name) for name in names])
    rows = [F.struct(F.lit(n).alias("column_name"), F.lit(notes[n]).alias("note"), F.col(n).alias("filled")) for n in names]
    return counts.select(F.explode(F.array(*rows)).alias("row")).select("row.*")


@query
def pipeline_check_report(spark, folder):
    """The whole build, raw to gold, and the report of all its checks."""
    return _pipeline(spark, folder, "report")[1]


@query
def stream_upsert_tickets(spark, folder):
    """Silver tickets that arrived before the cut, then a stream of all order lines merged into them."""
    lines = file_stream(spark, f"{folder}/lineitem.parquet", star_schema.STAR["lineitem"])
    store = LayerStore(spark, scratch_path(spark, "stream"))
    shape = shapes(read_rates(spark), as_day(AS_OF), as_instant(RUN_TS))["tickets"]
    early = star_schema.raw_tickets(spark, folder, dealt=True).where(F.col("ingested_at") < as_instant(CUT))
    build_incremental(store, early, "tickets", shape)

    def of_lines(batch):
        # Joined within the batch, where Spark knows how its rows lie, so that versions are not shuffled again.
        return shape(star_schema.raw_tickets(batch.sparkSession, folder, batch, dealt=True))

    stream_upsert(lines, store, "tickets", of_lines, scratch_path(spark, "stream-log")).awaitTermination()
    return store.read("silver", "tickets").drop("_loaded_at")


@query
def stream_dedup(spark, folder):
    """A stream in which every record arrives twice, with the repeats dropped."""
    arrivals = file_stream(spark, f"{folder}/events.parquet", star_schema.STAR["events"])
    arrivals = arrivals.withColumn("ts", F.col("ts").cast("timestamp"))
    once = dedup_exact(arrivals.unionByName(arrivals), ["event_id"])
    out = scratch_path(spark, "dedup")
    (
        once.writeStream.format("parquet")
        .option("checkpointLocation", scratch_path(spark, "dedup-log"))
        .trigger(availableNow=True)
        .start(out)
        .awaitTermination()
    )
    return spark.read.parquet(out).select("event_id", "user_id", "event_type", "value")


@query
def stream_dedup_replays(spark, folder):
    """Three files of records streamed twice each, file by file: every record once, without a state in memory."""
    landing, out = scratch_path(spark, "replays"), scratch_path(spark, "replays-out")
    events = spark.read.schema(star_schema.STAR["events"]).parquet(f"{folder}/events.parquet")
    events = events.withColumn("ts", F.col("ts").cast("timestamp"))
    for _ in range(2):
        for part in range(3):
            events.where(F.pmod(F.xxhash64("event_id"), F.lit(3)) == part).coalesce(1).write.mode("append").parquet(landing)
    arrivals = file_stream(spark, landing, events.schema, 1)
    dedup_replays(arrivals, out, ["event_id"], "ts", scratch_path(spark, "replays-log")).awaitTermination()
    return read_deduplicated(spark, out).select("event_id", "user_id", "event_type", "value")
