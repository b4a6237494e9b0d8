"""Raw tables made from a generic star schema (orders, lines, parts, customers, suppliers).

The recipes give every feature the silver layer has to handle: several versions of a ticket,
padded and mixed-case text, unknown and missing currencies, zero and missing capacities,
closed channels and repeated channel names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from boxoffice.operators.conform import conform
from boxoffice.schemas import DEALT_BY, RAW
from boxoffice.tables import Tables

# What the star schema's codes stand for.
CURRENCIES = (
    "USD", "EUR", "GBP", "AUD", "CAD", "JPY", "BRL", "MXN", "SGD", "HKD",
    "NZD", "ZAR", "INR", "CNY", "KRW", "CHF", "SEK", "NOK", "DKK", "PLN",
    "XXX",
)
CURRENCY_SLOTS = 22
STATUS_TEXT = {"N": " Booked", "A": "CANCELLED ", "R": "refunded"}
TICKET_TYPE_TEXT = {"O": " standard", "F": "Vip "}
CHANNEL_NAMES = ("mobile app", "website", "partner portal", "third party vendor")
CHANNEL_TYPES = ("direct", "partner", "vendor")
REGION_CODES = {"AMERICA": "us", "EUROPE": "eu", "AFRICA": "latam"}
OTHER_REGION = "apac"

# Order lines that one task joins and deduplicates, beyond a table of that many.
LINES_PER_TASK = 500_000


# The star schema's columns.
STAR = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderdate timestamp_ntz",
    "lineitem": (
        "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_extendedprice double, "
        "l_discount double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz"
    ),
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double",
}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.schema(STAR[name]).parquet(f"{folder}/{name}.parquet")


def _pick(values: tuple[str, ...], slot: Column) -> Column:
    """The value in a slot, NULL beyond the last."""
    return F.get(F.array(*[F.lit(value) for value in values]), slot.cast("int"))


def _decode(code: Column, meaning: dict[str, str]) -> Column:
    choice = F
    for key, text in meaning.items():
        choice = choice.when(code == key, F.lit(text))
    return choice


def _day(start: str, offset: Column) -> Column:
    return F.date_add(F.lit(start).cast("date"), offset.cast("int"))


def _dealt(lines: DataFrame, lines_per_task: int) -> DataFrame:
    """Many order lines by order, in as many partitions as their number asks for, so that a task stays small."""
    rows = lines.count()  # file footers only
    if rows <= lines_per_task:
        return lines
    partitions = max(-(-rows // lines_per_task), lines.sparkSession.sparkContext.defaultParallelism)
    return lines.repartition(partitions, "l_orderkey")


def raw_tickets(
    spark: SparkSession,
    folder: str,
    lines: DataFrame | None = None,
    dealt: bool = False,
    lines_per_task: int = LINES_PER_TASK,
) -> DataFrame:
    """``lines`` may be other order lines than those of the folder, a stream of them too; the other tables are static.

    With ``dealt`` the tickets carry their order as a last column. A ticket's id begins with it, so the shuffle that
    joins lines to orders also brings the versions of a ticket together.
    """
    line = table(spark, folder, "lineitem") if lines is None else lines
    if dealt and not line.isStreaming:
        line = _dealt(line, lines_per_task)
    schema = StructType([*RAW["tickets"].fields, StructField(DEALT_BY, LongType())]) if dealt else RAW["tickets"]
    # One table after the other: Spark knows the size of each file, but overestimates a join of the three.
    sold = (
        line.join(table(spark, folder, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
        .join(table(spark, folder, "supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
        .join(table(spark, folder, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
        .join(table(spark, folder, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    )
    percent = F.round(F.col("l_discount") * 100).cast("int").cast("string")
    # The discounted price keeps its four decimals; some refunds were entered as sales below zero.
    price = F.col("l_extendedprice").cast("decimal(18,2)") * (1 - F.col("l_discount").cast("decimal(4,2)"))
    price = F.when(F.col("l_orderkey") % 1009 == 0, -price).otherwise(price)
    return conform(
        sold.select(
            F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string")).alias(
                "ticket_id"
            ),
            F.col("l_partkey").alias("event_id"),
            F.col("o_custkey").alias("customer_id"),
            _decode(F.col("l_linestatus"), TICKET_TYPE_TEXT).alias("ticket_type"),
            price.alias("face_value"),
            _pick(CURRENCIES, F.col("l_partkey") % CURRENCY_SLOTS).alias("currency"),
            F.col("o_orderdate").alias("purchase_timestamp"),
            _decode(F.col("l_returnflag"), STATUS_TEXT).alias("ticket_status"),
            F.when(F.col("l_discount") != 0, F.concat(F.lit("D"), percent)).alias("discount_code"),
            F.col("r_name").alias("platform_source"),
            F.col("l_suppkey").alias("channel_id"),
            F.col("l_shipdate").alias("ingested_at"),
            F.col("l_orderkey").alias(DEALT_BY),
        ),
        schema,
    )


def raw_events(spark: SparkSession, folder: str) -> DataFrame:
    part, region = table(spark, folder, "part"), table(spark, folder, "region")
    key = F.col("p_partkey")
    capacity = F.when(key % 97 == 0, F.lit(None)).when(key % 89 == 0, F.lit(0)).otherwise(F.col("p_size"))
    return conform(
        part.join(region, key % 5 == F.col("r_regionkey")).select(
            key.alias("event_id"),
            F.concat(F.lit("  "), F.col("p_name")).alias("event_name"),
            F.col("p_type").alias("event_category"),
            F.concat(F.col("p_brand"), F.lit(" HALL ")).alias("venue_name"),
            F.concat(F.lit("city "), (key % 25).cast("string")).alias("venue_city"),
            F.concat(F.lit(" c"), (key % 25).cast("string")).alias("venue_country"),
            _day("1995-01-01", key % 2500).alias("event_date"),
            capacity.alias("event_capacity"),
            F.lower(F.col("r_name")).alias("platform_source"),
            _day("1994-01-01", key % 365).alias("ingested_at"),
        ),
        RAW["events"],
    )


def raw_customers(spark: SparkSession, folder: str) -> DataFrame:
    nation, region = table(spark, folder, "nation"), table(spark, folder, "region")
    home = nation.join(region, F.col("n_regionkey") == F.col("r_regionkey"))
    key, balance = F.col("c_custkey"), F.col("c_acctbal")
    tier = (
        F.when(balance < 0, " bronze")
        .when(balance < 3000, "Silver ")
        .when(balance < 7000, "gold")
        .otherwise("Platinum")
    )
    return conform(
        table(spark, folder, "customer")
        .join(home, F.col("c_nationkey") == F.col("n_nationkey"))
        .select(
            key.alias("customer_id"),
            F.substring("c_name", 1, 8).alias("first_name"),
            F.substring("c_name", 10, 9).alias("last_name"),
            F.concat(F.lit("user"), key.cast("string"), F.lit("@example.org")).alias("email"),
            F.concat(F.lit("+1-555-"), F.substring("c_name", 12, 7)).alias("phone"),
            F.concat(F.lower(F.col("n_name")), F.lit(" ")).alias("country_of_residence"),
            _day("1994-01-01", key % 365).alias("signup_date"),
            tier.alias("loyalty_tier"),
            F.lower(F.col("r_name")).alias("platform_source"),
            _day("1994-01-02", key % 365).alias("ingested_at"),
        ),
        RAW["customers"],
    )


def raw_channels(spark: SparkSession, folder: str) -> DataFrame:
    key = F.col("s_suppkey")
    return conform(
        table(spark, folder, "supplier")
        .join(table(spark, folder, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
        .select(
            key.alias("channel_id"),
            F.concat(F.lit(" "), _pick(CHANNEL_NAMES, key % 4)).alias("channel_name"),
            _pick(CHANNEL_TYPES, key % 3).alias("channel_type"),
            F.concat(F.lit(" Sold through "), F.col("s_name"), F.lit(" ")).alias("channel_description"),
            F.col("n_regionkey").alias("platform_id"),
            (F.col("s_acctbal") > 0).alias("is_active"),
            _day("1994-01-01", key % 3000).alias("launch_date"),
            _day("1994-01-02", key % 3000).alias("ingested_at"),
        ),
        RAW["channels"],
    )


def raw_platforms(spark: SparkSession, folder: str) -> DataFrame:
    region = F.coalesce(_decode(F.col("r_name"), REGION_CODES), F.lit(OTHER_REGION))
    return conform(
        table(spark, folder, "region").select(
            F.col("r_regionkey").alias("platform_id"),
            F.concat(F.lit(" "), F.lower(F.col("r_name"))).alias("platform_name"),
            region.alias("platform_region"),
            _day("1993-01-01", F.col("r_regionkey")).alias("launch_date"),
            F.lit(True).alias("is_active"),
        ),
        RAW["platforms"],
    )


def raw_from_star(spark: SparkSession, folder: str) -> Tables:
    return Tables(
        {
            "tickets": lambda: raw_tickets(spark, folder, dealt=True),
            "events": lambda: raw_events(spark, folder),
            "customers": lambda: raw_customers(spark, folder),
            "channels": lambda: raw_channels(spark, folder),
            "platforms": lambda: raw_platforms(spark, folder),
        }
    )
