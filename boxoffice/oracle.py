"""The registered queries again, as SQL text for an independent engine.

Written from the definition of each table, row by row and without the rewrites of the Spark
plans (no aggregation before joins, no salting), so that it can disagree with them.
"""

from __future__ import annotations

from boxoffice.plans.checks import CHECKS
from boxoffice.queries import AS_OF, RUN_TS
from boxoffice.schemas import RAW
from boxoffice.sources.seeds import packaged_rates
from boxoffice.sources.star_schema import CURRENCIES


def _pct(part: str, whole: str, places: int = 2) -> str:
    scale = 10**places
    return f"({_half_away(part, whole, 100 * scale)}::DOUBLE / {scale})"


def _half_away(n: str, d: str, factor: int = 1) -> str:
    n, d = f"({n})::HUGEINT", f"nullif(({d})::HUGEINT, 0)"
    return f"(sign({n}) * sign({d}) * ((2 * abs({n}) * {factor} + abs({d})) // (2 * abs({d}))))::BIGINT"


def _usd(cents: str) -> str:
    return f"(({cents})::BIGINT::DOUBLE / 100)"


def _title(column: str) -> str:
    words = f"string_split(lower(trim({column})), ' ')"
    return f"array_to_string(list_transform({words}, lambda w: upper(w[1]) || w[2:]), ' ')"


def _time(column: str) -> str:
    return f"strftime({column}, '%Y-%m-%d %H:%M:%S')"


def _day(column: str) -> str:
    return f"CAST({column} AS VARCHAR)"


_RATES = ", ".join(f"('{r['from_currency']}', {r['rate']:.8f})" for r in packaged_rates())
_CODES = ", ".join(f"'{code}'" for code in CURRENCIES)

RAW_TICKETS = f"""
raw_tickets AS (
  SELECT l_orderkey::VARCHAR || '-' || l_linenumber::VARCHAR AS ticket_id,
         l_partkey::VARCHAR AS event_id, o_custkey::VARCHAR AS customer_id,
         CASE l_linestatus WHEN 'O' THEN ' standard' WHEN 'F' THEN 'Vip ' END AS ticket_type,
         CAST(CASE WHEN l_orderkey % 1009 = 0 THEN -1 ELSE 1 END
              * CAST(l_extendedprice AS DECIMAL(18,2)) * (1 - CAST(l_discount AS DECIMAL(4,2))) AS DECIMAL(24,9))
           AS face_value,
         ([{_CODES}])[(l_partkey % 22) + 1] AS currency,
         o_orderdate AS purchase_timestamp,
         CASE l_returnflag WHEN 'N' THEN ' Booked' WHEN 'A' THEN 'CANCELLED ' WHEN 'R' THEN 'refunded' END
           AS ticket_status,
         CASE WHEN l_discount <> 0 THEN 'D' || CAST(CAST(round(l_discount * 100) AS INTEGER) AS VARCHAR) END
           AS discount_code,
         r_name AS platform_source, l_suppkey::VARCHAR AS channel_id, l_shipdate AS ingested_at
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
  JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey
  JOIN region ON n_regionkey = r_regionkey)"""

RAW_EVENTS = """
raw_events AS (
  SELECT p_partkey::VARCHAR AS event_id, '  ' || p_name AS event_name, p_type AS event_category,
         p_brand || ' HALL ' AS venue_name, 'city ' || (p_partkey % 25)::VARCHAR AS venue_city,
         ' c' || (p_partkey % 25)::VARCHAR AS venue_country,
         DATE '1995-01-01' + (p_partkey % 2500)::INTEGER AS event_date,
         CASE WHEN p_partkey % 97 = 0 THEN NULL WHEN p_partkey % 89 = 0 THEN 0 ELSE p_size END::BIGINT
           AS event_capacity,
         lower(r_name) AS platform_source,
         CAST(DATE '1994-01-01' + (p_partkey % 365)::INTEGER AS TIMESTAMP) AS ingested_at
  FROM part JOIN region ON p_partkey % 5 = r_regionkey)"""

RAW_CUSTOMERS = """
raw_customers AS (
  SELECT c_custkey::VARCHAR AS customer_id, substr(c_name, 1, 8) AS first_name, substr(c_name, 10, 9) AS last_name,
         'user' || c_custkey::VARCHAR || '@example.org' AS email, '+1-555-' || substr(c_name, 12, 7) AS phone,
         lower(n_name) || ' ' AS country_of_residence,
         DATE '1994-01-01' + (c_custkey % 365)::INTEGER AS signup_date,
         CASE WHEN c_acctbal < 0 THEN ' bronze' WHEN c_acctbal < 3000 THEN 'Silver '
              WHEN c_acctbal < 7000 THEN 'gold' ELSE 'Platinum' END AS loyalty_tier,
         lower(r_name) AS platform_source,
         CAST(DATE '1994-01-02' + (c_custkey % 365)::INTEGER AS TIMESTAMP) AS ingested_at
  FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)"""

RAW_CHANNELS = """
raw_channels AS (
  SELECT s_suppkey::VARCHAR AS channel_id,
         CASE s_suppkey % 4 WHEN 0 THEN ' mobile app' WHEN 1 THEN ' website' WHEN 2 THEN ' partner portal'
              ELSE ' third party vendor' END AS channel_name,
         CASE s_suppkey % 3 WHEN 0 THEN 'direct' WHEN 1 THEN 'partner' ELSE 'vendor' END AS channel_type,
         ' Sold through ' || s_name || ' ' AS channel_description, n_regionkey::VARCHAR AS platform_id,
         s_acctbal > 0 AS is_active, DATE '1994-01-01' + (s_suppkey % 3000)::INTEGER AS launch_date,
         CAST(DATE '1994-01-02' + (s_suppkey % 3000)::INTEGER AS TIMESTAMP) AS ingested_at
  FROM supplier JOIN nation ON s_nationkey = n_nationkey)"""

RAW_PLATFORMS = """
raw_platforms AS (
  SELECT r_regionkey::VARCHAR AS platform_id, ' ' || lower(r_name) AS platform_name,
         CASE r_name WHEN 'AMERICA' THEN 'us' WHEN 'EUROPE' THEN 'eu' WHEN 'AFRICA' THEN 'latam' ELSE 'apac' END
           AS platform_region,
         DATE '1993-01-01' + r_regionkey AS launch_date, TRUE AS is_active
  FROM region)"""

RATES = f"""
rates AS (SELECT c AS from_currency, CAST(r AS DECIMAL(12,8)) AS rate FROM (VALUES {_RATES}) v(c, r))"""

_TIE = ", ".join(
    f"{c} ASC NULLS FIRST"
    for c in (
        "event_id customer_id ticket_type face_value currency purchase_timestamp ticket_status "
        "discount_code platform_source channel_id"
    ).split()
)

NEWEST_TICKETS = f"""
newest_tickets AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY ticket_id ORDER BY ingested_at DESC NULLS LAST, {_TIE}) AS rn
    FROM raw_tickets) WHERE rn = 1)"""

_CONVERTED = "round(face_value * coalesce(rate, CAST(1 AS DECIMAL(12,8))), 2)"

# Ties of the silver table are broken on the cleaned columns.
_CLEAN_TIE = ", ".join(
    f"{c} ASC NULLS FIRST"
    for c in (
        "event_id customer_id channel_id ticket_type face_value currency cents purchase_timestamp "
        "ticket_status discount_code platform_source is_rate_missing"
    ).split()
)

TICKETS = f"""
versions AS (
  SELECT ticket_id, event_id, customer_id, channel_id, upper(trim(ticket_type)) AS ticket_type, face_value,
         upper(trim(currency)) AS currency, CAST({_CONVERTED} * 100 AS BIGINT) AS cents,
         purchase_timestamp, CAST(purchase_timestamp AS DATE) AS purchase_date,
         strftime(purchase_timestamp, '%Y-%m') AS year_month,
         lower(trim(ticket_status)) AS ticket_status, discount_code, upper(trim(platform_source)) AS platform_source,
         ingested_at, rate IS NULL AS is_rate_missing
  FROM raw_tickets LEFT JOIN rates ON upper(trim(currency)) = from_currency
  WHERE ticket_id IS NOT NULL),
tickets AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY ticket_id ORDER BY ingested_at DESC NULLS LAST, {_CLEAN_TIE}) AS rn
    FROM versions) WHERE rn = 1 AND event_id IS NOT NULL AND customer_id IS NOT NULL)"""

EVENTS = f"""
s_events AS (
  SELECT event_id, {_title("event_name")} AS event_name, {_title("event_category")} AS event_category,
         {_title("venue_name")} AS venue_name, {_title("venue_city")} AS venue_city,
         upper(trim(venue_country)) AS venue_country, event_date, event_capacity,
         upper(trim(platform_source)) AS platform_source, ingested_at
  FROM raw_events WHERE event_id IS NOT NULL AND event_date IS NOT NULL)"""

CUSTOMERS = """
s_customers AS (
  SELECT customer_id, first_name, last_name, email, phone, upper(trim(country_of_residence)) AS country_of_residence,
         signup_date, upper(trim(loyalty_tier)) AS loyalty_tier, upper(trim(platform_source)) AS platform_source,
         ingested_at
  FROM raw_customers WHERE customer_id IS NOT NULL)"""

CHANNELS = f"""
s_channels AS (
  SELECT channel_id, {_title("channel_name")} AS channel_name, upper(trim(channel_type)) AS channel_type,
         trim(channel_description) AS channel_description, platform_id, is_active, launch_date,
         date_diff('day', launch_date, DATE '{AS_OF}') AS channel_age_days, ingested_at
  FROM raw_channels WHERE is_active AND channel_id IS NOT NULL)"""

PLATFORMS = f"""
s_platforms AS (
  SELECT platform_id, {_title("platform_name")} AS platform_name, upper(trim(platform_region)) AS platform_region,
         launch_date, is_active
  FROM raw_platforms WHERE platform_id IS NOT NULL)"""

_SILVER = (
    RAW_TICKETS, RAW_EVENTS, RAW_CUSTOMERS, RAW_CHANNELS, RAW_PLATFORMS, RATES,
    TICKETS, EVENTS, CUSTOMERS, CHANNELS, PLATFORMS,
)

_BOOKED = "ticket_status = 'booked'"


def _n(status: str) -> str:
    return f"count(*) FILTER (ticket_status = '{status}')"


def _sum(condition: str = _BOOKED) -> str:
    return f"sum(CASE WHEN {condition} THEN cents ELSE 0 END)"


_AVG = _usd(_half_away(f"sum(cents) FILTER ({_BOOKED})", f"count(cents) FILTER ({_BOOKED})"))

DAILY = f"""
daily AS (
  SELECT purchase_date AS sale_date, e.event_id, e.event_name, e.event_category, e.venue_country,
         p.platform_id, p.platform_name, p.platform_region, c.channel_id, c.channel_name, c.channel_type,
         md5(concat_ws('-', purchase_date::VARCHAR, e.event_id, p.platform_id, coalesce(e.venue_country, '_null_'),
             coalesce(c.channel_id, '_null_'))) AS daily_sales_key,
         {_n("booked")} AS tickets_sold, {_n("cancelled")} AS tickets_cancelled,
         {_n("refunded")} AS tickets_refunded, count(ticket_id) AS total_ticket_events,
         {_usd(_sum())} AS revenue_usd, {_usd(_sum("ticket_status = 'refunded'"))} AS refund_value_usd,
         {_n("booked")} AS tickets_sold_by_channel, {_usd(_sum())} AS revenue_by_channel_usd,
         count(DISTINCT customer_id) AS unique_customers
  FROM tickets t JOIN s_events e ON t.event_id = e.event_id
  JOIN s_platforms p ON t.platform_source = upper(trim(p.platform_name))
  LEFT JOIN s_channels c ON t.channel_id = c.channel_id
  GROUP BY 1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 11)"""

EVENT_PERFORMANCE = f"""
event_performance AS (
  SELECT e.event_id, e.event_name, e.event_category, e.venue_name, e.venue_city, e.venue_country, e.event_date,
         e.event_capacity, e.platform_source, count(ticket_id) AS total_ticket_events,
         {_n("booked")} AS tickets_sold, {_n("cancelled")} AS tickets_cancelled, {_n("refunded")} AS tickets_refunded,
         {_usd(_sum())} AS total_revenue_usd, {_AVG} AS avg_ticket_price_usd,
         {_pct(_n("booked"), "e.event_capacity")} AS sell_through_rate_pct,
         {_pct(_n("cancelled"), "count(ticket_id)")} AS cancellation_rate_pct,
         {_pct(_n("refunded"), "count(ticket_id)")} AS refund_rate_pct,
         count(DISTINCT customer_id) AS unique_customers, count(DISTINCT channel_id) AS channel_count
  FROM s_events e LEFT JOIN tickets t ON e.event_id = t.event_id
  GROUP BY 1, 2, 3, 4, 5, 6, 7, 8, 9)"""

PREFERRED = f"""
preferred AS (
  SELECT customer_id, channel_name AS preferred_channel FROM (
    SELECT customer_id, c.channel_name,
           row_number() OVER (PARTITION BY customer_id ORDER BY count(*) DESC, c.channel_id) AS rn
    FROM tickets t JOIN s_channels c ON t.channel_id = c.channel_id
    WHERE {_BOOKED} GROUP BY customer_id, c.channel_id, c.channel_name) WHERE rn = 1)"""

CUSTOMER_BEHAVIOUR = f"""
customer_behaviour AS (
  SELECT c.customer_id, first_name, last_name, email, phone, country_of_residence, signup_date, loyalty_tier,
         c.platform_source, date_diff('day', signup_date, DATE '{AS_OF}') AS customer_tenure_days,
         count(ticket_id) AS total_ticket_events, {_n("booked")} AS total_tickets_purchased,
         {_n("cancelled")} AS total_cancellations, {_n("refunded")} AS total_refunds,
         {_usd(_sum())} AS lifetime_spend_usd, {_AVG} AS avg_spend_per_ticket_usd,
         max(purchase_date) AS last_purchase_date,
         date_diff('day', max(purchase_date), DATE '{AS_OF}') AS days_since_last_purchase,
         count(DISTINCT event_id) AS unique_events_attended, any_value(preferred_channel) AS preferred_channel
  FROM s_customers c LEFT JOIN tickets t ON c.customer_id = t.customer_id
  LEFT JOIN preferred p ON c.customer_id = p.customer_id
  GROUP BY 1, 2, 3, 4, 5, 6, 7, 8, 9)"""

REGIONAL = f"""
placed AS (
  SELECT p.platform_region, year_month, c.channel_id, c.channel_name, c.channel_type, ticket_status, cents,
         ticket_id, customer_id, t.event_id
  FROM tickets t JOIN s_events e ON t.event_id = e.event_id
  JOIN s_platforms p ON t.platform_source = upper(trim(p.platform_name))
  LEFT JOIN s_channels c ON t.channel_id = c.channel_id),
base AS (
  SELECT platform_region, year_month, {_n("booked")} AS tickets_sold, {_n("cancelled")} AS tickets_cancelled,
         {_n("refunded")} AS tickets_refunded, {_sum()} AS total,
         {_sum(_BOOKED + " AND channel_type = 'DIRECT'")} AS direct,
         {_sum(_BOOKED + " AND channel_type = 'PARTNER'")} AS partner,
         {_sum(_BOOKED + " AND channel_type = 'VENDOR'")} AS vendor,
         {_sum(_BOOKED + " AND channel_id IS NULL")} AS unattributed,
         count(DISTINCT customer_id) AS unique_customers, count(DISTINCT event_id) AS unique_events,
         count(DISTINCT channel_id) AS active_channels
  FROM placed GROUP BY 1, 2),
top AS (
  SELECT platform_region, year_month, channel_name AS top_channel_by_revenue, revenue_usd FROM (
    SELECT platform_region, year_month, channel_name, {_usd(_sum())} AS revenue_usd,
           row_number() OVER (PARTITION BY platform_region, year_month
                              ORDER BY {_sum()} DESC NULLS LAST, channel_name) AS rn
    FROM placed WHERE channel_name IS NOT NULL GROUP BY 1, 2, 3) WHERE rn = 1),
regional AS (
  SELECT b.platform_region, b.year_month, tickets_sold, tickets_cancelled, tickets_refunded,
         {_usd("total")} AS total_revenue_usd, unique_customers, unique_events, active_channels,
         top_channel_by_revenue, {_pct("direct", "total")} AS direct_revenue_pct,
         {_pct("partner", "total")} AS partner_revenue_pct, {_pct("vendor", "total")} AS vendor_revenue_pct,
         'DIRECT: ' || printf('%.1f', {_pct("direct", "total", 1)}) || '% | PARTNER: '
           || printf('%.1f', {_pct("partner", "total", 1)}) || '% | VENDOR: '
           || printf('%.1f', {_pct("vendor", "total", 1)}) || '%' AS direct_vs_partner_vs_vendor_split,
         {_pct("unattributed", "total")} AS unattributed_revenue_pct
  FROM base b LEFT JOIN top t ON b.platform_region = t.platform_region AND b.year_month = t.year_month)"""

CHANNEL_PERFORMANCE = f"""
monthly AS (
  SELECT year_month, c.channel_id, c.channel_name, c.channel_type, c.platform_id, p.platform_name,
         p.platform_region, {_n("booked")} AS total_tickets_sold, {_n("cancelled")} AS total_cancelled,
         {_n("refunded")} AS total_refunded, {_sum()} AS revenue, {_AVG} AS avg_ticket_price_usd,
         {_pct(_n("cancelled"), "count(ticket_id)")} AS cancellation_rate,
         {_pct(_n("refunded"), "count(ticket_id)")} AS refund_rate,
         count(DISTINCT customer_id) AS unique_customers, count(DISTINCT t.event_id) AS unique_events
  FROM tickets t JOIN s_channels c ON t.channel_id = c.channel_id JOIN s_events e ON t.event_id = e.event_id
  JOIN s_platforms p ON c.platform_id = p.platform_id
  GROUP BY 1, 2, 3, 4, 5, 6, 7),
channel_performance AS (
  SELECT m.* EXCLUDE (revenue), {_usd("revenue")} AS total_revenue_usd,
         {_pct("revenue", "total", 4)} AS channel_revenue_share_pct
  FROM monthly m JOIN (SELECT year_month, sum(revenue) AS total FROM monthly GROUP BY 1) USING (year_month))"""


def _with(*parts: str, select: str) -> str:
    return "WITH " + ",".join(parts) + "\n" + select


_TICKET_COLUMNS = f"""ticket_id, event_id, customer_id, channel_id, ticket_type, face_value::DOUBLE AS face_value,
  currency, {_usd("cents")} AS face_value_usd, {_time("purchase_timestamp")} AS purchase_timestamp,
  {_day("purchase_date")} AS purchase_date, ticket_status, discount_code, platform_source,
  {_time("ingested_at")} AS ingested_at, is_rate_missing"""

_RAW_TICKET_COLUMNS = f"""* REPLACE (face_value::DOUBLE AS face_value,
  {_time("purchase_timestamp")} AS purchase_timestamp, {_time("ingested_at")} AS ingested_at)"""

_SILVER_TICKETS = _with(*_SILVER, select=f"SELECT {_TICKET_COLUMNS} FROM tickets")


def _check_rows(layer: str, relation: dict[str, str], singular: bool) -> str:
    rows = []

    def add(table: str, kind: str, column: str, count: str) -> None:
        severity = "warning" if layer == "raw" and kind == "unique" else "error"
        rows.append(
            f"SELECT '{layer}' AS layer, '{table}' AS table_name, '{kind}' AS check_kind, "
            f"'{column}' AS column_name, '{severity}' AS severity, ({count})::BIGINT AS failing_rows"
        )

    for table, checks in CHECKS[layer].items():
        source = relation[table]
        for column in checks.not_null:
            add(table, "not_null", column, f"SELECT count(*) FROM {source} WHERE {column} IS NULL")
        for column, values in checks.accepted.items():
            listed = ", ".join(f"'{v}'" for v in values)
            add(table, "accepted_values", column, f"SELECT count(*) FROM {source} WHERE {column} NOT IN ({listed})")
        for column in checks.unique:
            repeated = f"SELECT {column} FROM {source} WHERE {column} IS NOT NULL GROUP BY 1 HAVING count(*) > 1"
            add(table, "unique", column, f"SELECT count(*) FROM ({repeated})")
        for column, (parent, key) in checks.parents.items():
            known = f"SELECT {key} FROM {relation[parent]} WHERE {key} IS NOT NULL"
            add(table, "relationships", column, f"SELECT count(*) FROM {source} WHERE {column} NOT IN ({known})")
    if singular and layer == "silver":
        add("tickets", "revenue_non_negative", "", f"SELECT count(*) FROM tickets WHERE {_BOOKED} AND cents < 0")
    if singular and layer == "gold":
        add("event_performance", "sell_through_within_capacity", "", f"SELECT count(*) FROM ({_OVERSOLD})")
        add("channel_performance", "shares_sum_to_100", "", f"SELECT count(*) FROM ({_OFF_SHARES})")
    return "\nUNION ALL ".join(rows)


_PERSONAL = [
    (field.name, field.metadata["comment"]) for field in RAW["customers"].fields if field.metadata["pii"]
]
_OVERSOLD = """SELECT event_id, event_name, tickets_sold, event_capacity, sell_through_rate_pct
  FROM event_performance WHERE sell_through_rate_pct > 100 AND event_capacity > 0"""
_SHARE_TOTALS = """SELECT year_month,
    CAST(sum(CAST(round(channel_revenue_share_pct * 10000) AS BIGINT)) AS DOUBLE) / 10000 AS total_share_pct
  FROM channel_performance GROUP BY 1"""
_OFF_SHARES = f"SELECT * FROM ({_SHARE_TOTALS}) WHERE total_share_pct < 99.9 OR total_share_pct > 100.1"

_RAW_NAMES = {name: f"raw_{name}" for name in CHECKS["raw"]}
_SILVER_NAMES = {name: "tickets" if name == "tickets" else f"s_{name}" for name in CHECKS["silver"]}
_GOLD_NAMES = {
    "ticket_sales_daily": "daily",
    "event_performance": "event_performance",
    "customer_behaviour": "customer_behaviour",
    "regional_summary": "regional",
    "channel_performance": "channel_performance",
}
_GOLD = (*_SILVER, DAILY, EVENT_PERFORMANCE, PREFERRED, CUSTOMER_BEHAVIOUR, REGIONAL, CHANNEL_PERFORMANCE)

_VENDOR = "channel_type = 'vendor'"
_EARLY = "launch_date < DATE '1995-06-01'"


def statements() -> dict[str, str]:
    s: dict[str, str] = {}
    s["scan_raw_tickets"] = _with(RAW_TICKETS, select=f"SELECT {_RAW_TICKET_COLUMNS} FROM raw_tickets")
    s["scan_raw_events"] = _with(
        RAW_EVENTS,
        select=f"""SELECT * REPLACE ({_day("event_date")} AS event_date, {_time("ingested_at")} AS ingested_at)
        FROM raw_events""",
    )
    s["scan_raw_customers"] = _with(
        RAW_CUSTOMERS,
        select=f"""SELECT * REPLACE ({_day("signup_date")} AS signup_date, {_time("ingested_at")} AS ingested_at)
        FROM raw_customers""",
    )
    s["scan_raw_channels"] = _with(
        RAW_CHANNELS,
        select=f"""SELECT * REPLACE ({_day("launch_date")} AS launch_date, {_time("ingested_at")} AS ingested_at)
        FROM raw_channels""",
    )
    s["scan_raw_platforms"] = _with(
        RAW_PLATFORMS, select=f"SELECT * REPLACE ({_day('launch_date')} AS launch_date) FROM raw_platforms"
    )
    s["seed_rates"] = _with(
        RAW_TICKETS,
        RATES,
        select="""SELECT u.currency, ticket_rows, face_value::DOUBLE AS face_value, rate::DOUBLE AS rate FROM (
          SELECT upper(trim(currency)) AS currency, count(*) AS ticket_rows, sum(face_value) AS face_value
          FROM raw_tickets GROUP BY 1) u LEFT JOIN rates ON u.currency = from_currency""",
    )
    s["seed_from_csv"] = _with(
        RAW_TICKETS,
        RATES,
        select="""SELECT upper(trim(currency)) AS currency, count(*) AS ticket_rows, any_value(rate)::DOUBLE AS rate
        FROM raw_tickets JOIN rates ON upper(trim(currency)) = from_currency GROUP BY 1""",
    )
    s["clean_text"] = _with(
        RAW_EVENTS,
        select=f"""SELECT event_id, {_title("venue_name")} AS title, upper(trim(venue_country)) AS upper_code,
        lower(trim(event_category)) AS lower_code, upper(trim(platform_source)) || '/' || trim(event_name) AS joined
        FROM raw_events""",
    )
    s["cast_types"] = f"""SELECT CAST(CAST(l_orderkey AS VARCHAR) AS BIGINT) AS whole,
        strftime(l_shipdate, '%Y-%m-%d') AS day, {_time("l_shipdate")} AS instant,
        strftime(l_shipdate, '%Y-%m-%d') AS day_of_instant,
        CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS DOUBLE) AS price, l_returnflag = 'N' AS flag,
        TRY_CAST(l_linestatus AS BIGINT) AS not_a_number FROM lineitem"""
    s["date_parts"] = _with(
        RAW_CHANNELS,
        select=f"""SELECT channel_id, strftime(launch_date, '%Y-%m') AS launch_month,
        date_diff('day', launch_date, DATE '{AS_OF}') AS age_days FROM raw_channels""",
    )
    s["surrogate_keys"] = _with(
        RAW_TICKETS,
        select=f"""SELECT ticket_id, {_time("ingested_at")} AS ingested_at,
        md5(ticket_id || '-' || coalesce(currency, '_null_') || '-' || coalesce(discount_code, '_null_') || '-'
            || CAST(CAST(purchase_timestamp AS DATE) AS VARCHAR)) AS version_key FROM raw_tickets""",
    )
    s["dedup_latest"] = _with(
        RAW_TICKETS, NEWEST_TICKETS, select=f"SELECT {_RAW_TICKET_COLUMNS} FROM newest_tickets"
    )
    s["dedup_any"] = _with(
        RAW_TICKETS,
        select="""SELECT customer_id, platform_source, ticket_type FROM (
        SELECT *, row_number() OVER (PARTITION BY customer_id
          ORDER BY platform_source NULLS FIRST, ticket_type NULLS FIRST) AS rn FROM raw_tickets) WHERE rn = 1""",
    )
    s["currency_normalise"] = _with(
        RAW_TICKETS,
        RATES,
        select=f"""SELECT ticket_id, {_time("ingested_at")} AS ingested_at, upper(trim(currency)) AS currency,
        face_value::DOUBLE AS face_value, {_usd(f"CAST({_CONVERTED} * 100 AS BIGINT)")} AS face_value_usd,
        rate IS NULL AS is_rate_missing
        FROM raw_tickets LEFT JOIN rates ON upper(trim(currency)) = from_currency""",
    )
    s["silver_events"] = _with(
        RAW_EVENTS,
        EVENTS,
        select=f"""SELECT * REPLACE ({_day("event_date")} AS event_date, {_time("ingested_at")} AS ingested_at)
        FROM s_events""",
    )
    s["selected_events_view"] = _with(
        RAW_EVENTS,
        EVENTS,
        select=f"""SELECT event_id, event_name, event_capacity, {_time(f"TIMESTAMP '{RUN_TS}'")} AS _loaded_at
        FROM s_events""",
    )
    s["silver_customers"] = _with(
        RAW_CUSTOMERS,
        CUSTOMERS,
        select=f"""SELECT * REPLACE ({_day("signup_date")} AS signup_date, {_time("ingested_at")} AS ingested_at)
        FROM s_customers""",
    )
    s["silver_channels"] = _with(
        RAW_CHANNELS,
        CHANNELS,
        select=f"""SELECT * REPLACE ({_day("launch_date")} AS launch_date, {_time("ingested_at")} AS ingested_at)
        FROM s_channels""",
    )
    s["silver_platforms"] = _with(
        RAW_PLATFORMS,
        PLATFORMS,
        select=f"SELECT * REPLACE ({_day('launch_date')} AS launch_date) FROM s_platforms",
    )
    s["silver_tickets"] = _SILVER_TICKETS
    s["upsert_latest"] = _SILVER_TICKETS
    s["stream_upsert_tickets"] = _SILVER_TICKETS
    s["tickets_of_open_channels"] = _with(
        *_SILVER,
        select=f"""SELECT ticket_id, channel_id, {_usd("cents")} AS face_value_usd FROM tickets
        WHERE channel_id IN (SELECT channel_id FROM s_channels)""",
    )
    s["tickets_with_channel"] = _with(
        *_SILVER,
        select="""SELECT ticket_id, t.channel_id, channel_name FROM tickets t
        LEFT JOIN s_channels c ON t.channel_id = c.channel_id""",
    )
    s["status_measures"] = _with(
        *_SILVER,
        select=f"""SELECT platform_source, year_month, count(*) AS total, {_n("booked")} AS booked,
        {_n("cancelled")} AS cancelled, {_n("refunded")} AS refunded, {_usd(_sum())} AS revenue_usd,
        {_usd(_sum("ticket_status = 'refunded'"))} AS refund_value_usd, {_AVG} AS avg_price_usd,
        {_pct(_n("cancelled"), "count(*)")} AS cancellation_rate_pct,
        {_day("max(purchase_date)")} AS last_purchase_date FROM tickets GROUP BY 1, 2""",
    )
    s["distinct_reach"] = _with(
        *_SILVER,
        select="""SELECT platform_source, count(DISTINCT customer_id) AS unique_customers,
        count(DISTINCT event_id) AS unique_events, count(DISTINCT channel_id) AS unique_channels
        FROM tickets GROUP BY 1""",
    )
    s["revenue_share"] = _with(
        *_SILVER,
        select=f"""SELECT year_month, channel_id, {_usd("revenue")} AS revenue_usd,
        {_pct("revenue", "sum(revenue) OVER (PARTITION BY year_month)", 4)} AS share_pct
        FROM (SELECT year_month, channel_id, {_sum()} AS revenue FROM tickets GROUP BY 1, 2)""",
    )
    s["top_events"] = _with(
        *_SILVER,
        select=f"""SELECT platform_source, event_id, revenue_usd FROM (
        SELECT platform_source, event_id, {_usd(_sum())} AS revenue_usd,
          row_number() OVER (PARTITION BY platform_source ORDER BY {_sum()} DESC NULLS LAST, event_id) AS rn
        FROM tickets GROUP BY 1, 2) WHERE rn <= 3""",
    )
    s["usual_currency"] = _with(
        *_SILVER,
        select="""SELECT customer_id, currency, frequency FROM (
        SELECT customer_id, currency, count(*) AS frequency,
          row_number() OVER (PARTITION BY customer_id ORDER BY count(*) DESC, currency) AS rn
        FROM tickets WHERE currency IS NOT NULL GROUP BY 1, 2) WHERE rn = 1""",
    )
    s["preferred_channel"] = _with(*_SILVER, PREFERRED, select="SELECT * FROM preferred")
    s["top_channel"] = _with(*_SILVER, REGIONAL, select="SELECT * FROM top")
    s["type_split"] = _with(
        *_SILVER,
        REGIONAL,
        select="""SELECT platform_region, year_month, direct_revenue_pct, partner_revenue_pct, vendor_revenue_pct,
        unattributed_revenue_pct, direct_vs_partner_vs_vendor_split FROM regional""",
    )
    s["gold_ticket_sales_daily"] = _with(
        *_SILVER, DAILY, select=f"SELECT * REPLACE ({_day('sale_date')} AS sale_date) FROM daily"
    )
    s["sink_daily"] = s["gold_ticket_sales_daily"]
    s["gold_event_performance"] = _with(
        *_SILVER,
        EVENT_PERFORMANCE,
        select=f"SELECT * REPLACE ({_day('event_date')} AS event_date) FROM event_performance",
    )
    s["gold_customer_behaviour"] = _with(
        *_SILVER,
        PREFERRED,
        CUSTOMER_BEHAVIOUR,
        select=f"""SELECT * REPLACE ({_day("signup_date")} AS signup_date,
        {_day("last_purchase_date")} AS last_purchase_date) FROM customer_behaviour""",
    )
    s["gold_regional_summary"] = _with(*_SILVER, REGIONAL, select="SELECT * FROM regional")
    s["gold_channel_performance"] = _with(
        *_SILVER, CHANNEL_PERFORMANCE, select="SELECT * FROM channel_performance"
    )
    s["check_not_null"] = _with(
        RAW_TICKETS,
        select=f"""SELECT ticket_id, {_time("ingested_at")} AS ingested_at, channel_id FROM raw_tickets
        WHERE currency IS NULL""",
    )
    s["check_required"] = _with(
        RAW_TICKETS,
        select=f"""SELECT ticket_id, {_time("ingested_at")} AS ingested_at FROM raw_tickets
        WHERE ticket_id IS NULL OR event_id IS NULL OR customer_id IS NULL OR purchase_timestamp IS NULL
          OR ticket_status IS NULL OR channel_id IS NULL OR ingested_at IS NULL""",
    )
    s["check_required_loss"] = _with(
        RAW_TICKETS,
        select=f"""SELECT ticket_id, {_time("ingested_at")} AS ingested_at FROM raw_tickets
        WHERE purchase_timestamp::DATE = last_day(purchase_timestamp::DATE)""",
    )
    s["check_unique"] = _with(
        RAW_TICKETS,
        select="SELECT ticket_id, count(*) AS row_count FROM raw_tickets GROUP BY 1 HAVING count(*) > 1",
    )
    s["check_accepted_values"] = _with(
        RAW_TICKETS,
        select=f"""SELECT ticket_id, {_time("ingested_at")} AS ingested_at, ticket_status FROM raw_tickets
        WHERE ticket_status NOT IN ('booked', 'cancelled', 'refunded')""",
    )
    s["check_relationships"] = _with(
        *_SILVER,
        select="""SELECT ticket_id, channel_id FROM tickets
        WHERE channel_id NOT IN (SELECT channel_id FROM s_channels)""",
    )
    s["assert_revenue_non_negative"] = _with(
        *_SILVER,
        select=f"""SELECT ticket_id, {_usd("cents")} AS face_value_usd, ticket_status,
        {_day("purchase_date")} AS purchase_date FROM tickets WHERE {_BOOKED} AND cents < 0""",
    )
    s["assert_sell_through_rate"] = _with(*_SILVER, EVENT_PERFORMANCE, select=_OVERSOLD)
    s["assert_channel_revenue_share_sums_to_100"] = _with(*_SILVER, CHANNEL_PERFORMANCE, select=_OFF_SHARES)
    s["assert_shares_of_a_short_report"] = _with(
        *_SILVER,
        CHANNEL_PERFORMANCE,
        select=_OFF_SHARES.replace("FROM channel_performance", "FROM channel_performance WHERE channel_type <> 'DIRECT'"),
    )
    s["monthly_share_totals"] = _with(*_SILVER, CHANNEL_PERFORMANCE, select=_SHARE_TOTALS)
    s["check_report_raw"] = _with(
        RAW_TICKETS, RAW_EVENTS, RAW_CUSTOMERS, RAW_CHANNELS, RAW_PLATFORMS,
        select=_check_rows("raw", _RAW_NAMES, False),
    )
    s["pipeline_check_report"] = _with(
        *_GOLD,
        select="\nUNION ALL ".join(
            (
                _check_rows("raw", _RAW_NAMES, False),
                _check_rows("silver", _SILVER_NAMES, True),
                _check_rows("gold", _GOLD_NAMES, True),
            )
        ),
    )
    s["incremental_lookback"] = _with(
        RAW_TICKETS,
        select=f"""SELECT {_RAW_TICKET_COLUMNS} FROM raw_tickets
        WHERE ingested_at >= (SELECT max(ingested_at) FROM raw_tickets) - INTERVAL 3 DAY""",
    )
    s["merge_plain"] = _with(
        RAW_CHANNELS,
        CHANNELS,
        select=f"""SELECT c.* REPLACE ({_day("c.launch_date")} AS launch_date, {_time("c.ingested_at")} AS ingested_at,
        CASE WHEN c.{_EARLY} AND r.channel_type <> 'vendor' THEN c.channel_age_days
             ELSE date_diff('day', c.launch_date, DATE '2002-02-01') END AS channel_age_days)
        FROM s_channels c JOIN raw_channels r ON c.channel_id = r.channel_id""",
    )
    s["landing_lookback"] = _with(
        RAW_CUSTOMERS,
        select=f"""SELECT * REPLACE ({_day("signup_date")} AS signup_date, {_time("ingested_at")} AS ingested_at)
        FROM raw_customers WHERE ingested_at >= (SELECT max(ingested_at) FROM raw_customers) - INTERVAL 3 DAY""",
    )
    s["approximate_reach"] = _with(
        *_SILVER,
        select="""SELECT platform_region, strftime(purchase_date, '%Y-%m') AS year_month,
        count(DISTINCT customer_id) AS customers, true AS is_close
        FROM tickets JOIN s_events USING (event_id) JOIN s_platforms ON upper(platform_name) = tickets.platform_source
        GROUP BY 1, 2""",
    )
    s["personal_data"] = _with(
        RAW_CUSTOMERS,
        CUSTOMERS,
        select="\nUNION ALL ".join(
            f"SELECT '{name}' AS column_name, '{note}' AS note, count({name}) AS filled FROM s_customers"
            for name, note in _PERSONAL
        ),
    )
    s["stream_dedup_replays"] = "SELECT event_id, user_id, event_type, value FROM events"
    s["stream_dedup"] = "SELECT event_id, user_id, event_type, value FROM events"
    return s
