"""Shape of the physical plans."""

import pytest

from boxoffice import queries
from boxoffice.functions.dates import as_day
from boxoffice.plans import gold
from boxoffice.plans.build import gold_tables, run, stored
from boxoffice.sources.star_schema import raw_from_star
from boxoffice.sources.store import LayerStore
from conftest import SF


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def plans(spark):
    names = [
        "silver_tickets",
        "gold_ticket_sales_daily",
        "gold_event_performance",
        "gold_customer_behaviour",
        "gold_regional_summary",
        "gold_channel_performance",
    ]
    return {name: plan_of(queries.registered()[name](spark, SF)) for name in names}


def test_no_python_and_no_cartesian_product(plans):
    for name, plan in plans.items():
        for node in ("PythonUDF", "EvalPython", "InPandas", "CartesianProduct", "NestedLoopJoin"):
            assert node not in plan, (name, node)


def test_dedup_limits_groups_before_the_shuffle(plans):
    assert plans["silver_tickets"].count("WindowGroupLimit [ticket_id") == 2


def test_rates_are_broadcast(plans):
    assert "BroadcastHashJoin [currency" in plans["silver_tickets"]


def test_existence_of_events_is_a_semi_join(plans):
    assert "LeftSemi" in plans["gold_channel_performance"]
    assert "LeftSemi" in plans["gold_regional_summary"]


@pytest.fixture(scope="module")
def stored_plans(spark, tmp_path_factory):
    """Gold plans over stored silver tables, as a build sees them."""
    base = str(tmp_path_factory.mktemp("lake"))
    run(spark, raw_from_star(spark, SF), base, "2002-01-01", "2002-01-01T00:00:00", layers=("seeds", "silver"))
    tables = gold_tables(stored(LayerStore(spark, base), "silver"), as_day("2002-01-01"))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        names = ("event_performance", "customer_behaviour", "regional_summary", "channel_performance", "ticket_sales_daily")
        return {name: plan_of(tables[name]) for name in names}
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_gold_tables_read_tickets_once(stored_plans):
    scans = {name: sum("FileScan" in line and "/silver/tickets/" in line for line in plan.splitlines()) for name, plan in stored_plans.items()}
    assert scans.pop("regional_summary") == 2
    assert set(scans.values()) == {1}


def test_tickets_are_not_copied_for_distinct_counts(stored_plans):
    """Where rows are multiplied for distinct counts, they have been rolled up before."""
    for name, plan in stored_plans.items():
        lines = plan.splitlines()
        for at, line in enumerate(lines):
            if "Expand" in line:
                below = "\n".join(lines[at + 1 :])
                assert "Aggregate" in below[: below.index("FileScan")], name
    assert "Expand" not in stored_plans["customer_behaviour"]


def test_the_share_of_a_month_is_not_computed_twice(stored_plans):
    assert "Window" in stored_plans["channel_performance"]


def test_scans_read_only_needed_columns(spark):
    plan = plan_of(queries.registered()["distinct_reach"](spark, SF))
    assert "c_name" not in plan
    scan = plan_of(queries.registered()["check_not_null"](spark, SF))
    schema = scan.split("ReadSchema: ")[1]
    assert "l_extendedprice" not in schema.split("\n")[0]


def test_lookback_reaches_the_scan(spark):
    plan = plan_of(queries.incremental_lookback(spark, SF))
    assert "GreaterThanOrEqual(l_shipdate" in plan


def test_daily_table_is_aggregated_before_descriptions_are_joined(spark):
    silver = queries._silver(spark, SF)
    plan = gold.ticket_sales_daily(silver)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("event_name") < plan.index("Aggregate")


def test_distinct_counts_do_not_multiply_rows(stored_plans):
    for name in ("event_performance", "channel_performance", "regional_summary"):
        assert "Expand" not in stored_plans[name], name
