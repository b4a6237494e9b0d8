"""What files, folders and shuffles a plan touches, and streams that remember on disk."""

import datetime as dt
import glob

import pytest
from pyspark.sql import functions as F

from boxoffice.functions.keys import surrogate_key
from boxoffice.operators import joins
from boxoffice.operators.cluster import clustered
from boxoffice.operators.merge import high_water_mark, lookback
from boxoffice.operators.ranking import top_k_per_group
from boxoffice.operators.sketch import distinct_sketches, merged_sketches
from boxoffice.schemas import RAW
from boxoffice.sources.raw import land, read_raw
from boxoffice.sources.store import LayerStore
from boxoffice.streaming.streams import dedup_replays, dedup_within, file_stream, read_deduplicated
from conftest import at, frame, raw_tables, rows_of, ticket


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def plain(spark):
    """No broadcasts that nobody asked for, and plans as they are written."""
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    before = {name: spark.conf.get(name) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    yield
    for name, value in before.items():
        spark.conf.set(name, value)


def test_landing_is_read_by_day(spark, tmp_path):
    folder = str(tmp_path)
    rows = [ticket(f"t{i}", ingested_at=at(1 + i % 20, i % 24)) for i in range(100)]
    land(frame(spark, "tickets", rows[:50]), folder, "tickets")
    land(frame(spark, "tickets", rows[50:]), folder, "tickets")
    for name in ("events", "customers", "channels", "platforms"):
        land(raw_tables(spark)[name], folder, name)
    raw = read_raw(spark, folder)
    assert raw.tickets.count() == 100 and raw.platforms.columns == RAW["platforms"].names
    assert len(glob.glob(f"{folder}/tickets/ingest_day=*")) == 20
    recent = lookback(raw.tickets, "ingested_at", high_water_mark(raw.tickets, "ingested_at"))
    expected = [r["ticket_id"] for r in rows if r["ingested_at"] >= max(x["ingested_at"] for x in rows) - dt.timedelta(days=3)]
    assert rows_of(recent, "ticket_id") == sorted((t,) for t in expected)
    scan = next(line for line in plan_of(recent).splitlines() if "PartitionFilters" in line)
    assert "(ingest_day" in scan.split("PartitionFilters")[1].split("PushedFilters")[0]
    assert "GreaterThanOrEqual(ingested_at" in scan
    days = {row[0].split("ingest_day=")[1][:10] for row in recent.select(F.input_file_name()).collect()}
    assert days <= {f"2024-01-{day}" for day in (17, 18, 19, 20)}


def test_files_of_a_clustered_table_are_skipped_by_any_column(spark, tmp_path):
    pq = pytest.importorskip("pyarrow.parquet")
    store = LayerStore(spark, str(tmp_path))
    # One combination holds a third of all rows.
    hot = F.col("id") % 3 == 0
    df = spark.range(300_000).select(
        "id",
        F.when(hot, "m").otherwise(F.chr(97 + F.pmod(F.xxhash64("id"), F.lit(26)))).alias("kind"),
        F.when(hot, 500).otherwise(F.pmod(F.xxhash64("id", F.lit(1)), F.lit(1000))).alias("amount"),
        F.rand(1).alias("x"),
    )
    settings = {"spark.sql.shuffle.partitions": "32", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {name: spark.conf.get(name) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        store.replace(df, "gold", "t", cluster_by=["kind", "amount"])
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
    files = glob.glob(f"{store.location('gold', 't')}/*.parquet")
    assert len(files) >= 16
    bounds = []
    for file in files:
        group = pq.read_metadata(file).row_group(0)
        found = {group.column(i).path_in_schema: group.column(i).statistics for i in range(group.num_columns)}
        bounds.append({name: (found[name].min, found[name].max) for name in ("kind", "amount")})
    for name, value in (("kind", "c"), ("kind", "x"), ("amount", 77), ("amount", 900)):
        assert sum(low <= value <= high for low, high in (b[name] for b in bounds)) <= len(files) // 2, name
    # The hot combination is in several files.
    assert sum(b["kind"][0] <= "m" <= b["kind"][1] and b["amount"][0] <= 500 <= b["amount"][1] for b in bounds) > 4
    assert store.read("gold", "t").count() == 300_000
    assert not glob.glob(f"{store.root('gold', 't')}/pending-*")


def test_clustering_of_nulls_other_types_and_no_rows(spark):
    rows = [(None, None, None, True), ("a", dt.date(2024, 1, 1), at(1), None), ("é", dt.date(2023, 1, 1), at(2), False)]
    df = spark.createDataFrame(rows * 5, "s string, d date, t timestamp, b boolean")
    assert rows_of(clustered(df, ["s", "d", "t", "b"])) == rows_of(df)
    assert clustered(df.limit(0), ["s", "d"]).count() == 0


def test_a_hot_key_is_spread_by_its_count(spark, plain):
    facts = spark.range(9000).select("id", F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 4000)).alias("k"))
    table = facts.select("k").distinct().withColumn("name", F.upper("k"))
    found = joins.lookup(facts, joins.dimension(table, 0), "k", "inner")
    assert found.count() == 9000 and found.where("name <> upper(k)").count() == 0
    plan = plan_of(found)
    assert "hashpartitioning(k#" in plan and "__salt" in plan.split("hashpartitioning(k#")[1][:60]
    assert "approx_top_k" in plan
    spread = joins.frequent_keys(facts, "k", 4).collect()
    # 3,000 of 9,000 rows; an even share is 2,250 and a sub-key holds half of one.
    assert [(r[0], r[1]) for r in spread] == [("hot", 3)]
    left = joins.lookup(facts.withColumn("k", F.when(F.col("k") != "k1", F.col("k"))), joins.dimension(table, 0), "k", "left")
    assert left.count() == 9000 and left.where("name is null").count() == facts.where("k = 'k1'").count()


def test_broadcasts_are_measured_in_bytes(spark):
    wide = spark.range(100).select("id", F.repeat(F.lit("x"), 1000).alias("t"))
    assert 100_000 < joins.bytes_of(wide) < 110_000
    assert joins.dimension(wide, 50_000).small is False and joins.dimension(wide.select("id"), 50_000).small
    assert joins.bytes_of(wide.limit(0)) == 0


def test_more_than_a_thousand_rows_of_a_group(spark):
    df = spark.range(5000).select(F.lit("g").alias("g"), "id", F.pmod(F.xxhash64("id"), F.lit(10_000)).alias("v"))
    order = [F.desc("v"), F.asc("id")]
    mine = rows_of(top_k_per_group(df, ["g"], order, 1500), "id")
    assert mine == sorted(((r["id"],) for r in df.orderBy(*order).limit(1500).collect()), key=str)


def test_sketches_merge_to_the_count_of_the_union(spark):
    df = spark.range(60_000).select((F.col("id") % 30).alias("day"), (F.col("id") % 20_000).alias("who"))
    merged = merged_sketches(distinct_sketches(df, ["day"], "who").withColumn("month", F.floor(F.col("day") / 15)), ["month"])
    found = {r.month: r.estimate for r in merged.collect()}
    exact = {r[0]: r[1] for r in df.groupBy(F.floor(F.col("day") / 15)).agg(F.count_distinct("who")).collect()}
    assert all(abs(found[m] - exact[m]) <= 0.065 * exact[m] for m in exact)
    nulls = spark.createDataFrame([(1, None)], "day int, who string")
    assert merged_sketches(distinct_sketches(nulls, ["day"], "who"), ["day"]).first()["estimate"] == 0


def test_replays_are_dropped_at_any_age_without_a_state(spark, tmp_path):
    landing, out, log = (str(tmp_path / name) for name in ("landing", "out", "log"))

    def drain(*batches):
        for batch in batches:
            frame(spark, "tickets", list(batch)).coalesce(1).write.mode("append").parquet(landing)
        stream = file_stream(spark, landing, RAW["tickets"], 1)
        query = dedup_replays(stream, out, ["ticket_id"], "ingested_at", log)
        query.awaitTermination()
        assert not any(p.stateOperators for p in query.recentProgress)
        return [name for name, in rows_of(read_deduplicated(spark, out), "ticket_id")]

    one, two, late = ticket("a", ingested_at=at(1)), ticket("b", ingested_at=at(20)), ticket("c", ingested_at=at(2))
    assert drain([one, one], [two]) == ["a", "b"]
    # A first record that is 18 days late is kept, a repeat 19 days late is dropped.
    found = drain([late, one], [two, late, ticket("d", ingested_at=at(21))], [ticket(None, ingested_at=at(3))] * 2)
    assert found == ["a", "b", "c", "d", None]
    # Only the folders of a batch's days are read, and a repeated batch replaces its own.
    assert len(glob.glob(f"{out}/batch=*/arrival_day=*")) == 5


def test_a_batch_that_is_repeated_after_a_failure_adds_nothing(spark, tmp_path):
    landing, out, log = (str(tmp_path / name) for name in ("landing", "out", "log"))
    frame(spark, "tickets", [ticket("a"), ticket("b")]).coalesce(1).write.parquet(landing)

    def drain():
        dedup_replays(file_stream(spark, landing, RAW["tickets"], 1), out, ["ticket_id"], "ingested_at", log).awaitTermination()

    drain()
    for commit in glob.glob(f"{log}/commits/*"):  # as if the stream had stopped before it noted the batch
        (tmp_path / "log" / "commits" / commit.rpartition("/")[2]).unlink()
    for commit in glob.glob(f"{log}/commits/.*.crc"):
        (tmp_path / "log" / "commits" / commit.rpartition("/")[2]).unlink()
    drain()
    assert rows_of(read_deduplicated(spark, out), "ticket_id") == [("a",), ("b",)]


def test_dedup_within_forgets_after_the_delay(spark, tmp_path):
    landing, out, log = (str(tmp_path / name) for name in ("landing", "out", "log"))

    def drain(*rows):
        frame(spark, "tickets", list(rows)).coalesce(1).write.mode("append").parquet(landing)
        stream = dedup_within(file_stream(spark, landing, RAW["tickets"], 1), ["ticket_id"], "ingested_at")
        query = stream.writeStream.format("parquet").option("checkpointLocation", log)
        query.trigger(availableNow=True).start(out).awaitTermination()

    drain(ticket("a", ingested_at=at(1)), ticket("a", ingested_at=at(1)))
    drain(ticket("a", ingested_at=at(2)), ticket("b", ingested_at=at(20)))
    drain(ticket("c", ingested_at=at(3)))  # later than the delay: dropped, as documented
    assert rows_of(spark.read.parquet(out), "ticket_id") == [("a",), ("b",)]


def test_the_null_of_a_key_can_be_chosen(spark):
    df = spark.createDataFrame([("x", None)], "a string, b string")
    one, two = df.select(surrogate_key(F.col("a"), F.col("b")), surrogate_key(F.col("a"), F.col("b"), null="")).first()
    other = df.select(F.md5(F.lit("x-_null_")), F.md5(F.lit("x-"))).first()
    assert (one, two) == tuple(other)
