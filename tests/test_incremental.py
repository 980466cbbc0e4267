"""Runs that follow what was delivered: touched dates, stream metrics, refreshes, generations, file layouts."""

import json
import random
from bisect import bisect_right
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from headway import schemas
from headway.operators.quality import not_null
from headway.plans import workflow
from headway.plans.workflow import Workflow, run_all
from headway.sources import feeds, layout
from headway.sources.feeds import headers_of, read_schedule_by_header, write_schedule_snapshots
from headway.streaming import observed, runs
from headway.streaming.changeflow import ChangeFlow, start_scd2
from headway.streaming.ingest import checkpoint_path, generations_path, read_bronze, start_ingest, start_ingest_by_header
from tests.test_streams import put, routes_file
from tests.test_workflow import deliver

RESULTS = (
    "gold_route_delay_patterns",
    "gold_congestion_patterns",
    "gold_corridor_daily_summary",
    "gold_schedule_vs_actual",
)


def poll(landing, name, day, seconds, hours=(8,), corridors=3):
    lines = [
        {
            "corridor_id": f"corridor_{i}",
            "corridor_name": f"Corridor {i}",
            "duration_seconds": seconds + i,
            "static_duration_seconds": 88,
            "distance_meters": 1232,
            "congestion_ratio": 1.0 + (seconds + i) / 1000,
            "api_response_json": json.dumps({"status": "OK"}),
            "polled_at": f"{day}T{hour:02d}:00:00",
        }
        for i in range(corridors)
        for hour in hours
    ]
    put(landing / f"{name}.json", "\n".join(map(json.dumps, lines)) + "\n")


def flow_at(tmp_path, schema, name="flow", **options):
    root = tmp_path / name
    return Workflow(str(tmp_path / "schedule"), str(root / "traffic"), str(root / "storage"), schema, str(root / "tables"), **options)


def results(spark, schema, rows):
    return {name: rows(spark.table(f"{schema}_physical.{name}")) for name in RESULTS}


def files_of(tmp_path, table):
    """File names of every date folder of a table."""
    folders = [p for p in Path(tmp_path).glob(f"flow/tables/*/{table}/*=*")]
    return {(p.parent.parent.name, p.name): sorted(f.name for f in p.glob("*.parquet")) for p in folders}


def test_two_deliveries_equal_one_and_untouched_dates_keep_their_files(spark, tmp_path, schema_name, rows):
    deliver(tmp_path / "schedule", "2026-03-08", "First")
    flow, once = flow_at(tmp_path, schema_name), flow_at(tmp_path, f"{schema_name}_once", "once")
    for target in (flow, once):
        for day in (23, 24, 25):
            poll(Path(target.traffic_landing), f"a{day}", f"2026-03-{day}", 300 + day)
    run_all(spark, flow)
    stored = {"silver_traffic_readings", "silver_congestion_state", "silver_delay_state", "gold_corridor_daily_summary", "gold_schedule_vs_actual"}
    before = {table: files_of(tmp_path, table) for table in stored}
    assert all(len(found) >= 3 for found in before.values())

    for target in (flow, once):  # a new date, and late readings of an old one: another hour, and a second arrival of a known time
        poll(Path(target.traffic_landing), "b26", "2026-03-26", 400)
        poll(Path(target.traffic_landing), "b24", "2026-03-24", 500, hours=(9,))
        poll(Path(target.traffic_landing), "c24", "2026-03-24", 600, hours=(8,), corridors=1)
    run_all(spark, flow)
    after = {table: files_of(tmp_path, table) for table in stored}
    for table in stored:
        changed = {folder for folder, names in after[table].items() if before[table].get(folder) != names}
        assert {name.split("=")[1] for _, name in changed} == {"2026-03-24", "2026-03-26"}

    run_all(spark, once)
    assert results(spark, schema_name, rows) == results(spark, once.schema, rows)


def test_a_run_that_failed_does_its_dates_again(spark, tmp_path, schema_name, rows, monkeypatch):
    deliver(tmp_path / "schedule", "2026-03-08", "First")
    flow, once = flow_at(tmp_path, schema_name), flow_at(tmp_path, f"{schema_name}_once", "once")
    poll(Path(flow.traffic_landing), "a", "2026-03-23", 300)
    run_all(spark, flow)
    poll(Path(flow.traffic_landing), "b", "2026-03-24", 400)

    def broken(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as patched:
        patched.setattr(workflow, "compare_with_schedule", broken)
        with pytest.raises(RuntimeError, match="lost"):
            run_all(spark, flow)
    run_all(spark, flow)
    for name, day, seconds in (("a", 23, 300), ("b", 24, 400)):
        poll(Path(once.traffic_landing), name, f"2026-03-{day}", seconds)
    run_all(spark, once)
    assert results(spark, schema_name, rows) == results(spark, once.schema, rows)
    generation, batch, _ = runs.last_progress(spark, f"{flow.storage}/_progress", "analyses")
    assert (generation, batch) == (0, 1)


def test_a_full_refresh_builds_from_the_delivered_files(spark, tmp_path, schema_name, rows):
    deliver(tmp_path / "schedule", "2026-03-08", "First")
    deliver(tmp_path / "schedule", "2026-03-15", "Second name")
    flow = flow_at(tmp_path, schema_name)
    for day in (23, 24):
        poll(Path(flow.traffic_landing), f"a{day}", f"2026-03-{day}", 300 + day)
    run_all(spark, flow)
    first = results(spark, schema_name, rows)
    run_all(spark, flow_at(tmp_path, schema_name, full_refresh=True))
    assert results(spark, schema_name, rows) == first

    (Path(flow.traffic_landing) / "a24.json").unlink()
    for name in ("routes.txt", "stops.txt", "trips.txt", "stop_times.txt"):
        (tmp_path / "schedule/2026-03-15" / name).unlink()
    run_all(spark, flow_at(tmp_path, schema_name, full_refresh=True))
    assert spark.table(f"{schema_name}.bronze_traffic_api").count() == 3
    assert rows(spark.table(f"{schema_name}.silver_gtfs_stops"), "stop_name", "__END_AT") == [("First", None), ("Second", None)]
    assert rows(spark.table(f"{schema_name}_physical.gold_corridor_daily_summary"), "report_date")[0][0].day == 23
    # A later plain run goes on from the refreshed state.
    poll(Path(flow.traffic_landing), "a25", "2026-03-25", 325)
    run_all(spark, flow)
    assert spark.table(f"{schema_name}_physical.gold_corridor_daily_summary").count() == 6


@pytest.mark.parametrize("by_header", [False, True])
def test_a_run_stores_dropped_rows_and_failed_casts(spark, tmp_path, schema_name, by_header):
    schedule = tmp_path / "schedule"
    deliver(schedule, "2026-03-08", "First")
    put(schedule / "2026-03-15/routes.txt", routes_file("009,AG,9,E,,tram?,,,", ",AG,9,E,,3,,,", "010,AG,9,E,,x,,,"))
    flow = flow_at(tmp_path, schema_name, match_by_header=by_header)
    put(Path(flow.traffic_landing) / "a.json", '{"corridor_id":"c","duration_seconds":"soon","polled_at":"2026-03-22T05:00:00"}\nnot json\n')
    run_all(spark, flow)
    run_all(spark, flow)
    found = {(r.observation, r.metric): r.value for r in observed.totals(observed.read_metrics(spark, flow.metrics)).collect()}
    assert found["expectations:silver_gtfs_routes", "rows_in"] == 4
    assert found["expectations:silver_gtfs_routes", "dropped_route_id_not_null"] == 1
    assert found["expectations:silver_gtfs_stops", "dropped_stop_id_not_null"] == 0
    assert found["casts:bronze_gtfs_routes", "failed_route_type"] == 2
    assert found["casts:bronze_traffic_api", "failed_duration_seconds"] == 1
    assert found["casts:bronze_traffic_api", "failed_distance_meters"] == 0
    assert found["casts:bronze_traffic_api", "unreadable"] == 1


def test_the_last_report_of_a_batch_counts(spark, tmp_path, rows):
    lines = [("q", 0, "2026-01-01", "o", "m", 5), ("q", 0, "2026-01-02", "o", "m", 7), ("q", 1, "2026-01-01", "o", "m", 1), ("p", 0, "2026-01-01", "o", "m", 10)]
    spark.createDataFrame(lines, observed.METRICS_DDL).write.parquet(str(tmp_path / "m"))
    assert rows(observed.totals(observed.read_metrics(spark, str(tmp_path / "m")))) == [("o", "m", 18)]


def test_drops_of_a_late_batch_are_counted_once(spark, tmp_path):
    """The type 2 flow uses a batch several times; its rows are counted once."""
    ddl = "k STRING, q INT, v STRING"
    flow = ChangeFlow(str(tmp_path / "target"), ("k",), "q", ("q",), not_null("k"))
    metrics = observed.MetricsCollector(str(tmp_path / "metrics"))
    spark.streams.addListener(metrics)
    try:
        for rows_in in ([("a", 5, "A"), (None, 1, "x")], [("a", 3, "B"), (None, 2, "x"), (None, 3, "y"), ("b", 1, "C")]):
            spark.createDataFrame(rows_in, ddl).coalesce(1).write.mode("append").parquet(str(tmp_path / "feed"))
            stream = spark.readStream.schema(ddl).parquet(str(tmp_path / "feed"))
            query = start_scd2(flow, stream, lambda s: s.read.schema(ddl).parquet(str(tmp_path / "feed")), str(tmp_path / "cp"))
            query.awaitTermination()
            metrics.store(spark, [query])
    finally:
        spark.streams.removeListener(metrics)
    found = {r.metric: r.value for r in observed.totals(observed.read_metrics(spark, str(tmp_path / "metrics"))).collect()}
    assert found == {"rows_in": 6, "dropped_k_not_null": 3}


def test_a_new_checkpoint_is_a_generation_of_its_own(spark, tmp_path, rows):
    landing, bronze = tmp_path / "landing", tmp_path / "bronze"
    put(landing / "2026-03-08/routes.txt", "route_type,route_id\n3,009\n")
    start_ingest_by_header(spark, schemas.ROUTES, str(landing), str(bronze)).awaitTermination()
    Path(checkpoint_path(str(bronze), schemas.ROUTES)).rename(tmp_path / "old-checkpoint")
    put(landing / "2026-03-15/routes.txt", "route_id,route_type\n010,2\n")
    start_ingest_by_header(spark, schemas.ROUTES, str(landing), str(bronze)).awaitTermination()
    assert runs.last_generation(spark, generations_path(str(bronze), schemas.ROUTES)) == 1
    assert rows(read_bronze(spark, schemas.ROUTES, str(bronze)), "route_id") == [("009",), ("010",)]


def test_one_scan_per_header_however_many_files(spark, tmp_path, rows):
    headers = ["route_id,route_type", "route_type,route_id,route_url", "﻿route_id,unknown,route_id"]
    expected, files = [], []
    for i in range(1_000):
        header, path = headers[i % 3], tmp_path / f"{2000 + i // 300}-{1 + i // 25 % 12:02d}-{1 + i % 25:02d}" / f"routes {i}.txt"
        values = {0: f"r{i},3", 1: f"2,r{i},u", 2: f"r{i},x,other"}[i % 3]
        put(path, f"{header}\n{values}\n" if i else "")
        files.append(str(path))
        if i:
            expected.append((f"r{i}", {0: 3, 1: 2, 2: None}[i % 3], "u" if i % 3 == 1 else None, path.parent.name))
    got = read_schedule_by_header(spark, files, schemas.ROUTES)
    assert got._jdf.queryExecution().executedPlan().toString().count("FileScan csv") == 3
    assert rows(got, "route_id", "route_type", "route_url", schemas.SNAPSHOT_DATE) == sorted(expected, key=str)
    assert {r.header: len(r.files) for r in headers_of(spark, files).collect()} == dict(zip([h.removeprefix("\ufeff") for h in headers], (333, 333, 333), strict=True))


@pytest.mark.parametrize("partitions", [1, 40])
def test_files_follow_the_size_of_a_date(spark, tmp_path, monkeypatch, partitions):
    """Tasks times dates without the rebalancing; with it a date of few rows is one file, a large one several."""
    names = schemas.ROUTES.typed.fieldNames()
    large = F.col("id") < 19_000
    df = spark.range(0, 20_000, 1, partitions).select(
        F.when(large, "2026-03-08").otherwise(F.concat(F.lit("2026-03-"), (10 + F.col("id") % 20).cast("string"))).alias("d"),
        *[F.sha2(F.concat(F.lit(name), F.col("id").cast("string")), 256).alias(name) for name in names],
    )
    for size, least, most in (("64m", 1, 1), ("512k", 4, 60)):
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", size)
        try:
            write_schedule_snapshots(df, str(tmp_path / size), schemas.ROUTES, F.col("d"))
        finally:
            spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
        count = {p.name: len(list(p.glob("part-*"))) for p in (tmp_path / size / "routes.txt").glob("snapshot_date=*")}
        assert len(count) == 21
        # A large date is only cut where several tasks brought rows of it.
        assert (least if partitions > 1 else 1) <= count.pop("snapshot_date=2026-03-08") <= most
        assert set(count.values()) == {1}


def test_range_numbers_and_morton_keys_against_python(spark):
    rng = random.Random(4)
    data = [(rng.choice([None, f"c{rng.randrange(500):03d}"]), rng.choice([None, rng.randrange(-9000, 9000)])) for _ in range(600)]
    df = spark.createDataFrame(data, "c STRING, t INT")
    bounds = layout.range_bounds(df, ["c", "t"])
    assert all(b == sorted(set(b)) and len(b) < 64 for b in bounds.values())
    numbers = [layout.range_number(F.col(c), bounds[c]) for c in ("c", "t")]
    got = df.select("c", "t", numbers[0].alias("nc"), numbers[1].alias("nt"), layout.morton_key(numbers).alias("key")).collect()
    for row in got:
        expected = [0 if row[c] is None else bisect_right(bounds[c], row[c]) for c in ("c", "t")]
        assert [row.nc, row.nt] == expected
        bits = [(expected[place] >> bit & 1) << (2 * bit + 1 - place) for bit in range(6) for place in (0, 1)]
        assert row.key == sum(bits)


def test_filters_on_either_column_skip_files(spark, tmp_path):
    rows = spark.range(40_000).select(
        F.concat(F.lit("corridor_"), F.pmod(F.xxhash64("id"), F.lit(400))).alias("corridor_id"),
        F.timestamp_seconds(F.pmod(F.xxhash64("id", F.lit(1)), F.lit(10**6))).alias("polled_at"),
    )
    layout.cluster(rows, ["corridor_id", "polled_at"], 64).write.parquet(str(tmp_path / "both"))
    rows.repartitionByRange(64, "corridor_id", "polled_at").write.parquet(str(tmp_path / "sorted"))
    read = {
        (name, c): layout.files_read(spark, str(tmp_path / name), c).first() for name in ("both", "sorted") for c in ("corridor_id", "polled_at")
    }
    assert all(r.rows == 40_000 and r.files == 64 for r in read.values())
    assert all(read["both", c].files_read <= 24 for c in ("corridor_id", "polled_at"))
    assert read["sorted", "polled_at"].files_read > 48


def test_bronze_batches_are_clustered_within_their_date(spark, tmp_path):
    landing, bronze = tmp_path / "landing", str(tmp_path / "bronze")
    for day in (22, 23):
        poll(landing, f"d{day}", f"2026-03-{day}", 300, hours=range(5, 24), corridors=20)
    start_ingest(spark, schemas.TRAFFIC, str(landing), bronze).awaitTermination()
    found = read_bronze(spark, schemas.TRAFFIC, bronze)
    assert found.count() == 2 * 19 * 20
    names = sorted(p.name for p in Path(bronze, "bronze_traffic_api/generation=0/batch=0").glob("poll_date=*"))
    assert names == ["poll_date=2026-03-22", "poll_date=2026-03-23"]
    assert schemas.TRAFFIC.properties["clustered_by"].split(",") == ["corridor_id", "polled_at"]


def test_casts_are_observed_only_where_a_column_can_fail(spark):
    assert [f.name for f in schemas.TRIPS.typed if f.dataType.typeName() != "string"] == ["direction_id", "wheelchair_accessible", "bikes_allowed"]
    failures = observed.cast_failures({f.name: F.col(f.name) for f in schemas.TRIPS.as_text}, schemas.TRIPS.typed)
    df = spark.createDataFrame([("1", "x", None), ("", "2", "3")], "direction_id STRING, wheelchair_accessible STRING, bikes_allowed STRING")
    assert df.agg(*failures).first().asDict() == {"failed_direction_id": 1, "failed_wheelchair_accessible": 1, "failed_bikes_allowed": 0}
    assert feeds.casts_of(schemas.TRIPS) == "casts:bronze_gtfs_trips"
