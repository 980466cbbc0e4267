"""What large steps leave on disk: shares done one after the other, shuffles given back, compressed files."""

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from headway import schemas
from headway.operators.cuts import MOST_SHARES, share_count
from headway.plans import workflow
from headway.plans.segments import scheduled_segments, scheduled_segments_in_shares
from headway.plans.workflow import run_all
from headway.session import shuffles_freed
from headway.sources import feeds
from headway.sources.feeds import headers_of, read_schedule, read_schedule_by_header, read_traffic, write_schedule_snapshots, write_traffic_days
from headway.sources.tables import create_schema, materialize, materialize_by_date, table_metadata
from headway.streaming.ingest import start_ingest
from tests.test_incremental import flow_at, poll, results
from tests.test_workflow import deliver

OLD, NEW = "2026-03-08", "2026-03-15"


def shuffle_files(spark):
    folders = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()
    return {p for folder in folders for p in Path(folder.getPath()).glob("*/shuffle_*")}


def few_schedules(spark):
    """20 trips and one of many stops; most stops meet at one place; the first trip is not in the latest snapshot."""
    times = [
        (f"t{t}", f"{5 + t % 19:02d}:{i % 60:02d}:00", f"{5 + t % 19:02d}:{i % 60:02d}:30", "hub" if i % 2 else f"s{i}", i, i / 10, NEW if t else OLD)
        for t in range(21)
        for i in range(200 if t == 7 else 6)
    ]
    times += [(None, "08:00:00", "08:00:30", "hub", 1, 0.0, NEW), ("t3", "08:30:00", None, None, 9, None, NEW), times[9], times[9]]
    stop_times = spark.createDataFrame(
        times, "trip_id STRING, arrival_time STRING, departure_time STRING, stop_id STRING, stop_sequence INT, shape_dist_traveled DOUBLE, gtfs_snapshot_date STRING"
    )
    trips = [(f"r{t % 3}", "weekday", f"t{t}", "East", t % 2, date) for t in range(21) for date in (OLD, NEW)]
    trips = spark.createDataFrame(
        trips, "route_id STRING, service_id STRING, trip_id STRING, trip_headsign STRING, direction_id INT, gtfs_snapshot_date STRING"
    )
    routes = spark.createDataFrame([("r0", "0", "Zero", 3), ("r1", "1", "One", None)], "route_id STRING, route_short_name STRING, route_long_name STRING, route_type INT")
    stops = [("hub", "Hub", 49.0, -123.0, OLD, NEW), ("hub", "Hub (Moved)", 49.1, -123.0, NEW, None), ("s2", "Two", 49.2, -123.1, OLD, None)]
    stops = spark.createDataFrame(stops, "stop_id STRING, stop_name STRING, stop_lat DOUBLE, stop_lon DOUBLE, __START_AT STRING, __END_AT STRING")
    return stop_times, trips, routes, stops


@pytest.mark.parametrize("mode", ["all_versions", "as_of"])
def test_segments_in_shares_are_those_of_the_whole(spark, rows, mode):
    given = few_schedules(spark)
    shares = scheduled_segments_in_shares(*given, mode, 150)
    assert len(shares) == 3
    together = [row for share in shares for row in rows(share)]
    assert sorted(together, key=str) == rows(scheduled_segments(*given, mode))
    assert together and len(scheduled_segments_in_shares(*given, mode, 10_000)) == 1


def test_number_of_shares_is_bounded():
    assert [share_count(n, 100) for n in (0, 1, 100, 101, 10**12)] == [1, 1, 1, 2, MOST_SHARES]


def test_runs_in_shares_give_the_same_results(spark, tmp_path, schema_name, rows, monkeypatch):
    """Dates that are not touched by the second delivery stay, and so do those of the other shares. No shuffle files are left."""

    before, left = shuffle_files(spark), []

    def delivered(name):
        flow = flow_at(tmp_path, f"{schema_name}_{name}", name)
        for day in (23, 24, 25):
            poll(tmp_path / name / "traffic", f"d{day}", f"2026-03-{day}", 300 + day)
        run_all(spark, flow)
        for day in (25, 26):
            poll(tmp_path / name / "traffic", f"late{day}", f"2026-03-{day}", 500 + day, hours=(8, 9))
        run_all(spark, flow)
        left.append(shuffle_files(spark) - before)
        return results(spark, f"{schema_name}_{name}", rows)

    deliver(tmp_path / "schedule", "2026-03-08", "First")
    whole = delivered("whole")
    monkeypatch.setattr(workflow, "STOP_TIMES_PER_SHARE", 1)
    monkeypatch.setattr(workflow, "READINGS_PER_SHARE", 4)
    assert delivered("shares") == whole
    assert not left[0]
    assert len(whole["gold_schedule_vs_actual"]) == 12


def test_shuffles_are_freed_inside_only(spark):
    def query():
        return spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count().collect()

    kept = query()
    before = shuffle_files(spark)
    with shuffles_freed(spark):
        assert query() == kept
        assert shuffle_files(spark) <= before
    query()
    assert shuffle_files(spark) - before


def test_written_deliveries_are_compressed_and_read_back(spark, tmp_path, rows, monkeypatch):
    monkeypatch.setattr(feeds, "ROWS_PER_FILE", 100)
    names = schemas.ROUTES.typed.fieldNames()
    df = spark.range(250).select(*[(F.col("id") % 3).cast("int").alias(n) if n == "route_type" else F.concat(F.lit(n), F.col("id")).alias(n) for n in names])
    landing = str(tmp_path / "landing")
    write_schedule_snapshots(df, landing, schemas.ROUTES, F.lit(NEW), compressed=True)
    files = [str(p) for p in (tmp_path / "landing" / "routes.txt").glob("*/part-*")]
    assert len(files) >= 3 and all(f.endswith(".csv.gz") for f in files)
    assert rows(read_schedule(spark, landing, schemas.ROUTES, "by_file"), *names) == rows(df, *names)
    assert rows(read_schedule_by_header(spark, files, schemas.ROUTES), *names) == rows(df, *names)
    assert [sorted(Path(f).name for f in r.files) for r in headers_of(spark, files).collect()] == [sorted(Path(f).name for f in files)]

    polled = spark.range(50).select(
        F.concat(F.lit("c"), F.col("id")).alias("corridor_id"), F.timestamp_seconds(F.col("id") * 7201 + 1_774_000_000).cast("timestamp_ntz").alias("polled_at")
    )
    write_traffic_days(polled, str(tmp_path / "traffic"), compressed=True)
    assert all(p.name.endswith(".json.gz") for p in (tmp_path / "traffic").glob("*/part-*"))
    write_traffic_days(polled, str(tmp_path / "plain"))
    assert all(p.name.endswith(".json") for p in (tmp_path / "plain").glob("*/part-*"))
    found = read_traffic(spark, str(tmp_path / "traffic"), schemas.TRAFFIC).withColumn("polled_at", F.col("polled_at").cast("timestamp_ntz"))
    assert rows(found, "corridor_id", "polled_at") == rows(polled)


def test_tables_are_stored_compressed_without_a_property_for_it(spark, schema_name, tmp_path):
    create_schema(spark, schema_name, str(tmp_path / "tables"))
    days = spark.range(40).withColumn("day", F.date_add(F.lit("2026-03-08").cast("date"), (F.col("id") % 4).cast("int")))
    materialize(days, f"{schema_name}.whole", "Whole", {"quality": "gold"})
    for dates in (None, days.select("day")):
        materialize_by_date(days, f"{schema_name}.dated", "day", "Dated", {"quality": "gold"}, dates)
    for name in ("whole", "dated"):
        assert spark.table(f"{schema_name}.{name}").count() == 40
        stored = list((tmp_path / "tables" / name).rglob("part-*.parquet"))
        assert stored and all(p.name.endswith(".zstd.parquet") for p in stored)
        assert {r.key for r in table_metadata(spark, f"{schema_name}.{name}").collect()} == {"comment", "quality"}


def test_bronze_is_stored_compressed(spark, tmp_path):
    deliver(tmp_path / "schedule", "2026-03-08", "First")
    poll(tmp_path / "traffic", "d23", "2026-03-23", 300)
    bronze = tmp_path / "bronze"
    start_ingest(spark, schemas.STOP_TIMES, str(tmp_path / "schedule"), str(bronze)).awaitTermination()
    start_ingest(spark, schemas.TRAFFIC, str(tmp_path / "traffic"), str(bronze)).awaitTermination()
    for feed in (schemas.STOP_TIMES, schemas.TRAFFIC):
        stored = list((bronze / feed.name).rglob("part-*.parquet"))
        assert stored and all(p.name.endswith(".zstd.parquet") for p in stored)
