"""The whole workflow on small delivered files, run twice with more files in between."""

import json

from headway.plans.workflow import GOLD_TABLES, Workflow, run_all
from headway.sources.corridors import read_corridors
from headway.sources.tables import cluster
from pyspark.sql import functions as F
from tests.test_streams import put, routes_file

STOPS_HEADER = "stop_id,stop_code,stop_name,stop_desc,stop_lat,stop_lon,zone_id,stop_url,location_type,parent_station,wheelchair_boarding"
TRIPS_HEADER = "route_id,service_id,trip_id,trip_headsign,direction_id,block_id,shape_id,wheelchair_accessible,bikes_allowed"
TIMES_HEADER = "trip_id,arrival_time,departure_time,stop_id,stop_sequence,stop_headsign,pickup_type,drop_off_type,shape_dist_traveled"


def deliver(landing, date, stop_name):
    put(landing / date / "routes.txt", routes_file("009,AG,9,East/West,,3,,0000FF,FFFFFF"))
    stops = [f"50000,50000,{stop_name},,49.25,-123.1,main,,0,,1", "50001,50001,Second,,49.26,-123.1,main,,0,,0"]
    put(landing / date / "stops.txt", "\n".join([STOPS_HEADER, *stops]) + "\n")
    put(landing / date / "trips.txt", TRIPS_HEADER + "\n009,weekday,t1,East,0,,s,1,1\n")
    times = ["t1,08:00:00,08:00:30,50000,1,,0,0,0.0", "t1,08:05:00,08:05:30,50001,2,,0,0,0.91"]
    put(landing / date / "stop_times.txt", "\n".join([TIMES_HEADER, *times]) + "\n")


def poll(landing, day, seconds):
    readings = [
        {
            "corridor_id": f"corridor_{i}",
            "corridor_name": f"Corridor {i}",
            "origin_lat": 49.2,
            "origin_lng": -123.0,
            "dest_lat": 49.3,
            "dest_lng": -123.1,
            "duration_seconds": seconds + i,
            "static_duration_seconds": 88,
            "distance_meters": 1232,
            "congestion_ratio": 1.203,
            "api_response_json": json.dumps({"status": "OK"}),
            "polled_at": f"{day}T08:00:00",
        }
        for i in range(3)
    ]
    put(landing / f"{day}_traffic.json", "\n".join(map(json.dumps, readings)) + "\n")


def test_two_runs(spark, tmp_path, schema_name, rows):
    schedule, traffic = tmp_path / "extracted", tmp_path / "traffic_api"
    flow = Workflow(str(schedule), str(traffic), str(tmp_path / "storage"), schema_name, str(tmp_path / "tables"))
    deliver(schedule, "2026-03-08", "First")
    poll(traffic, "2026-03-23", 300)
    assert run_all(spark, flow) == sorted(GOLD_TABLES)
    patterns = spark.table(f"{schema_name}_physical.gold_route_delay_patterns")
    assert rows(patterns, "route_id", "hour_of_day", "day_type", "sample_size", "avg_delay_seconds") == [
        ("009", 8, "weekday", 3, 31.0)
    ]

    run_all(spark, flow)
    assert spark.table(f"{schema_name}.bronze_traffic_api").count() == 3

    deliver(schedule, "2026-03-15", "First (Relocated)")
    poll(traffic, "2026-03-24", 400)
    run_all(spark, flow)
    stops = spark.table(f"{schema_name}.silver_gtfs_stops")
    assert rows(stops, "stop_name", "__START_AT", "__END_AT") == [
        ("First (Relocated)", "2026-03-15", None),
        ("First", "2026-03-08", "2026-03-15"),
        ("Second", "2026-03-08", None),
    ]
    comparison = spark.table(f"{schema_name}_physical.gold_schedule_vs_actual")
    assert comparison.count() == 6
    # All versions of the origin stop: the one segment counts twice, as documented.
    assert {r.scheduled_segments for r in comparison.collect()} == {2}
    assert spark.table(f"{schema_name}_physical.gold_corridor_daily_summary").count() == 6
    assert spark.table(f"{schema_name}_physical.gold_congestion_patterns").count() == 6
    assert spark.table(f"{schema_name}.silver_gtfs_scheduled_times").first().gtfs_snapshot_date == "2026-03-15"

    properties = {
        r.key: r.value for r in spark.sql(f"SHOW TBLPROPERTIES {schema_name}_physical.gold_congestion_patterns").collect()
    }
    assert properties["quality"] == "gold"
    assert properties["source_mv"] == f"{schema_name}.gold_congestion_patterns"
    described = spark.sql(f"DESCRIBE TABLE EXTENDED {schema_name}.silver_traffic_readings").collect()
    assert any(r.col_name == "Comment" and "congestion" in r.data_type for r in described)
    bronze = {r.key: r.value for r in spark.sql(f"SHOW TBLPROPERTIES {schema_name}.bronze_gtfs_stops").collect()}
    assert bronze["quality"] == "bronze"


def test_corridor_dimension_has_a_default_speed_limit(spark, tmp_path, rows):
    point = {"lat": 49.2, "lng": -123.0}
    corridors = [
        {"corridor_id": "c1", "corridor_name": "One", "corridor_type": "bridge", "zone": "z", "num_lanes": 4, "origin": point, "destination": point},
        {"corridor_id": "c2", "speed_limit_kmh": 80, "origin": point, "destination": {"lat": 1.0, "lng": 2.0}},
    ]
    path = tmp_path / "corridors.json"
    path.write_text(json.dumps(corridors, indent=2))
    got = read_corridors(spark, str(path))
    assert rows(got, "corridor_id", "speed_limit_kmh", "origin_lat", "dest_lng") == [
        ("c1", 50, 49.2, -123.0),
        ("c2", 80, 49.2, 2.0),
    ]


def test_clustering_cuts_one_large_value_over_many_files(spark, tmp_path):
    df = spark.range(4000).select(F.lit("hot").alias("corridor_id"), F.col("id").alias("polled_at"))
    cluster(df, ["corridor_id", "polled_at"], 4).write.parquet(str(tmp_path / "c"))
    ranges = (
        spark.read.parquet(str(tmp_path / "c"))
        .groupBy("_metadata.file_name")
        .agg(F.min("polled_at").alias("low"), F.max("polled_at").alias("high"))
        .orderBy("low")
        .collect()
    )
    assert len(ranges) == 4
    assert all(a.high < b.low for a, b in zip(ranges, ranges[1:]))
