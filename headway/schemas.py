"""Explicit schemas of the feeds and of the datasets built from them.

Nothing is ever inferred: route ids such as ``009`` would lose their zeros, and a column of
clock strings would turn into timestamps until the first ``24:10:00`` arrives.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

SNAPSHOT_DATE = "gtfs_snapshot_date"
SOURCE_FILE = "_source_file"
ARRIVAL_TIME = "_file_arrival_time"
POLL_DATE = "poll_date"
# Folders of a dataset that is stored batch by batch.
GENERATION, BATCH = "generation", "batch"


_TYPES = {"STRING": T.StringType(), "INT": T.IntegerType(), "DOUBLE": T.DoubleType(), "TIMESTAMP": T.TimestampType()}


def _struct(columns: str) -> T.StructType:
    """Schema from ``name TYPE, name TYPE``; unlike a DDL string it needs no running session."""
    return T.StructType([T.StructField(n, _TYPES[t]) for n, t in (c.split() for c in columns.split(","))])


@dataclass(frozen=True)
class Feed:
    """One bronze dataset: its file name, typed columns and table comment."""

    name: str
    file: str
    columns: str
    comment: str
    properties: dict[str, str] = field(default_factory=lambda: {"quality": "bronze"})

    @property
    def typed(self) -> T.StructType:
        return _struct(self.columns)

    @property
    def as_text(self) -> T.StructType:
        return T.StructType([T.StructField(f.name, T.StringType()) for f in self.typed])


# Column names, types and file names of the schedule and traffic feeds.
ROUTES = Feed(
    "bronze_gtfs_routes",
    "routes.txt",
    "route_id STRING, agency_id STRING, route_short_name STRING, route_long_name STRING, "
    "route_desc STRING, route_type INT, route_url STRING, route_color STRING, route_text_color STRING",
    "Route definitions of every schedule snapshot, as delivered",
)
STOPS = Feed(
    "bronze_gtfs_stops",
    "stops.txt",
    "stop_id STRING, stop_code STRING, stop_name STRING, stop_desc STRING, stop_lat DOUBLE, "
    "stop_lon DOUBLE, zone_id STRING, stop_url STRING, location_type INT, parent_station STRING, "
    "wheelchair_boarding INT",
    "Stop definitions of every schedule snapshot, as delivered",
)
TRIPS = Feed(
    "bronze_gtfs_trips",
    "trips.txt",
    "route_id STRING, service_id STRING, trip_id STRING, trip_headsign STRING, direction_id INT, "
    "block_id STRING, shape_id STRING, wheelchair_accessible INT, bikes_allowed INT",
    "Trips of every schedule snapshot, as delivered",
)
STOP_TIMES = Feed(
    "bronze_gtfs_stop_times",
    "stop_times.txt",
    "trip_id STRING, arrival_time STRING, departure_time STRING, stop_id STRING, stop_sequence INT, "
    "stop_headsign STRING, pickup_type INT, drop_off_type INT, shape_dist_traveled DOUBLE",
    "Stop times of every schedule snapshot, as delivered",
)
TRAFFIC = Feed(
    "bronze_traffic_api",
    "",
    "corridor_id STRING, corridor_name STRING, origin_lat DOUBLE, origin_lng DOUBLE, dest_lat DOUBLE, "
    "dest_lng DOUBLE, duration_seconds INT, static_duration_seconds INT, distance_meters INT, "
    "congestion_ratio DOUBLE, api_response_json STRING, polled_at TIMESTAMP",
    "Traffic readings as polled",
    {"quality": "bronze", "clustered_by": "corridor_id,polled_at"},
)

SCHEDULE_FEEDS = (ROUTES, STOPS, TRIPS, STOP_TIMES)

_POINT = _struct("lat DOUBLE, lng DOUBLE")
CORRIDOR = (
    _struct(
        "corridor_id STRING, corridor_name STRING, corridor_type STRING, zone STRING, speed_limit_kmh INT, num_lanes INT"
    )
    .add("origin", _POINT)
    .add("destination", _POINT)
)
DEFAULT_SPEED_LIMIT_KMH = 50


def bronze_schema(feed: Feed) -> T.StructType:
    """Schema of the stored bronze dataset, provenance columns last."""
    schema = feed.typed
    if feed is TRAFFIC:
        return schema.add(SOURCE_FILE, T.StringType()).add(ARRIVAL_TIME, T.TimestampType())
    return schema.add(SNAPSHOT_DATE, T.StringType()).add(SOURCE_FILE, T.StringType())
