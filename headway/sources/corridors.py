"""The corridor dimension: JSON arrays of corridors with nested end points, and what follows from it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from headway.functions import geo
from headway.schemas import CORRIDOR, DEFAULT_SPEED_LIMIT_KMH

# Readings are polled every quarter of an hour from 05:00 to 23:45.
POLL_MINUTES = 15
FIRST_POLL_MINUTE = 5 * 60
LAST_POLL_MINUTE = 23 * 60 + 45


def read_corridors(spark: SparkSession, path: str) -> DataFrame:
    """Corridors with flat end points and the default speed limit filled in."""
    nested = spark.read.schema(CORRIDOR).option("multiLine", True).option("recursiveFileLookup", True).json(path)
    return flatten_corridors(nested)


def flatten_corridors(nested: DataFrame) -> DataFrame:
    return nested.select(
        "corridor_id",
        "corridor_name",
        "corridor_type",
        "zone",
        F.coalesce("speed_limit_kmh", F.lit(DEFAULT_SPEED_LIMIT_KMH)).alias("speed_limit_kmh"),
        "num_lanes",
        F.col("origin.lat").alias("origin_lat"),
        F.col("origin.lng").alias("origin_lng"),
        F.col("destination.lat").alias("dest_lat"),
        F.col("destination.lng").alias("dest_lng"),
    )


def with_geometry(corridors: DataFrame) -> DataFrame:
    """Adds distance and free-flow time."""
    km = geo.haversine_km(F.col("origin_lat"), F.col("origin_lng"), F.col("dest_lat"), F.col("dest_lng"))
    measured = corridors.withColumn("distance_km", km)
    return measured.withColumns(
        {
            "distance_meters": geo.whole_metres(F.col("distance_km")),
            "static_duration_seconds": geo.free_flow_seconds(F.col("distance_km"), F.col("speed_limit_kmh")),
        }
    )


def poll_grid(corridors: DataFrame, first_day: str, days: int) -> DataFrame:
    """One row per corridor and poll time, none for no days. Each corridor unfolds its own times, so nothing is shuffled."""
    start = F.lit(first_day).cast("timestamp_ntz")

    def polls_of(day: Column) -> Column:
        midnight = start + F.make_dt_interval(day)
        return F.sequence(
            midnight + F.make_dt_interval(mins=F.lit(FIRST_POLL_MINUTE)),
            midnight + F.make_dt_interval(mins=F.lit(LAST_POLL_MINUTE)),
            F.make_dt_interval(mins=F.lit(POLL_MINUTES)),
        )

    # sequence() counts down when its end lies below its start, so it runs one day further and is cut.
    every_day = F.slice(F.sequence(F.lit(0), F.lit(days)), 1, days)
    every_poll = F.flatten(F.transform(every_day, polls_of))
    return corridors.withColumn("polled_at", F.explode(every_poll))


def readings_from_grid(grid: DataFrame, ratio: Column) -> DataFrame:
    """Traffic readings over a poll grid, for a given congestion ratio expression."""
    with_ratio = with_geometry(grid).withColumn("congestion_ratio", F.round(ratio, 3))
    return with_ratio.select(
        "corridor_id",
        "corridor_name",
        "origin_lat",
        "origin_lng",
        "dest_lat",
        "dest_lng",
        geo.congested_seconds(F.col("static_duration_seconds"), F.col("congestion_ratio")).alias("duration_seconds"),
        "static_duration_seconds",
        "distance_meters",
        "congestion_ratio",
        F.to_json(F.struct(F.lit("OK").alias("status"), F.col("corridor_id").alias("corridor"))).alias(
            "api_response_json"
        ),
        "polled_at",
    )
