"""The given star-schema tables seen as transit feeds.

Every feed keeps all rows of its table: line items are stop times, orders trips, nations routes,
parts stops, events traffic readings. Schedule feeds appear in several snapshots, as real ones do.
Each DataFrame function has a SQL twin of the same content in ``SQL``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from headway.functions.clock import seconds_to_clock

SNAPSHOTS = ("2026-03-08", "2026-03-15", "2026-03-22")
ROUTE_COUNT = 30  # five more than there are nations, so some trips have an unknown route


_SCHEMAS: dict[str, T.StructType] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table; its schema is read from the file once, not once per use."""
    path = f"{sf_dir}/{name}.parquet"
    if path not in _SCHEMAS:
        _SCHEMAS[path] = spark.read.parquet(path).schema
    return spark.read.schema(_SCHEMAS[path]).parquet(path)


def _snapshots(df: DataFrame, dates: tuple[str, ...]) -> DataFrame:
    numbered = F.array(*[F.struct(F.lit(i).alias("k"), F.lit(d).alias("d")) for i, d in enumerate(dates)])
    return df.withColumn("_s", F.explode(numbered)).select(
        *df.columns, F.col("_s.k").alias("k"), F.col("_s.d").alias("gtfs_snapshot_date")
    )


def _route_id(number: Column) -> Column:
    return F.lpad(number.cast("string"), 3, "0")


def stop_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = _snapshots(table(spark, sf_dir, "lineitem"), SNAPSHOTS[1:])
    order, line = F.col("l_orderkey"), F.col("l_linenumber")
    arrival = (
        (F.pmod(order, F.lit(19)) + 5) * 3600
        + F.pmod(order * 7, F.lit(60)) * 60
        + line * 180
        + F.pmod("l_suppkey", F.lit(60))
    )
    dwell = 15 + F.pmod(F.col("l_quantity").cast("int"), F.lit(30))
    return lines.select(
        F.concat(F.lit("trip_"), order.cast("string")).alias("trip_id"),
        seconds_to_clock(arrival).alias("arrival_time"),
        seconds_to_clock(arrival + dwell).alias("departure_time"),
        (F.col("l_partkey") + 50_001 - F.col("k")).cast("string").alias("stop_id"),
        line.alias("stop_sequence"),
        F.lit(None).cast("string").alias("stop_headsign"),
        F.lit(0).alias("pickup_type"),
        F.lit(0).alias("drop_off_type"),
        F.round((line - 1) * (F.col("l_tax") + 0.3), 2).alias("shape_dist_traveled"),
        "gtfs_snapshot_date",
    )


def trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = _snapshots(table(spark, sf_dir, "orders"), SNAPSHOTS[1:])
    return orders.select(
        _route_id(F.pmod("o_custkey", F.lit(ROUTE_COUNT))).alias("route_id"),
        F.when(F.col("o_orderstatus") == "O", "weekend").otherwise("weekday").alias("service_id"),
        F.concat(F.lit("trip_"), F.col("o_orderkey").cast("string")).alias("trip_id"),
        F.col("o_orderpriority").alias("trip_headsign"),
        F.pmod("o_orderkey", F.lit(2)).cast("int").alias("direction_id"),
        F.lit(None).cast("string").alias("block_id"),
        F.concat(F.lit("shape_"), F.pmod("o_custkey", F.lit(ROUTE_COUNT)).cast("string")).alias("shape_id"),
        F.lit(1).alias("wheelchair_accessible"),
        F.lit(1).alias("bikes_allowed"),
        "gtfs_snapshot_date",
    )


def routes(spark: SparkSession, sf_dir: str) -> DataFrame:
    nations = _snapshots(table(spark, sf_dir, "nation"), SNAPSHOTS)
    key = F.col("n_nationkey")
    renamed = (F.col("k") == 2) & (F.pmod(key, F.lit(7)) == 0)
    return nations.select(
        _route_id(key).alias("route_id"),
        F.lit("AG").alias("agency_id"),
        key.cast("string").alias("route_short_name"),
        F.concat("n_name", F.when(renamed, " (Express)").otherwise("")).alias("route_long_name"),
        F.lit(None).cast("string").alias("route_desc"),
        (F.col("n_regionkey") + 1).cast("int").alias("route_type"),
        F.lit(None).cast("string").alias("route_url"),
        F.lpad(key.cast("string"), 6, "0").alias("route_color"),
        F.lpad((key + 1).cast("string"), 6, "0").alias("route_text_color"),
        "gtfs_snapshot_date",
    )


def customer_routes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as a route list that grows with the data; used where routes are not joined hour by hour."""
    customers = _snapshots(table(spark, sf_dir, "customer"), SNAPSHOTS)
    key = F.col("c_custkey")
    renamed = (F.col("k") == 2) & (F.pmod(key, F.lit(7)) == 0)
    return customers.select(
        F.lpad(key.cast("string"), 9, "0").alias("route_id"),
        F.col("c_mktsegment").alias("agency_id"),
        key.cast("string").alias("route_short_name"),
        F.concat("c_name", F.when(renamed, " (Express)").otherwise("")).alias("route_long_name"),
        F.lit(None).cast("string").alias("route_desc"),
        (F.pmod("c_nationkey", F.lit(5)) + 1).cast("int").alias("route_type"),
        F.lit(None).cast("string").alias("route_url"),
        F.lpad(key.cast("string"), 6, "0").alias("route_color"),
        F.lpad((key + 1).cast("string"), 6, "0").alias("route_text_color"),
        "gtfs_snapshot_date",
    )


def stops(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = _snapshots(table(spark, sf_dir, "part"), SNAPSHOTS)
    key = F.col("p_partkey")
    moved = (F.col("k") > 0) & (F.pmod(key * 31 + F.col("k") * 17, F.lit(50)) == 0)
    return parts.select(
        (key + 50_000).cast("string").alias("stop_id"),
        (key + 50_000).cast("string").alias("stop_code"),
        F.concat("p_name", F.when(moved, F.concat(F.lit(" at "), "p_brand")).otherwise("")).alias("stop_name"),
        F.lit(None).cast("string").alias("stop_desc"),
        (49.0 + F.pmod(key, F.lit(1000)) / 1000.0 + F.when(moved, F.col("p_size") / 500.0).otherwise(0.0)).alias("stop_lat"),
        (-123.0 - F.pmod(key, F.lit(700)) / 1000.0).alias("stop_lon"),
        F.col("p_brand").alias("zone_id"),
        F.lit(None).cast("string").alias("stop_url"),
        F.lit(0).alias("location_type"),
        F.lit(None).cast("string").alias("parent_station"),
        F.pmod("p_size", F.lit(2)).cast("int").alias("wheelchair_boarding"),
        "gtfs_snapshot_date",
    )


def traffic(spark: SparkSession, sf_dir: str, every_event: bool = False) -> DataFrame:
    """Readings as polled. Poll times are cut to the hour, so some repeat, unless ``every_event``."""
    events = table(spark, sf_dir, "events")
    user = F.col("user_id")
    hour = F.date_trunc("hour", "ts").cast("timestamp_ntz")
    free_flow = (60 + F.pmod(user, F.lit(600))).cast("int")
    ratio = F.round(1.0 + F.col("value") / 50.0, 3)
    return events.select(
        F.concat(F.lit("corridor_"), user.cast("string")).alias("corridor_id"),
        F.concat(F.lit("Corridor "), user.cast("string")).alias("corridor_name"),
        (49.0 + F.pmod(user, F.lit(100)) / 1000.0).alias("origin_lat"),
        (-123.0 - F.pmod(user, F.lit(97)) / 1000.0).alias("origin_lng"),
        (49.1 + F.pmod(user, F.lit(89)) / 1000.0).alias("dest_lat"),
        (-123.1 - F.pmod(user, F.lit(83)) / 1000.0).alias("dest_lng"),
        (free_flow * ratio).cast("int").alias("duration_seconds"),
        free_flow.alias("static_duration_seconds"),
        (1000 + F.pmod(user * 37, F.lit(9000))).cast("int").alias("distance_meters"),
        ratio.alias("congestion_ratio"),
        F.when(F.col("event_type") == "error", '{"error": "timeout"}').otherwise(F.col("props")).alias(
            "api_response_json"
        ),
        (F.col("ts") if every_event else hour).alias("polled_at"),
        F.concat(F.date_format("ts", "yyyy-MM-dd"), F.lit("_traffic.json")).alias("_source_file"),
        F.col("ts").alias("_file_arrival_time"),
    )


def changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as a change feed of customers, with a sequence value that never repeats."""
    orders = table(spark, sf_dir, "orders")
    sequence = F.concat(
        F.date_format("o_orderdate", "yyyy-MM-dd"), F.lit("/"), F.lpad(F.col("o_orderkey").cast("string"), 12, "0")
    )
    return orders.select("o_custkey", "o_orderpriority", "o_orderstatus", sequence.alias("seq"))


def corridors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers as the nested corridor dimension; every ninth has no speed limit."""
    suppliers = table(spark, sf_dir, "supplier")
    key = F.col("s_suppkey")
    return suppliers.select(
        F.concat(F.lit("corridor_"), key.cast("string")).alias("corridor_id"),
        F.col("s_name").alias("corridor_name"),
        F.when(F.pmod(key, F.lit(2)) == 0, "bridge").otherwise("arterial").alias("corridor_type"),
        F.concat(F.lit("zone_"), F.col("s_nationkey").cast("string")).alias("zone"),
        F.when(F.pmod(key, F.lit(9)) > 0, (F.pmod(key, F.lit(6)) * 10 + 30)).cast("int").alias("speed_limit_kmh"),
        (F.pmod(key, F.lit(3)) + 2).cast("int").alias("num_lanes"),
        F.struct(
            (49.0 + F.pmod(key, F.lit(100)) / 1000.0).alias("lat"), (-123.0 - F.pmod(key, F.lit(97)) / 1000.0).alias("lng")
        ).alias("origin"),
        F.struct(
            (49.1 + F.pmod(key, F.lit(89)) / 1000.0).alias("lat"), (-123.1 - F.pmod(key, F.lit(83)) / 1000.0).alias("lng")
        ).alias("destination"),
    )


_TWO = f"(VALUES (0, '{SNAPSHOTS[1]}'), (1, '{SNAPSHOTS[2]}')) AS s(k, gtfs_snapshot_date)"
_THREE = (
    f"(VALUES (0, '{SNAPSHOTS[0]}'), (1, '{SNAPSHOTS[1]}'), (2, '{SNAPSHOTS[2]}')) AS s(k, gtfs_snapshot_date)"
)


def _clock(seconds: str) -> str:
    return f"printf('%02d:%02d:%02d', ({seconds}) // 3600, (({seconds}) // 60) % 60, ({seconds}) % 60)"


_ARRIVAL = "(l_orderkey % 19 + 5) * 3600 + (l_orderkey * 7 % 60) * 60 + l_linenumber * 180 + l_suppkey % 60"
_DWELL = "15 + CAST(trunc(l_quantity) AS BIGINT) % 30"
_RATIO = "ROUND(1e0 + value / 5e1, 3)"


def _traffic_sql(polled_at: str) -> str:
    return f"""SELECT 'corridor_' || user_id AS corridor_id, 'Corridor ' || user_id AS corridor_name,
        49e0 + (user_id % 100) / 1e3 AS origin_lat, -123e0 - (user_id % 97) / 1e3 AS origin_lng,
        49.1::DOUBLE + (user_id % 89) / 1e3 AS dest_lat, -123.1::DOUBLE - (user_id % 83) / 1e3 AS dest_lng,
        CAST(trunc((60 + user_id % 600) * {_RATIO}) AS INTEGER) AS duration_seconds,
        CAST(60 + user_id % 600 AS INTEGER) AS static_duration_seconds,
        CAST(1000 + user_id * 37 % 9000 AS INTEGER) AS distance_meters,
        {_RATIO} AS congestion_ratio,
        CASE WHEN event_type = 'error' THEN '{{"error": "timeout"}}' ELSE props END AS api_response_json,
        {polled_at} AS polled_at, strftime(ts, '%Y-%m-%d') || '_traffic.json' AS _source_file,
        ts AS _file_arrival_time
        FROM events"""


SQL = {
    "stop_times": f"""SELECT 'trip_' || l_orderkey AS trip_id, {_clock(_ARRIVAL)} AS arrival_time,
        {_clock(_ARRIVAL + " + " + _DWELL)} AS departure_time,
        CAST(l_partkey + 50001 - k AS VARCHAR) AS stop_id, l_linenumber AS stop_sequence,
        CAST(NULL AS VARCHAR) AS stop_headsign, 0 AS pickup_type, 0 AS drop_off_type,
        ROUND((l_linenumber - 1) * (l_tax + 0.3::DOUBLE), 2) AS shape_dist_traveled, gtfs_snapshot_date
        FROM lineitem, {_TWO}""",
    "trips": f"""SELECT lpad(CAST(o_custkey % {ROUTE_COUNT} AS VARCHAR), 3, '0') AS route_id,
        CASE WHEN o_orderstatus = 'O' THEN 'weekend' ELSE 'weekday' END AS service_id,
        'trip_' || o_orderkey AS trip_id, o_orderpriority AS trip_headsign,
        CAST(o_orderkey % 2 AS INTEGER) AS direction_id, CAST(NULL AS VARCHAR) AS block_id,
        'shape_' || (o_custkey % {ROUTE_COUNT}) AS shape_id, 1 AS wheelchair_accessible, 1 AS bikes_allowed,
        gtfs_snapshot_date
        FROM orders, {_TWO}""",
    "routes": f"""SELECT lpad(CAST(n_nationkey AS VARCHAR), 3, '0') AS route_id, 'AG' AS agency_id,
        CAST(n_nationkey AS VARCHAR) AS route_short_name,
        n_name || CASE WHEN k = 2 AND n_nationkey % 7 = 0 THEN ' (Express)' ELSE '' END AS route_long_name,
        CAST(NULL AS VARCHAR) AS route_desc, CAST(n_regionkey + 1 AS INTEGER) AS route_type,
        CAST(NULL AS VARCHAR) AS route_url, lpad(CAST(n_nationkey AS VARCHAR), 6, '0') AS route_color,
        lpad(CAST(n_nationkey + 1 AS VARCHAR), 6, '0') AS route_text_color,
        gtfs_snapshot_date
        FROM nation, {_THREE}""",
    "customer_routes": f"""SELECT lpad(CAST(c_custkey AS VARCHAR), 9, '0') AS route_id, c_mktsegment AS agency_id,
        CAST(c_custkey AS VARCHAR) AS route_short_name,
        c_name || CASE WHEN k = 2 AND c_custkey % 7 = 0 THEN ' (Express)' ELSE '' END AS route_long_name,
        CAST(NULL AS VARCHAR) AS route_desc, CAST(c_nationkey % 5 + 1 AS INTEGER) AS route_type,
        CAST(NULL AS VARCHAR) AS route_url, lpad(CAST(c_custkey AS VARCHAR), 6, '0') AS route_color,
        lpad(CAST(c_custkey + 1 AS VARCHAR), 6, '0') AS route_text_color,
        gtfs_snapshot_date
        FROM customer, {_THREE}""",
    "stops": f"""SELECT CAST(p_partkey + 50000 AS VARCHAR) AS stop_id, CAST(p_partkey + 50000 AS VARCHAR) AS stop_code,
        p_name || CASE WHEN moved THEN ' at ' || p_brand ELSE '' END AS stop_name, CAST(NULL AS VARCHAR) AS stop_desc,
        49e0 + (p_partkey % 1000) / 1e3 + CASE WHEN moved THEN p_size / 5e2 ELSE 0e0 END AS stop_lat,
        -123e0 - (p_partkey % 700) / 1e3 AS stop_lon, p_brand AS zone_id, CAST(NULL AS VARCHAR) AS stop_url,
        0 AS location_type, CAST(NULL AS VARCHAR) AS parent_station,
        CAST(p_size % 2 AS INTEGER) AS wheelchair_boarding, gtfs_snapshot_date
        FROM (SELECT *, k > 0 AND (p_partkey * 31 + k * 17) % 50 = 0 AS moved FROM part, {_THREE})""",
    "traffic": _traffic_sql("date_trunc('hour', ts)"),
    "traffic_every_event": _traffic_sql("ts"),
    "changes": """SELECT o_custkey, o_orderpriority, o_orderstatus,
        strftime(o_orderdate, '%Y-%m-%d') || '/' || lpad(CAST(o_orderkey AS VARCHAR), 12, '0') AS seq FROM orders""",
    "corridors": """SELECT 'corridor_' || s_suppkey AS corridor_id, s_name AS corridor_name,
        CASE WHEN s_suppkey % 2 = 0 THEN 'bridge' ELSE 'arterial' END AS corridor_type,
        'zone_' || s_nationkey AS zone,
        CAST(CASE WHEN s_suppkey % 9 > 0 THEN s_suppkey % 6 * 10 + 30 ELSE 50 END AS INTEGER) AS speed_limit_kmh,
        CAST(s_suppkey % 3 + 2 AS INTEGER) AS num_lanes,
        49e0 + (s_suppkey % 100) / 1e3 AS origin_lat, -123e0 - (s_suppkey % 97) / 1e3 AS origin_lng,
        49.1::DOUBLE + (s_suppkey % 89) / 1e3 AS dest_lat, -123.1::DOUBLE - (s_suppkey % 83) / 1e3 AS dest_lng
        FROM supplier""",
}
