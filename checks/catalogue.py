"""Every registered query with the SQL it is compared with."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from checks import sql_parts as Q
from checks import transit_tables as feed
from headway import schemas
from headway.functions import clock, geo, labels, measures
from headway.operators import quantiles
from headway.operators.changes import current_versions, scd1, scd2, versions_as_of
from headway.operators.latest import keep_latest, latest_snapshot
from headway.operators.ordered import with_neighbour
from headway.operators.quality import drop_violations, not_null
from headway.plans import corridors as corridor_plans
from headway.plans import delays, readings, segments
from headway.plans.workflow import Workflow, run_all
from headway.session import shared_dir, shuffles_freed
from headway.sources import corridors as corridor_source
from headway.sources import feeds, layout, tables
from headway.streaming import changeflow, ingest, observed

# Sketches are exact at this accuracy for groups of up to a million rows, which makes them comparable.
EXACT_ACCURACY = 1_000_000
AS_OF = "1997-06-30/"
FOLLOW_UP = "1998-01-01"


@dataclass(frozen=True)
class Query:
    run: Callable[[SparkSession, str], DataFrame]
    sql: str


QUERIES: dict[str, Query] = {}

_REPORT_DATE_AS_TEXT = "SELECT * REPLACE (CAST(report_date AS VARCHAR) AS report_date)"


def query(name: str, sql: str):
    def register(run):
        QUERIES[name] = Query(run, sql)
        return run

    return register


def _dates_as_text(df: DataFrame) -> DataFrame:
    """Dates as ISO text on both sides: the two engines' clients hand dates over as different types."""
    return df.withColumns({f.name: F.col(f.name).cast("string") for f in df.schema if f.dataType.typeName() == "date"})


def _final(parts: list[tuple[str, str]], select: str) -> str:
    return f"{Q.with_(*parts)}\n{select}"


# --- datasets derived from the given tables -------------------------------------------------


def _readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return readings.traffic_readings(feed.traffic(spark, sf_dir))


def _routes(spark: SparkSession, sf_dir: str) -> DataFrame:
    snapshots = drop_violations(feed.routes(spark, sf_dir), not_null("route_id"))
    return scd1(snapshots, ["route_id"], schemas.SNAPSHOT_DATE, [schemas.SNAPSHOT_DATE])


def _stops(spark: SparkSession, sf_dir: str) -> DataFrame:
    snapshots = drop_violations(feed.stops(spark, sf_dir), not_null("stop_id"))
    return scd2(snapshots, ["stop_id"], schemas.SNAPSHOT_DATE, [schemas.SNAPSHOT_DATE])


def _segments(spark: SparkSession, sf_dir: str, mode: str = "all_versions") -> DataFrame:
    return segments.scheduled_segments(
        feed.stop_times(spark, sf_dir),
        feed.trips(spark, sf_dir),
        _routes(spark, sf_dir),
        _stops(spark, sf_dir),
        mode,
    )


# --- sources and sinks -----------------------------------------------------------------------


def _ingested(spark: SparkSession, sf_dir: str, dataset: schemas.Feed, rows: DataFrame) -> DataFrame:
    root = shared_dir(spark, dataset.name)
    feeds.write_schedule_snapshots(rows, f"{root}/landing", dataset, F.col(schemas.SNAPSHOT_DATE))
    bronze = ingest.ingest_feed(spark, dataset, f"{root}/landing", f"{root}/bronze", "by_file")
    return bronze.drop(schemas.SOURCE_FILE)


@query("q_ingest_routes", f"SELECT * FROM ({feed.SQL['customer_routes']})")
def ingest_routes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _ingested(spark, sf_dir, schemas.ROUTES, feed.customer_routes(spark, sf_dir))


@query("q_ingest_stops", f"SELECT * FROM ({feed.SQL['stops']})")
def ingest_stops(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _ingested(spark, sf_dir, schemas.STOPS, feed.stops(spark, sf_dir))


@query("q_ingest_trips", f"SELECT * FROM ({feed.SQL['trips']})")
def ingest_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _ingested(spark, sf_dir, schemas.TRIPS, feed.trips(spark, sf_dir))


@query("q_ingest_stop_times", f"SELECT * FROM ({feed.SQL['stop_times']})")
def ingest_stop_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _ingested(spark, sf_dir, schemas.STOP_TIMES, feed.stop_times(spark, sf_dir))


@query(
    "q_json_stream_ingest",
    f"SELECT * EXCLUDE (_source_file, _file_arrival_time) FROM ({feed.SQL['traffic_every_event']})",
)
def ingest_traffic(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = shared_dir(spark, "traffic")
    rows = feed.traffic(spark, sf_dir, every_event=True).drop(schemas.SOURCE_FILE, schemas.ARRIVAL_TIME)
    feeds.write_traffic_days(rows, f"{root}/landing")
    bronze = ingest.ingest_feed(spark, schemas.TRAFFIC, f"{root}/landing", f"{root}/bronze")
    return bronze.drop(schemas.SOURCE_FILE, schemas.ARRIVAL_TIME).withColumn(
        "polled_at", F.col("polled_at").cast("timestamp_ntz")
    )


@query(
    "q_csv_by_header",
    f"SELECT route_id, route_long_name, route_type, CAST(NULL AS VARCHAR) AS route_url, gtfs_snapshot_date "
    f"FROM ({feed.SQL['customer_routes']})",
)
def csv_by_header(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Snapshots with fewer columns, in another order, streamed in and matched by header name."""
    root = shared_dir(spark, "by-header")
    rows = feed.customer_routes(spark, sf_dir)
    for number, date in enumerate(feed.SNAPSHOTS):
        snapshot = rows.where(F.col(schemas.SNAPSHOT_DATE) == date)
        columns = ["route_type", "route_id", "route_long_name"] + (["route_url"] if number else [])
        snapshot.select(*columns).write.option("header", True).csv(f"{root}/landing/{date}/{schemas.ROUTES.file}")
    query = ingest.start_ingest_by_header(spark, schemas.ROUTES, f"{root}/landing", f"{root}/bronze")
    query.awaitTermination()
    loaded = ingest.read_bronze(spark, schemas.ROUTES, f"{root}/bronze")
    return loaded.select("route_id", "route_long_name", "route_type", "route_url", schemas.SNAPSHOT_DATE)


@query(
    "q_path_snapshot_date",
    """SELECT o_orderkey, '/landing/' || strftime(o_orderdate, '%Y-%m-%d') || '/stops.txt' AS path,
       strftime(o_orderdate, '%Y-%m-%d') AS snapshot_date FROM orders""",
)
def path_snapshot_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = F.concat(F.lit("/landing/"), F.date_format("o_orderdate", "yyyy-MM-dd"), F.lit("/stops.txt"))
    return (
        feed.table(spark, sf_dir, "orders")
        .select("o_orderkey", path.alias("path"))
        .withColumn("snapshot_date", clock.snapshot_date_in(F.col("path")))
    )


@query(
    "q_provenance",
    f"""SELECT gtfs_snapshot_date, count(*) AS rows, count(*) AS from_csv FROM ({feed.SQL['customer_routes']}) GROUP BY ALL""",
)
def provenance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per snapshot date taken from the folder, and how many of them name the file they came from."""
    root = shared_dir(spark, "provenance")
    rows = feed.customer_routes(spark, sf_dir)
    feeds.write_schedule_snapshots(rows, f"{root}/landing", schemas.ROUTES, F.col(schemas.SNAPSHOT_DATE))
    bronze = ingest.ingest_feed(spark, schemas.ROUTES, f"{root}/landing", f"{root}/bronze", "by_file")
    named = F.col(schemas.SOURCE_FILE).rlike("^part-.*[.]csv$")
    return bronze.groupBy(schemas.SNAPSHOT_DATE).agg(F.count(F.lit(1)).alias("rows"), F.count_if(named).alias("from_csv"))


@query(
    "q_arrival_time",
    """SELECT strftime(ts, '%Y-%m-%d') AS day, count(*) AS rows, count(*) AS from_json, count(*) AS arrived
       FROM events GROUP BY ALL""",
)
def arrival_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings per day, how many name their file, and how many arrived after this query began and not later than now."""
    root = shared_dir(spark, "arrival")
    began = F.lit(spark.sql("SELECT current_timestamp() - INTERVAL 1 MINUTE AS t").first().t)
    rows = feed.traffic(spark, sf_dir, every_event=True).drop(schemas.SOURCE_FILE, schemas.ARRIVAL_TIME)
    feeds.write_traffic_days(rows, f"{root}/landing")
    bronze = ingest.ingest_feed(spark, schemas.TRAFFIC, f"{root}/landing", f"{root}/bronze")
    arrived = F.col(schemas.ARRIVAL_TIME).between(began, F.current_timestamp() + F.expr("INTERVAL 1 MINUTE"))
    return bronze.groupBy(F.date_format("polled_at", "yyyy-MM-dd").alias("day")).agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.col(schemas.SOURCE_FILE).rlike("^part-.*[.]json$")).alias("from_json"),
        F.count_if(arrived).alias("arrived"),
    )


_DAILY_TABLE = "gold_corridor_daily_summary"


@query(
    "q_table_metadata",
    _final(
        Q.readings_parts(),
        f"""SELECT m.*, (SELECT count(*) FROM ({Q.DAILY})) AS rows FROM (VALUES
            ('daily', 'comment', 'One row per corridor and date'), ('daily', 'quality', 'gold'),
            ('copy', 'comment', 'Physical snapshot of {_DAILY_TABLE}'), ('copy', 'quality', 'gold'),
            ('copy', 'source_mv', 'schema.{_DAILY_TABLE}')) AS m("table", "key", "value")""",
    ),
)
def table_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Comment and properties of a stored dataset and of its snapshot, as the catalog has them."""
    root = shared_dir(spark, "metadata")
    schema = "headway_" + root[-12:]
    physical = f"{schema}_physical"
    tables.create_schema(spark, schema, f"{root}/{schema}")
    daily = corridor_plans.corridor_daily_summary(_readings(spark, sf_dir))
    tables.materialize_by_date(
        daily, f"{schema}.{_DAILY_TABLE}", "report_date", "One row per corridor and date", {"quality": "gold"}
    )
    tables.snapshot_tables(spark, schema, [_DAILY_TABLE], physical, f"{root}/{physical}", {_DAILY_TABLE: ("report_date", None)})
    found = []
    for name, within in (("daily", schema), ("copy", physical)):
        table = f"{within}.{_DAILY_TABLE}"
        described = tables.table_metadata(spark, table).select(
            F.lit(name).alias("table"), "key", F.replace("value", F.lit(schema), F.lit("schema")).alias("value")
        )
        found.append(described.crossJoin(spark.table(table).agg(F.count(F.lit(1)).alias("rows"))))
    return found[0].unionByName(found[1])


@query("q_snapshot_table", _final(Q.readings_parts(), f"{_REPORT_DATE_AS_TEXT} FROM ({Q.DAILY})"))
def snapshot_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = shared_dir(spark, "snapshot")
    schema = "headway_" + root[-12:]
    tables.create_schema(spark, schema, f"{root}/{schema}")
    tables.materialize(
        corridor_plans.corridor_daily_summary(_readings(spark, sf_dir)),
        f"{schema}.gold_corridor_daily_summary",
        "Daily corridor performance",
        {"quality": "gold"},
    )
    physical = f"{schema}_physical"
    tables.snapshot_tables(spark, schema, ["gold_corridor_daily_summary"], physical, f"{root}/{physical}")
    return _dates_as_text(spark.table(f"{physical}.gold_corridor_daily_summary"))


@query("q_clustered_write", f"SELECT * EXCLUDE (_file_arrival_time) FROM ({feed.SQL['traffic']})")
def clustered_write(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_dir(spark, "clustered")
    rows = feed.traffic(spark, sf_dir).drop(schemas.ARRIVAL_TIME)
    layout.cluster(rows, ingest.CLUSTER_BY).write.parquet(path)
    return spark.read.parquet(path)


@query(
    "q_clustered_skips",
    """SELECT c AS filtered_on, count(*) AS rows, true AS skips_half FROM events, (VALUES ('corridor_id'), ('polled_at')) AS f(c)
       GROUP BY c""",
)
def clustered_skips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether a filter on one corridor, and one on one time, lets at least half of the row groups unread; a file is one."""
    path = shared_dir(spark, "clustered")
    rows = feed.traffic(spark, sf_dir, every_event=True)
    layout.cluster(rows, ingest.CLUSTER_BY, partitions=64).write.parquet(path)
    found = [layout.files_read(spark, path, c).withColumn("filtered_on", F.lit(c)) for c in ingest.CLUSTER_BY]
    both = found[0].unionByName(found[1])
    return both.select("filtered_on", "rows", (F.col("files_read") * 2 <= F.col("files")).alias("skips_half"))


@query("q_corridor_json", f"SELECT * FROM ({feed.SQL['corridors']})")
def corridor_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The nested dimension through files that each hold one JSON array of up to a thousand corridors."""
    path = shared_dir(spark, "corridors")
    nested = feed.corridors(spark, sf_dir)
    number = F.regexp_extract("corridor_id", r"(\d+)$", 1).cast("long")
    arrays = (
        nested.groupBy(F.floor(number / 1000).alias("part"))
        .agg(F.collect_list(F.struct(*nested.columns)).alias("corridors"))
        .select("part", F.to_json("corridors").alias("value"))
    )
    arrays.write.partitionBy("part").text(path)
    return corridor_source.read_corridors(spark, path)


# --- quality and change tracking -----------------------------------------------------------------


@query("q_expect_drop", "SELECT * FROM customer WHERE c_custkey IS NOT NULL AND c_acctbal > 0")
def expect_drop(spark: SparkSession, sf_dir: str) -> DataFrame:
    expectations = {**not_null("c_custkey"), "positive_balance": F.col("c_acctbal") > 0}
    return drop_violations(feed.table(spark, sf_dir, "customer"), expectations)


_DAMAGED_SQL = f"""SELECT CASE WHEN n % 13 > 0 THEN route_id END AS route_id, n % 11 = 0 AS damaged
    FROM (SELECT *, CAST(route_id AS BIGINT) AS n FROM ({feed.SQL['customer_routes']}))"""


@query(
    "q_stream_metrics",
    f"""SELECT 'expectations:routes' AS observation, 'rows_in' AS metric, count(*) AS value FROM ({_DAMAGED_SQL})
        UNION ALL SELECT 'expectations:routes', 'dropped_route_id_not_null', count(*) - count(route_id) FROM ({_DAMAGED_SQL})
        UNION ALL SELECT 'casts:bronze_gtfs_routes', 'failed_route_type', count_if(damaged) FROM ({_DAMAGED_SQL})
        UNION ALL SELECT 'casts:bronze_traffic_api', m, CASE m WHEN 'failed_duration_seconds'
               THEN (SELECT count_if(event_id % 17 = 0) FROM events) ELSE 0 END
        FROM (SELECT unnest(['failed_origin_lat', 'failed_origin_lng', 'failed_dest_lat', 'failed_dest_lng',
              'failed_duration_seconds', 'failed_static_duration_seconds', 'failed_distance_meters', 'failed_congestion_ratio',
              'failed_polled_at', 'unreadable']) AS m)""",
)
def stream_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows that expectations dropped and casts that failed, as the streams reported them."""
    root = shared_dir(spark, "metrics")
    number = F.col("route_id").cast("long")
    routes = feed.customer_routes(spark, sf_dir).withColumns(
        {
            "route_type": F.when(F.pmod(number, F.lit(11)) == 0, "tram?").otherwise(F.col("route_type").cast("string")),
            "route_id": F.when(F.pmod(number, F.lit(13)) > 0, F.col("route_id")),
        }
    )
    feeds.write_schedule_snapshots(routes, f"{root}/routes", schemas.ROUTES, F.col(schemas.SNAPSHOT_DATE))
    polled = feed.table(spark, sf_dir, "events").select(
        F.concat(F.lit("corridor_"), "user_id").alias("corridor_id"),
        F.when(F.pmod("event_id", F.lit(17)) == 0, "soon").otherwise("105").alias("duration_seconds"),
    )
    text = F.concat(F.lit('{"corridor_id":"'), "corridor_id", F.lit('","duration_seconds":'), F.when(F.col("duration_seconds") == "soon", '"soon"').otherwise("105"), F.lit("}"))
    polled.select(text.alias("value")).write.text(f"{root}/traffic")
    metrics = observed.MetricsCollector(f"{root}/metrics")
    spark.streams.addListener(metrics)
    try:
        running = [
            ingest.start_ingest(spark, schemas.ROUTES, f"{root}/routes", f"{root}/bronze", "by_file"),
            ingest.start_ingest(spark, schemas.TRAFFIC, f"{root}/traffic", f"{root}/bronze"),
        ]
        for started in running:
            started.awaitTermination()
        hidden = (schemas.SOURCE_FILE, schemas.SNAPSHOT_DATE)
        flow = changeflow.ChangeFlow(f"{root}/routes_target/routes", ("route_id",), schemas.SNAPSHOT_DATE, hidden, not_null("route_id"))
        bronze = ingest.stream_bronze(spark, schemas.ROUTES, f"{root}/bronze")
        running.append(changeflow.start_scd1(flow, bronze, f"{root}/checkpoint"))
        running[-1].awaitTermination()
        metrics.store(spark, running)
    finally:
        spark.streams.removeListener(metrics)
    return observed.totals(observed.read_metrics(spark, f"{root}/metrics"))


@query(
    "q_next_of_type",
    """SELECT event_id, event_type, lead(event_id) OVER w AS next_event_id, lead(user_id) OVER w AS next_user_id FROM events
       WINDOW w AS (PARTITION BY event_type ORDER BY ts, event_id)""",
)
def next_of_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The next event of the same type: five keys hold all rows."""
    events = feed.table(spark, sf_dir, "events")
    picks = {"next_event_id": F.col("event_id"), "next_user_id": F.col("user_id")}
    order = [F.col("ts"), F.col("event_id")]
    return with_neighbour(events, ["event_type"], order, picks).select("event_id", "event_type", *picks)


@query(
    "q_dedup_latest",
    """SELECT user_id, event_type, date_trunc('hour', ts) AS hour, event_id, value FROM events
       WHERE props NOT LIKE '%"k": 1}%'
       QUALIFY row_number() OVER (PARTITION BY user_id, event_type, date_trunc('hour', ts) ORDER BY event_id DESC) = 1""",
)
def dedup_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = feed.table(spark, sf_dir, "events").where(~F.col("props").contains('"k": 1}'))
    events = events.withColumn("hour", F.date_trunc("hour", "ts").cast("timestamp_ntz"))
    latest = keep_latest(events, ["user_id", "event_type", "hour"], [F.col("event_id").desc()])
    return latest.select("user_id", "event_type", "hour", "event_id", "value")


@query(
    "q_scd1_routes",
    f"""SELECT * EXCLUDE (gtfs_snapshot_date) FROM ({feed.SQL['customer_routes']})
        QUALIFY row_number() OVER (PARTITION BY route_id ORDER BY gtfs_snapshot_date DESC) = 1""",
)
def scd1_routes(spark: SparkSession, sf_dir: str) -> DataFrame:
    snapshots = drop_violations(feed.customer_routes(spark, sf_dir), not_null("route_id"))
    return scd1(snapshots, ["route_id"], schemas.SNAPSHOT_DATE, [schemas.SNAPSHOT_DATE])


@query(
    "q_scd2_stops",
    _final([("stops", feed.SQL["stops"])], Q.versions("stops", "stop_id", Q.STOP_COLUMNS, "gtfs_snapshot_date")),
)
def scd2_stops(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stops(spark, sf_dir)


_SCD1_SQL = f"""SELECT o_custkey, o_orderpriority, o_orderstatus FROM ({feed.SQL['changes']})
    QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY seq DESC) = 1"""
_SCD2_SQL = _final(
    [("feed", feed.SQL["changes"])], Q.versions("feed", "o_custkey", ["o_orderpriority", "o_orderstatus"], "seq")
)


@query("q_scd1", _SCD1_SQL)
def scd1_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scd1(feed.changes(spark, sf_dir), ["o_custkey"], "seq", ["seq"])


@query("q_scd2", _SCD2_SQL)
def scd2_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scd2(feed.changes(spark, sf_dir), ["o_custkey"], "seq", ["seq"])


@query("q_scd2_current", f'SELECT * FROM ({_SCD2_SQL}) WHERE "__END_AT" IS NULL')
def scd2_current(spark: SparkSession, sf_dir: str) -> DataFrame:
    return current_versions(scd2_batch(spark, sf_dir))


@query(
    "q_scd2_as_of",
    f"""SELECT * FROM ({_SCD2_SQL})
        WHERE "__START_AT" <= '{AS_OF}' AND ("__END_AT" IS NULL OR '{AS_OF}' < "__END_AT")""",
)
def scd2_as_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    return versions_as_of(scd2_batch(spark, sf_dir), AS_OF)


def _two_deliveries(spark: SparkSession, sf_dir: str, root: str, fold: Callable[[DataFrame], None]) -> None:
    """The change feed in two deliveries; the second is mostly new rows, with some late ones."""
    rows = feed.changes(spark, sf_dir)
    order_number = F.substring("seq", -12, 12).cast("long")
    second = (F.substring("seq", 1, 10) >= FOLLOW_UP) | (F.pmod(order_number, F.lit(50)) == 0)
    for delivery in (rows.where(~second), rows.where(second)):
        delivery.write.mode("append").parquet(f"{root}/feed")
        fold(spark.readStream.schema(rows.schema).parquet(f"{root}/feed"))


@query("q_scd1_incremental", _SCD1_SQL)
def scd1_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = shared_dir(spark, "scd1")
    flow = changeflow.ChangeFlow(f"{root}/target", ("o_custkey",), "seq", ("seq",), not_null("o_custkey"))
    _two_deliveries(
        spark, sf_dir, root, lambda stream: changeflow.run_scd1(flow, stream, f"{root}/checkpoint")
    )
    return changeflow.read_state(spark, flow)


@query("q_scd2_incremental", _SCD2_SQL)
def scd2_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = shared_dir(spark, "scd2")
    flow = changeflow.ChangeFlow(f"{root}/target", ("o_custkey",), "seq", ("seq",), not_null("o_custkey"))
    _two_deliveries(
        spark,
        sf_dir,
        root,
        lambda stream: changeflow.run_scd2(
            flow, stream, lambda session: session.read.parquet(f"{root}/feed"), f"{root}/checkpoint"
        ),
    )
    return changeflow.read_state(spark, flow)


_NULL_KEYS = f"SELECT * REPLACE (CASE WHEN o_custkey % 10 > 0 THEN o_custkey END AS o_custkey) FROM ({feed.SQL['changes']})"


@query(
    "q_scd2_null_keys",
    _final([("feed", _NULL_KEYS)], Q.versions("feed", "o_custkey", ["o_orderpriority", "o_orderstatus"], "seq")),
)
def scd2_null_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The incremental flow without an expectation, where a tenth of the keys are NULL and count as one key."""
    root = shared_dir(spark, "scd2-null")
    flow = changeflow.ChangeFlow(f"{root}/target", ("o_custkey",), "seq", ("seq",))
    key = F.when(F.pmod("o_custkey", F.lit(10)) > 0, F.col("o_custkey"))

    def fold(stream: DataFrame) -> None:
        def history(session: SparkSession) -> DataFrame:
            return session.read.parquet(f"{root}/feed").withColumn("o_custkey", key)

        changeflow.run_scd2(flow, stream.withColumn("o_custkey", key), history, f"{root}/checkpoint")

    _two_deliveries(spark, sf_dir, root, fold)
    return changeflow.read_state(spark, flow)


@query(
    "q_latest_snapshot", "SELECT * FROM orders WHERE o_orderdate = (SELECT max(o_orderdate) FROM orders)"
)
def latest_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return latest_snapshot(feed.table(spark, sf_dir, "orders"), "o_orderdate")


# --- segments ---------------------------------------------------------------------------------


@query(
    "q_segments",
    _final(
        [("stop_times", feed.SQL["stop_times"]), ("paired", Q.PAIRED)],
        f"""SELECT trip_id, stop_id, dest_stop_id, stop_sequence, departure_time, dest_arrival_time,
            {Q.seconds('dest_arrival_time')} - {Q.seconds('departure_time')} AS seconds,
            ROUND(COALESCE(dest_dist, 0) - COALESCE(shape_dist_traveled, 0), 3) AS km
            FROM paired WHERE dest_stop_id IS NOT NULL""",
    ),
)
def stop_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    paired = segments.stop_segments(latest_snapshot(feed.stop_times(spark, sf_dir), schemas.SNAPSHOT_DATE))
    return paired.select(
        "trip_id",
        "stop_id",
        "dest_stop_id",
        "stop_sequence",
        "departure_time",
        "dest_arrival_time",
        segments.segment_seconds(F.col("departure_time"), F.col("dest_arrival_time")).alias("seconds"),
        segments.segment_distance_km(F.col("shape_dist_traveled"), F.col("dest_dist")).alias("km"),
    )


@query("q_segments_joined", _final(Q.segment_parts(), "SELECT * FROM segments"))
def segments_all_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _segments(spark, sf_dir)


@query("q_segments_current", _final(Q.segment_parts("current"), "SELECT * FROM segments"))
def segments_current(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _segments(spark, sf_dir, "current")


@query("q_segments_as_of", _final(Q.segment_parts("as_of"), "SELECT * FROM segments"))
def segments_as_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _segments(spark, sf_dir, "as_of")


# --- expressions ------------------------------------------------------------------------------


@query(
    "q_clock_parse",
    f"""SELECT event_id, text, CAST(({Q.seconds('text')}) AS INTEGER) AS seconds,
        CAST(split_part(text, ':', 1) AS INTEGER) AS hour
        FROM (SELECT event_id, printf('%02d:%02d:%02d', hour(ts) + user_id % 5, minute(ts), second(ts)) AS text
              FROM events)""",
)
def clock_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.format_string(
        "%02d:%02d:%02d", F.hour("ts") + F.pmod("user_id", F.lit(5)), F.minute("ts"), F.second("ts")
    )
    rows = feed.table(spark, sf_dir, "events").select("event_id", text.alias("text"))
    return rows.withColumns(
        {"seconds": clock.clock_to_seconds(F.col("text")), "hour": clock.clock_hour(F.col("text"))}
    )


@query(
    "q_clock_format",
    """SELECT event_id, s AS seconds, printf('%02d:%02d:%02d', s // 3600, (s // 60) % 60, s % 60) AS text
       FROM (SELECT event_id, CAST(event_id * 37 % 100000 AS INTEGER) AS s FROM events)""",
)
def clock_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    seconds = F.pmod(F.col("event_id") * 37, F.lit(100_000)).cast("int")
    rows = feed.table(spark, sf_dir, "events").select("event_id", seconds.alias("seconds"))
    return rows.withColumn("text", clock.seconds_to_clock(F.col("seconds")))


@query(
    "q_severity",
    f"SELECT event_id, congestion_ratio, {Q.SEVERITY} AS severity "
    "FROM (SELECT event_id, ROUND(1e0 + value / 5e1, 3) AS congestion_ratio FROM events)",
)
def severity(spark: SparkSession, sf_dir: str) -> DataFrame:
    ratio = F.round(1.0 + F.col("value") / 50.0, 3)
    rows = feed.table(spark, sf_dir, "events").select("event_id", ratio.alias("congestion_ratio"))
    return rows.withColumn("severity", labels.congestion_severity(F.col("congestion_ratio")))


@query("q_time_dims", f"SELECT * REPLACE (CAST(poll_date AS VARCHAR) AS poll_date) FROM (SELECT event_id, {Q.time_dims('ts')} FROM events)")
def time_dims(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = readings.time_columns(F.col("ts"))
    return _dates_as_text(feed.table(spark, sf_dir, "events").select("event_id", *[v.alias(k) for k, v in parts.items()]))


# --- readings and analyses ------------------------------------------------------------------


@query("q_traffic_readings", _final(Q.readings_parts(), "SELECT * REPLACE (CAST(poll_date AS VARCHAR) AS poll_date) FROM readings"))
def cleaned_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _dates_as_text(_readings(spark, sf_dir))


@query("q_route_hour_schedule", _final([*Q.segment_parts(), ("schedule", Q.SCHEDULE)], "SELECT * FROM schedule"))
def route_hour_schedule(spark: SparkSession, sf_dir: str) -> DataFrame:
    return delays.route_hour_schedule(_segments(spark, sf_dir))


def _comparison(spark: SparkSession, sf_dir: str) -> DataFrame:
    return delays.schedule_vs_actual(_segments(spark, sf_dir), _readings(spark, sf_dir))


@query("q_schedule_vs_actual", _final(Q.comparison_parts(), f"{_REPORT_DATE_AS_TEXT} FROM comparison"))
def schedule_vs_actual(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _dates_as_text(_comparison(spark, sf_dir))


@query(
    "q_hourly_join",
    _final(
        Q.comparison_parts(),
        """SELECT route_type, hour_of_day, day_type, COUNT(*) AS pairs, SUM(delay_seconds) AS delay_seconds,
           CAST(SUM(actual_seconds) AS BIGINT) AS actual_seconds FROM comparison GROUP BY ALL""",
    ),
)
def hourly_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        _comparison(spark, sf_dir)
        .groupBy("route_type", "hour_of_day", "day_type")
        .agg(
            F.count(F.lit(1)).alias("pairs"),
            F.sum("delay_seconds").alias("delay_seconds"),
            F.sum("actual_seconds").alias("actual_seconds"),
        )
    )


def _comparable(patterns: DataFrame) -> DataFrame:
    """Shares as doubles: the two engines give them different decimal types."""
    shares = ("pct_delayed", "pct_on_time")
    return patterns.withColumns({c: F.col(c).cast("double") for c in shares})


@query("q_route_delay", _final([*Q.comparison_parts(), ("delays", Q.DELAYS)], "SELECT * FROM delays"))
def route_delay(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _comparable(delays.route_delay_patterns_of(_segments(spark, sf_dir), _readings(spark, sf_dir)))


@query("q_route_delay_from_comparison", QUERIES["q_route_delay"].sql)
def route_delay_from_comparison(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _comparable(delays.route_delay_patterns(_comparison(spark, sf_dir)))


@query(
    "q_exact_percentiles",
    """SELECT o_orderpriority, ROUND(quantile_cont(o_totalprice, 0.5), 4) AS median_price,
       ROUND(quantile_cont(o_totalprice, 0.95), 4) AS p95_price FROM orders GROUP BY ALL""",
)
def exact_percentiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Percentiles of fractions; whole seconds are covered by the delay patterns."""
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    folded = orders.groupBy("o_orderpriority", "o_totalprice").agg(F.count(F.lit(1)).alias("n"))
    names = {"median_price": 0.5, "p95_price": 0.95}
    found = quantiles.exact_quantiles(folded, ["o_orderpriority"], "o_totalprice", "n", names)
    return found.withColumns({name: measures.steady_round(F.col(name), 4) for name in names})


@query("q_daily_summary",_final(Q.readings_parts(), f"{_REPORT_DATE_AS_TEXT} FROM ({Q.DAILY})"))
def daily_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _dates_as_text(corridor_plans.corridor_daily_summary(_readings(spark, sf_dir)))


@query("q_congestion_patterns", _final(Q.readings_parts(), Q.PATTERNS))
def congestion_patterns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corridor_plans.congestion_patterns(_readings(spark, sf_dir), EXACT_ACCURACY)


@query("q_congestion_default", QUERIES["q_congestion_patterns"].sql)
def congestion_default(spark: SparkSession, sf_dir: str) -> DataFrame:
    """At the accuracy that users get; it is exact where a group has fewer readings than that."""
    return corridor_plans.congestion_patterns(_readings(spark, sf_dir))


@query("q_congestion_merged", QUERIES["q_congestion_patterns"].sql)
def congestion_merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """From one stored state per date, sketches included, merged."""
    path = shared_dir(spark, "congestion-state")
    corridor_plans.congestion_state(_readings(spark, sf_dir)).write.partitionBy("poll_date").parquet(path)
    return corridor_plans.congestion_patterns_of(spark.read.parquet(path))


@query(
    "q_typical_value",
    _final(
        Q.readings_parts(),
        """SELECT corridor_id, day_type, mode() WITHIN GROUP (ORDER BY congestion_severity) AS typical_severity
           FROM readings GROUP BY ALL""",
    ),
)
def typical_value(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = {s: F.count_if(F.col("congestion_severity") == s) for s in labels.SEVERITIES}
    return (
        _readings(spark, sf_dir)
        .groupBy("corridor_id", "day_type")
        .agg(measures.most_frequent(counts).alias("typical_severity"))
    )


# --- corridor geometry ----------------------------------------------------------------------


@query(
    "q_haversine",
    _final([("corridors", feed.SQL["corridors"])], f"SELECT corridor_id, ROUND({Q.KM}, 6) AS km FROM ({Q.CHORD})"),
)
def haversine(spark: SparkSession, sf_dir: str) -> DataFrame:
    flat = corridor_source.flatten_corridors(feed.corridors(spark, sf_dir))
    km = geo.haversine_km(F.col("origin_lat"), F.col("origin_lng"), F.col("dest_lat"), F.col("dest_lng"))
    return flat.select("corridor_id", F.round(km, 6).alias("km"))


@query(
    "q_free_flow",
    _final(
        [("corridors", feed.SQL["corridors"])],
        f"SELECT corridor_id, speed_limit_kmh, distance_meters, static_duration_seconds FROM ({Q.GEOMETRY})",
    ),
)
def free_flow(spark: SparkSession, sf_dir: str) -> DataFrame:
    flat = corridor_source.flatten_corridors(feed.corridors(spark, sf_dir))
    return corridor_source.with_geometry(flat).select(
        "corridor_id", "speed_limit_kmh", "distance_meters", "static_duration_seconds"
    )


_GRID_DAY, _GRID_DAYS = "2026-03-22", 7
_GRID_SQL = f"""SELECT *, TIMESTAMP '{_GRID_DAY}' + to_days(CAST(d AS INTEGER)) + to_minutes(300 + 15 * q) AS polled_at
    FROM corridors, range({_GRID_DAYS}) AS days(d), range(76) AS quarters(q)"""


@query(
    "q_poll_grid", _final([("corridors", feed.SQL["corridors"])], f"SELECT corridor_id, polled_at FROM ({_GRID_SQL})")
)
def poll_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    flat = corridor_source.flatten_corridors(feed.corridors(spark, sf_dir))
    return corridor_source.poll_grid(flat, _GRID_DAY, _GRID_DAYS).select("corridor_id", "polled_at")


@query(
    "q_grid_readings",
    _final(
        [("corridors", feed.SQL["corridors"]), ("geometry", Q.GEOMETRY), ("grid", _GRID_SQL.replace("corridors,", "geometry,"))],
        """SELECT corridor_id, corridor_name, origin_lat, origin_lng, dest_lat, dest_lng,
           CAST(trunc(static_duration_seconds * congestion_ratio) AS INTEGER) AS duration_seconds,
           static_duration_seconds, distance_meters, congestion_ratio,
           '{"status":"OK","corridor":"' || corridor_id || '"}' AS api_response_json, polled_at
           FROM (SELECT *, ROUND(1e0 + ((hour(polled_at) * 13 + num_lanes * 7) % 120) / 1e2, 3) AS congestion_ratio
                 FROM grid)""",
    ),
)
def grid_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    flat = corridor_source.flatten_corridors(feed.corridors(spark, sf_dir))
    ratio = 1.0 + F.pmod(F.hour("polled_at") * 13 + F.col("num_lanes") * 7, F.lit(120)) / 100.0
    return corridor_source.readings_from_grid(corridor_source.poll_grid(flat, _GRID_DAY, _GRID_DAYS), ratio)


# --- everything in one run ---------------------------------------------------------------------


def _delivered(spark: SparkSession, sf_dir: str, root: str, polled: list[DataFrame]) -> str:
    """The feeds written as files, the readings in several deliveries with a whole run after each; returns the schema."""
    landing, schema = f"{root}/schedule", "headway_" + root[-12:]
    flow = Workflow(landing, f"{root}/traffic", f"{root}/storage", schema, tables=f"{root}/tables", layout="by_file")
    with shuffles_freed(spark):
        for dataset, rows in (
            (schemas.ROUTES, feed.routes),
            (schemas.STOPS, feed.stops),
            (schemas.TRIPS, feed.trips),
            (schemas.STOP_TIMES, feed.stop_times),
        ):
            feeds.write_schedule_snapshots(rows(spark, sf_dir), landing, dataset, F.col(schemas.SNAPSHOT_DATE), compressed=True)
        for delivery in polled:
            feeds.write_traffic_days(delivery, f"{root}/traffic", compressed=True)
            run_all(spark, flow)
    return schema


def _thousandths(ratio: str) -> Column:
    return F.round(F.col(ratio) * 1000).cast("long")


def _delivered_totals() -> dict[str, tuple]:
    """Result: its table, and what is added up of it."""
    ratios = [_thousandths(f"{name}_congestion_ratio") for name in ("median", "p95")]
    return {
        "delays": ("gold_route_delay_patterns", "sample_size", "median_delay_seconds", "pct_delayed"),
        "patterns": ("gold_congestion_patterns", "num_observations", *ratios),
        "daily": ("gold_corridor_daily_summary", "num_readings", "avg_duration_seconds", "avg_distance_meters"),
        "comparison": ("gold_schedule_vs_actual", "actual_seconds", "delay_seconds", "scheduled_seconds"),
    }


def _polled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feed.traffic(spark, sf_dir, every_event=True).drop(schemas.SOURCE_FILE, schemas.ARRIVAL_TIME)


@query("q_workflow", _final([*Q.comparison_parts(every_event=True), ("delays", Q.DELAYS)], "SELECT * FROM delays"))
def workflow(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Feeds written as files, then ingest, change tracking, analyses and snapshots as one run."""
    schema = _delivered(spark, sf_dir, shared_dir(spark, "workflow"), [_polled(spark, sf_dir)])
    return _comparable(spark.table(f"{schema}_physical.gold_route_delay_patterns"))


@query(
    "q_workflow_two_deliveries",
    _final(
        [*Q.comparison_parts(every_event=True), ("delays", Q.DELAYS), ("patterns", Q.PATTERNS), ("daily", Q.DAILY)],
        """SELECT 'delays' AS result, hour_of_day, day_type, COUNT(*) AS rows, SUM(sample_size)::BIGINT AS n,
                  SUM(median_delay_seconds) AS a, ROUND(SUM(pct_delayed), 1) AS b FROM delays GROUP BY ALL
           UNION ALL SELECT 'patterns', hour_of_day, day_type, COUNT(*), SUM(num_observations)::BIGINT,
                  SUM(CAST(median_congestion_ratio * 1000 AS BIGINT)) + 0e0, SUM(CAST(p95_congestion_ratio * 1000 AS BIGINT)) + 0e0
                  FROM patterns GROUP BY ALL
           UNION ALL SELECT 'daily', NULL, day_type, COUNT(*), SUM(num_readings)::BIGINT, SUM(avg_duration_seconds) + 0e0,
                  SUM(avg_distance_meters) + 0e0 FROM daily GROUP BY ALL
           UNION ALL SELECT 'comparison', hour_of_day, day_type, COUNT(*), SUM(actual_seconds)::BIGINT, SUM(delay_seconds),
                  SUM(scheduled_seconds) FROM comparison GROUP BY ALL""",
    ),
)
def workflow_two_deliveries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Later dates, and a few late readings of earlier ones, come in a second delivery; all results are those of one."""
    polled = _polled(spark, sf_dir)
    second = (F.dayofmonth("polled_at") > 20) | ((F.dayofmonth("polled_at") == 3) & (F.hour("polled_at") == 9))
    schema = _delivered(spark, sf_dir, shared_dir(spark, "deliveries"), [polled.where(~second), polled.where(second)])
    found = []
    for result, (table, *measured) in _delivered_totals().items():
        rows = spark.table(f"{schema}_physical.{table}")
        hour = F.col("hour_of_day") if "hour_of_day" in rows.columns else F.lit(None).cast("int")
        n, a, b = measured
        totals = [F.sum(n).alias("n"), F.round(F.sum(a), 1).cast("double").alias("a"), F.round(F.sum(b), 1).cast("double").alias("b")]
        summed = rows.groupBy(hour.alias("hour_of_day"), "day_type").agg(F.count(F.lit(1)).alias("rows"), *totals)
        found.append(summed.withColumn("result", F.lit(result)))
    return reduce(DataFrame.unionByName, found)
