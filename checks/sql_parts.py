"""Building blocks of the comparison SQL: the datasets as common table expressions."""

from __future__ import annotations

from checks.transit_tables import SQL


def with_(*parts: tuple[str, str]) -> str:
    return "WITH " + ",\n".join(f"{name} AS ({body})" for name, body in parts)


def steady(value: str, digits: int) -> str:
    """Half-up rounding of a sum-dependent double, blind to its last bits."""
    return f"CAST(ROUND(CAST({value} AS DECIMAL(18, 9)), {digits}) AS DOUBLE)"


def decimal_round(value: str, digits: int) -> str:
    """Half-up rounding of the shortest decimal form of a double."""
    return f"CAST(ROUND(CAST(CAST({value} AS VARCHAR) AS DECIMAL(38, 17)), {digits}) AS DOUBLE)"


def versions(source: str, key: str, tracked: list[str], sequence: str) -> str:
    """Type 2 history by gaps and islands; sequence values do not repeat within a key."""
    changed = " OR ".join(
        f"{c} IS DISTINCT FROM lag({c}) OVER (PARTITION BY {key} ORDER BY {sequence})" for c in tracked
    )
    return f"""SELECT {key}, {', '.join(tracked)}, {sequence} AS "__START_AT",
        lead({sequence}) OVER (PARTITION BY {key} ORDER BY {sequence}) AS "__END_AT"
        FROM (SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY {sequence}) = 1 OR {changed} AS changed
              FROM {source}) WHERE changed"""


SEVERITY = """CASE WHEN congestion_ratio < 1.1::DOUBLE THEN 'free_flow' WHEN congestion_ratio < 1.3::DOUBLE THEN 'light'
    WHEN congestion_ratio < 1.6::DOUBLE THEN 'moderate' WHEN congestion_ratio < 2.0::DOUBLE THEN 'heavy' ELSE 'severe' END"""


def time_dims(moment: str) -> str:
    return f"""CAST(hour({moment}) AS INTEGER) AS hour_of_day, CAST(dayofweek({moment}) + 1 AS INTEGER) AS day_of_week,
    CAST({moment} AS DATE) AS poll_date,
    CASE WHEN hour({moment}) BETWEEN 7 AND 9 THEN 'morning_rush' WHEN hour({moment}) BETWEEN 10 AND 15 THEN 'midday'
         WHEN hour({moment}) BETWEEN 16 AND 18 THEN 'evening_rush' WHEN hour({moment}) BETWEEN 19 AND 21 THEN 'evening'
         ELSE 'overnight' END AS time_period,
    CASE WHEN dayofweek({moment}) IN (0, 6) THEN 'weekend' ELSE 'weekday' END AS day_type"""


def seconds(clock: str) -> str:
    return (
        f"(CAST(split_part({clock}, ':', 1) AS INTEGER) * 3600 + CAST(split_part({clock}, ':', 2) AS INTEGER) * 60"
        f" + CAST(split_part({clock}, ':', 3) AS INTEGER))"
    )


DEDUPED = """SELECT * FROM bronze WHERE api_response_json NOT LIKE '%"error"%'
    AND corridor_id IS NOT NULL AND polled_at IS NOT NULL
    QUALIFY row_number() OVER (PARTITION BY corridor_id, polled_at
                               ORDER BY _file_arrival_time DESC, _source_file DESC) = 1"""

READINGS = f"""SELECT corridor_id, corridor_name, origin_lat, origin_lng, dest_lat, dest_lng, duration_seconds,
    static_duration_seconds, distance_meters, congestion_ratio, {SEVERITY} AS congestion_severity,
    {time_dims('polled_at')}, polled_at, _source_file FROM ({DEDUPED})"""


def readings_parts(every_event: bool = False) -> list[tuple[str, str]]:
    return [("bronze", SQL["traffic_every_event" if every_event else "traffic"]), ("readings", READINGS)]


STOP_COLUMNS = [
    "stop_code",
    "stop_name",
    "stop_desc",
    "stop_lat",
    "stop_lon",
    "zone_id",
    "stop_url",
    "location_type",
    "parent_station",
    "wheelchair_boarding",
]

PAIRED = """SELECT *, lead(stop_id) OVER w AS dest_stop_id, lead(arrival_time) OVER w AS dest_arrival_time,
    lead(shape_dist_traveled) OVER w AS dest_dist
    FROM stop_times WHERE gtfs_snapshot_date = (SELECT max(gtfs_snapshot_date) FROM stop_times)
    WINDOW w AS (PARTITION BY trip_id
                 ORDER BY stop_sequence, departure_time, arrival_time, stop_id, shape_dist_traveled)"""

ROUTE_TYPE = """CASE r.route_type WHEN 1 THEN 'subway' WHEN 2 THEN 'rail' WHEN 3 THEN 'bus' WHEN 4 THEN 'ferry'
    ELSE 'other' END"""

STOP_CONDITIONS = {
    "all_versions": "",
    "current": ' AND {v}."__END_AT" IS NULL',
    "as_of": ' AND {v}."__START_AT" <= p.gtfs_snapshot_date'
    ' AND ({v}."__END_AT" IS NULL OR p.gtfs_snapshot_date < {v}."__END_AT")',
}


def segments(mode: str = "all_versions") -> str:
    condition = STOP_CONDITIONS[mode]
    return f"""SELECT t.route_id, r.route_short_name AS route_name, r.route_long_name, {ROUTE_TYPE} AS route_type,
    t.trip_headsign, t.direction_id, t.service_id,
    p.stop_id AS origin_stop_id, o.stop_name AS origin_stop_name, o.stop_lat AS origin_lat, o.stop_lon AS origin_lon,
    p.dest_stop_id, d.stop_name AS dest_stop_name, d.stop_lat AS dest_lat, d.stop_lon AS dest_lon,
    p.stop_sequence, p.departure_time, p.dest_arrival_time AS arrival_time,
    {seconds('p.dest_arrival_time')} - {seconds('p.departure_time')} AS scheduled_segment_seconds,
    ROUND(COALESCE(p.dest_dist, 0) - COALESCE(p.shape_dist_traveled, 0), 3) AS segment_distance_km,
    CAST(split_part(p.departure_time, ':', 1) AS INTEGER) AS departure_hour, p.gtfs_snapshot_date
    FROM paired p
    JOIN trips t ON p.trip_id = t.trip_id AND p.gtfs_snapshot_date = t.gtfs_snapshot_date
    JOIN current_routes r ON t.route_id = r.route_id
    LEFT JOIN stop_versions o ON p.stop_id = o.stop_id{condition.format(v='o')}
    LEFT JOIN stop_versions d ON p.dest_stop_id = d.stop_id{condition.format(v='d')}
    WHERE p.dest_stop_id IS NOT NULL AND p.departure_time IS NOT NULL AND p.dest_arrival_time IS NOT NULL"""


def segment_parts(mode: str = "all_versions") -> list[tuple[str, str]]:
    return [
        ("stop_times", SQL["stop_times"]),
        ("trips", SQL["trips"]),
        (
            "current_routes",
            f"SELECT * FROM ({SQL['routes']}) QUALIFY row_number() OVER "
            "(PARTITION BY route_id ORDER BY gtfs_snapshot_date DESC) = 1",
        ),
        ("stops", SQL["stops"]),
        ("stop_versions", versions("stops", "stop_id", STOP_COLUMNS, "gtfs_snapshot_date")),
        ("paired", PAIRED),
        ("segments", segments(mode)),
    ]


SCHEDULE = """SELECT route_id, route_name, route_type, departure_hour AS hour_of_day, COUNT(*) AS scheduled_segments,
    ROUND(AVG(scheduled_segment_seconds), 0) AS scheduled_seconds FROM segments
    WHERE scheduled_segment_seconds > 0 AND scheduled_segment_seconds < 7200 GROUP BY ALL"""

COMPARISON = f"""SELECT s.route_id, s.route_name, s.route_type, a.corridor_name AS segment_name,
    s.hour_of_day, a.day_type, a.poll_date AS report_date, s.scheduled_seconds, s.scheduled_segments,
    a.duration_seconds AS actual_seconds, a.static_duration_seconds AS free_flow_seconds,
    a.congestion_ratio, a.congestion_severity, a.duration_seconds - s.scheduled_seconds AS delay_seconds,
    {decimal_round('(a.duration_seconds - s.scheduled_seconds) / NULLIF(s.scheduled_seconds, 0) * 100', 1)} AS delay_pct
    FROM schedule s JOIN readings a ON s.hour_of_day = a.hour_of_day WHERE a.duration_seconds IS NOT NULL"""

DELAYS = f"""SELECT route_id, route_name, route_type, hour_of_day, day_type, COUNT(*) AS sample_size,
    ROUND(AVG(delay_seconds), 0) + 0e0 AS avg_delay_seconds,
    {steady('quantile_cont(delay_seconds, 0.5)', 0)} AS median_delay_seconds,
    {steady('quantile_cont(delay_seconds, 0.95)', 0)} AS p95_delay_seconds,
    ROUND(MAX(delay_seconds), 0) + 0e0 AS max_delay_seconds,
    {steady('100e0 * count_if(delay_seconds > 60) / COUNT(*)', 1)} AS pct_delayed,
    {steady('100e0 * count_if(abs(delay_seconds) <= 120) / COUNT(*)', 1)} AS pct_on_time,
    {steady('AVG(congestion_ratio)', 3)} AS avg_congestion_ratio,
    mode() WITHIN GROUP (ORDER BY congestion_severity) AS typical_severity
    FROM comparison WHERE delay_seconds IS NOT NULL GROUP BY ALL HAVING COUNT(*) >= 3"""


def comparison_parts(every_event: bool = False) -> list[tuple[str, str]]:
    return [*segment_parts(), *readings_parts(every_event), ("schedule", SCHEDULE), ("comparison", COMPARISON)]


DAILY = f"""SELECT corridor_id, corridor_name, poll_date AS report_date, day_type, COUNT(*) AS num_readings,
    {steady('AVG(congestion_ratio)', 3)} AS avg_congestion_ratio, ROUND(MAX(congestion_ratio), 3) AS peak_congestion_ratio,
    CAST(ROUND(AVG(duration_seconds), 0) AS INTEGER) AS avg_duration_seconds,
    CAST(ROUND(AVG(static_duration_seconds), 0) AS INTEGER) AS avg_static_duration_seconds,
    CAST(ROUND(AVG(distance_meters), 0) AS INTEGER) AS avg_distance_meters
    FROM readings GROUP BY ALL"""

PATTERNS = f"""SELECT corridor_id, corridor_name, day_of_week, day_type, hour_of_day, time_period,
    COUNT(*) AS num_observations, {steady('AVG(congestion_ratio)', 3)} AS avg_congestion_ratio,
    ROUND(quantile_disc(congestion_ratio, 0.5), 3) AS median_congestion_ratio,
    ROUND(quantile_disc(congestion_ratio, 0.95), 3) AS p95_congestion_ratio,
    CAST(ROUND(AVG(duration_seconds), 0) AS INTEGER) AS avg_duration_seconds,
    CAST(ROUND(AVG(distance_meters), 0) AS INTEGER) AS avg_distance_meters,
    {', '.join(f"count_if(congestion_severity = '{s}')::BIGINT AS {s}_count"
               for s in ('free_flow', 'light', 'moderate', 'heavy', 'severe'))}
    FROM readings GROUP BY ALL"""

KM = """2 * 6371e0 * atan2(sqrt(a), sqrt(1 - a))"""
CHORD = """SELECT *, pow(sin(radians(dest_lat - origin_lat) / 2), 2) + cos(radians(origin_lat)) * cos(radians(dest_lat))
    * pow(sin(radians(dest_lng - origin_lng) / 2), 2) AS a FROM corridors"""
GEOMETRY = f"""SELECT * EXCLUDE (a, km), km AS distance_km, CAST(trunc(km * 1000) AS INTEGER) AS distance_meters,
    greatest(CAST(trunc(km / speed_limit_kmh * 3600) AS INTEGER), 60) AS static_duration_seconds
    FROM (SELECT *, {KM} AS km FROM ({CHORD}))"""
