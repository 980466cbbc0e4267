from datetime import datetime

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from headway.functions import clock, geo, labels, measures
from headway.plans.readings import time_columns
from headway.sources.corridors import readings_from_grid, poll_grid, with_geometry


def column_of(spark, values, ddl, expression):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i INT, v {ddl}")
    return [r[0] for r in df.orderBy("i").select(expression(F.col("v"))).collect()]


def test_severity_bounds_and_null(spark):
    ratios = [1.0999, 1.1, 1.3, 1.6, 2.0, None]
    expected = ["free_flow", "light", "moderate", "heavy", "severe", "severe"]
    assert column_of(spark, ratios, "DOUBLE", labels.congestion_severity) == expected


def test_time_period_bounds(spark):
    hours = [6, 7, 9, 10, 15, 16, 18, 19, 21, 22]
    expected = ["overnight"] + ["morning_rush"] * 2 + ["midday"] * 2 + ["evening_rush"] * 2 + ["evening"] * 2 + ["overnight"]
    assert column_of(spark, hours, "INT", labels.time_period) == expected


def test_route_type_labels(spark):
    assert column_of(spark, [1, 2, 3, 4, 7, None], "INT", labels.route_type_label) == [
        "subway",
        "rail",
        "bus",
        "ferry",
        "other",
        "other",
    ]


def test_clock_parsing_survives_bad_text(spark):
    texts = ["24:03:05", "05:10:00", "10:20", "aa:00:00", "", None]
    assert column_of(spark, texts, "STRING", clock.clock_to_seconds) == [86585, 18600, None, None, None, None]
    assert column_of(spark, texts, "STRING", clock.clock_hour) == [24, 5, 10, None, None, None]


@settings(max_examples=5, deadline=None)
@given(st.lists(st.integers(0, 400_000), min_size=1, max_size=200))
def test_clock_formatting_is_the_inverse_of_parsing(spark, seconds):
    texts = column_of(spark, seconds, "INT", clock.seconds_to_clock)
    assert texts == [f"{s // 3600:02d}:{s // 60 % 60:02d}:{s % 60:02d}" for s in seconds]
    assert column_of(spark, texts, "STRING", clock.clock_to_seconds) == seconds


def test_snapshot_date_is_never_empty_for_a_dated_path(spark):
    paths = ["/x/2026-03-08/stops.txt", "/x/snapshot_date=2026-03-08/part-0.csv", "/2026-03-08/2026-04-01/a", "/none/a"]
    assert column_of(spark, paths, "STRING", clock.snapshot_date_in) == ["2026-03-08"] * 3 + [""]


def test_time_columns_and_weekdays(spark):
    # 2026-03-22 is a Sunday, 2026-03-28 a Saturday, 2026-03-23 a Monday.
    moments = [datetime(2026, 3, 22, 5), datetime(2026, 3, 28, 23, 45), datetime(2026, 3, 23, 8)]
    df = spark.createDataFrame([(m,) for m in moments], "polled_at TIMESTAMP")
    got = df.orderBy("polled_at").select(*[v.alias(k) for k, v in time_columns(F.col("polled_at")).items()]).collect()
    assert [(r.hour_of_day, r.day_of_week, str(r.poll_date), r.time_period, r.day_type) for r in got] == [
        (5, 1, "2026-03-22", "overnight", "weekend"),
        (8, 2, "2026-03-23", "morning_rush", "weekday"),
        (23, 7, "2026-03-28", "overnight", "weekend"),
    ]


def test_delay_pct_of_zero_schedule_is_null(spark):
    df = spark.createDataFrame([(100, 0.0), (150, 100.0)], "a INT, s DOUBLE")
    assert [r[0] for r in df.select(measures.delay_pct(F.col("a"), F.col("s"))).collect()] == [None, 50.0]


def test_steady_round_ignores_the_order_of_summation(spark):
    df = spark.createDataFrame([(1.2034999999999998,), (1.2035000000000002,)], "v DOUBLE")
    assert [r[0] for r in df.select(measures.steady_round(F.col("v"), 3)).collect()] == [1.204, 1.204]


def test_most_frequent_takes_the_first_label_on_a_tie(spark):
    df = spark.createDataFrame([("b",), ("a",), ("a",), ("b",)], "v STRING")
    counts = {v: F.count_if(F.col("v") == v) for v in ("b", "a", "c")}
    assert df.agg(measures.most_frequent(counts)).first()[0] == "a"


def test_share_is_an_exact_decimal(spark):
    df = spark.createDataFrame([(1, 16), (3, 2000)], "part LONG, whole LONG")
    shares = [str(r[0]) for r in df.select(measures.share_pct(F.col("part"), F.col("whole"))).collect()]
    assert shares == ["6.3", "0.2"]


# Corridor end points with the distances and free-flow times worked out independently.
GEOMETRY = [
    ("near", 49.2575, -123.0680, 49.2660, -123.0789, 50, 1232, 88),
]


@pytest.mark.parametrize("name,olat,olng,dlat,dlng,speed,metres,seconds", GEOMETRY)
def test_corridor_geometry(spark, name, olat, olng, dlat, dlng, speed, metres, seconds):
    df = spark.createDataFrame(
        [(name, olat, olng, dlat, dlng, speed)],
        "corridor_id STRING, origin_lat DOUBLE, origin_lng DOUBLE, dest_lat DOUBLE, dest_lng DOUBLE, speed_limit_kmh INT",
    )
    got = with_geometry(df).first()
    assert (got.distance_meters, got.static_duration_seconds) == (metres, seconds)


def test_free_flow_has_a_floor_and_truncates(spark):
    df = spark.createDataFrame([(0.1, 60), (10.0, 70)], "km DOUBLE, v INT")
    assert [r[0] for r in df.select(geo.free_flow_seconds(F.col("km"), F.col("v"))).collect()] == [60, 514]
    assert df.select(geo.congested_seconds(F.lit(88), F.lit(1.203))).first()[0] == 105


def test_poll_grid_covers_each_day_from_5_to_2345(spark):
    corridors = spark.createDataFrame(
        [("c1", "C 1", 49.2575, -123.068, 49.266, -123.0789, 50)],
        "corridor_id STRING, corridor_name STRING, origin_lat DOUBLE, origin_lng DOUBLE, dest_lat DOUBLE, "
        "dest_lng DOUBLE, speed_limit_kmh INT",
    )
    grid = poll_grid(corridors, "2026-03-22", 7)
    low, high, n = grid.agg(F.min("polled_at"), F.max("polled_at"), F.count_distinct("polled_at")).first()
    assert (low, high, n, grid.count()) == (datetime(2026, 3, 22, 5), datetime(2026, 3, 28, 23, 45), 532, 532)
    reading = readings_from_grid(grid, F.lit(1.203)).first()
    assert (reading.duration_seconds, reading.static_duration_seconds, reading.distance_meters) == (105, 88, 1232)
    assert reading.api_response_json == '{"status":"OK","corridor":"c1"}'
