"""Large keys cut and spread inside the plan: nothing runs before the query, one shuffle, no overfull task."""

import random
import re
from collections import Counter
from statistics import median

import pytest
from pyspark.sql import functions as F

from headway.functions.labels import DAY_TYPES
from headway.operators.cuts import HotKeys, KeyCuts, _sample
from headway.operators.ordered import neighbour_in_chunks, with_neighbour
from headway.plans import corridors, delays
from headway.plans.segments import scheduled_segments


def skewed(spark, n=8_000):
    """A third of all rows on one key, the rest on a hundred."""
    key = F.when(F.pmod(F.xxhash64("id"), F.lit(3)) == 0, "hot").otherwise(F.concat(F.lit("k"), F.pmod(F.col("id"), F.lit(100))))
    return spark.range(0, n, 1, 8).select(key.alias("k"), F.pmod(F.xxhash64("id", F.lit(2)), F.lit(10**9)).alias("a"), F.col("id").alias("b"))


def jobs_of(spark, work):
    group = f"count-{random.random()}"
    spark.sparkContext.setJobGroup(group, "counted")
    try:
        work()
    finally:
        spark.sparkContext.setJobGroup("", "")
    return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))


def test_building_the_plan_runs_no_job(spark):
    df = skewed(spark)
    built = []
    assert jobs_of(spark, lambda: built.append(with_neighbour(df, ["k"], [F.col("a"), F.col("b")], {"n": F.col("b")}))) == 0
    assert jobs_of(spark, lambda: built[0].count()) > 0


def test_rows_are_shuffled_once(spark):
    plan = with_neighbour(skewed(spark), ["k"], [F.col("a"), F.col("b")], {"n": F.col("b")})
    text = plan._jdf.queryExecution().executedPlan().toString()
    window = text.index("Window [lead")
    main = [line for line in text[window:].splitlines() if "Exchange hashpartitioning(k" in line and "_chunk" in line]
    # One for all rows by key and chunk; the other one is the exchange of a row per chunk.
    assert len(main) <= 2


def test_no_task_gets_much_more_than_the_others(spark):
    df = skewed(spark)
    cuts = KeyCuts.of(df, ["k"], [F.col("a"), F.col("b")], ranges=16)
    assert cuts.table.count() == 1
    found = neighbour_in_chunks(df, cuts, {"n": F.col("b")})
    sizes = [r["count"] for r in found.groupBy("k", "_chunk").count().where("k = 'hot'").collect()]
    assert len(sizes) >= 4 and max(sizes) <= 8_000 / 16 * 2
    assert sum(sizes) == df.where("k = 'hot'").count()


def test_the_sample_is_bounded_whatever_the_rows(spark):
    for n in (500, 50_000):
        keys = KeyCuts.of(skewed(spark, n), ["k"], [F.col("b")], ranges=8).table
        cuts = keys.select(F.size("_cuts").alias("n")).agg(F.sum("n")).first()[0]
        assert cuts <= 8 * 1.5


def test_next_rows_over_cuts_with_ties_and_nulls(spark, rows):
    rng = random.Random(6)
    data = [(rng.choice([None, None, "x", "y"]), rng.choice([None, 1, 2, 3]), i) for i in range(1_500)]
    df = spark.createDataFrame(data, "k STRING, a INT, b INT").repartition(5)
    for step in (1, -1):
        expected = []
        for key in {k for k, *_ in data}:
            group = sorted((r for r in data if r[0] == key), key=lambda r: (r[1] is not None, r[1] or 0, r[2]))
            for i, row in enumerate(group):
                other = group[i + step] if 0 <= i + step < len(group) else None
                expected.append((*row, other and other[2], 1 if other else None))
        got = with_neighbour(df, ["k"], [F.col("a"), F.col("b")], {"n": F.col("b"), "seen": F.lit(1)}, step, ranges=6)
        assert rows(got) == sorted(expected, key=str)


@pytest.mark.parametrize("how", ["inner", "left"])
def test_spread_joins_equal_plain_ones(spark, rows, how):
    left = skewed(spark, 3_000).withColumn("k", F.when(F.col("b") % 10 == 0, None).otherwise(F.col("k")))
    right = spark.createDataFrame([("hot", 1), ("hot", 2), ("k1", 3), (None, 4), ("k5", 5)], "rk STRING, v INT")
    hot = HotKeys.of(left, "k", ranges=8)
    assert Counter(r["_hot_key"] for r in hot.table.collect())["hot"] == 1
    spread = hot.join(left, right, "k", "rk", how)
    assert rows(spread) == rows(left.join(right, F.col("k") == F.col("rk"), how))


def test_spread_joins_leave_no_overfull_task(spark):
    left = skewed(spark, 40_000)
    right = left.select(F.col("k").alias("rk")).distinct()
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        hot = HotKeys.of(left, "k", ranges=64)
        joined = hot.join(left, right.hint("merge"), "k", "rk").withColumn("task", F.spark_partition_id())
        sizes = [r["count"] for r in joined.groupBy("task").count().collect()]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert sum(sizes) == 40_000 and max(sizes) <= 2 * median(sizes)


def test_segments_of_a_hub_and_of_a_very_long_trip(spark, rows):
    """Every second stop is the hub, and one trip has a third of all stops: the same segments as with one range."""
    times = []
    for trip in range(60):
        for i in range(400 if trip == 0 else 12):
            clock = f"{5 + i // 60 % 18:02d}:{i % 60:02d}:00"
            times.append((f"t{trip}", clock, clock, "hub" if i % 2 else f"s{trip}-{i}", i, float(i), "2026-03-15"))
    columns = ("trip_id", "arrival_time", "departure_time", "stop_id", "stop_sequence", "shape_dist_traveled", "gtfs_snapshot_date")
    stop_times = spark.createDataFrame(times, ", ".join(f"{c} {t}" for c, t in zip(columns, ("STRING",) * 4 + ("INT", "DOUBLE", "STRING"), strict=True)))
    trips = spark.createDataFrame([(f"t{t}", "009", "East", 0, "weekday", "2026-03-15") for t in range(60)], "trip_id STRING, route_id STRING, trip_headsign STRING, direction_id INT, service_id STRING, gtfs_snapshot_date STRING")
    routes = spark.createDataFrame([("009", "9", "East/West", 3)], "route_id STRING, route_short_name STRING, route_long_name STRING, route_type INT")
    stops = spark.createDataFrame([("hub", "Hub", 49.0, -123.0, "2026-03-08", "2026-03-12"), ("hub", "Hub 2", 49.0, -123.0, "2026-03-12", None), ("s1-0", "One", 49.0, -123.0, "2026-03-08", None)], "stop_id STRING, stop_name STRING, stop_lat DOUBLE, stop_lon DOUBLE, __START_AT STRING, __END_AT STRING")
    plain = rows(scheduled_segments(stop_times, trips, routes, stops, "all_versions", ranges=1))
    for ranges in (2, 8):
        assert rows(scheduled_segments(stop_times, trips, routes, stops, "all_versions", ranges=ranges)) == plain
    # Every segment touches the hub once, and the hub has two versions.
    assert len(plain) == 2 * (399 + 59 * 11)


def test_shares_equal_a_count_of_all_pairs(spark, rows):
    rng = random.Random(3)
    seen = [(rng.randrange(3), rng.choice(DAY_TYPES), rng.randrange(0, 900), rng.randrange(1, 5)) for _ in range(400)]
    folded = Counter()
    for hour, day, seconds, n in seen:
        folded[hour, day, seconds] += n
    observed = spark.createDataFrame([(*k, n) for k, n in folded.items()], "hour_of_day INT, day_type STRING, actual_seconds INT, n LONG")
    scheduled = {(rng.randrange(4), float(rng.randrange(0, 900))) for _ in range(40)} | {(0, 60.0), (0, 180.0)}
    schedule = spark.createDataFrame(list(scheduled), "hour_of_day INT, scheduled_seconds DOUBLE")
    expected = []
    for hour, planned in scheduled:
        for day in DAY_TYPES:
            own = [(s - planned, n) for (h, d, s), n in folded.items() if (h, d) == (hour, day)]
            expected.append((hour, day, planned, sum(n for d, n in own if d <= 60), sum(n for d, n in own if abs(d) <= 120)))
    got = delays._shares(observed, schedule)
    assert rows(got, "hour_of_day", "day_type", "scheduled_seconds", "until_late", "on_time") == sorted(expected, key=str)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan


def test_merged_sketches_keep_the_stated_error(spark):
    """One group of 300,000 values over 30 dates, against exact ranks, merged and in one pass, at the default accuracy."""
    n = 300_000
    readings = spark.range(n).select(
        *[F.lit("x").alias(c) for c in ("corridor_id", "corridor_name", "day_type", "time_period", "congestion_severity")],
        F.lit(1).alias("day_of_week"),
        F.lit(8).alias("hour_of_day"),
        F.date_add(F.lit("2026-03-01").cast("date"), F.pmod("id", F.lit(30)).cast("int")).alias("poll_date"),
        (F.pmod(F.col("id") * 7919, F.lit(n)) / n * 3).alias("congestion_ratio"),
        F.lit(100).alias("duration_seconds"),
        F.lit(1000).alias("distance_meters"),
    )
    state = corridors.congestion_state(readings)
    assert state.count() == 30
    merged = corridors.congestion_patterns_of(state).first()
    direct = corridors.congestion_patterns(readings).first()
    assert merged.num_observations == direct.num_observations == n
    assert merged.avg_congestion_ratio == direct.avg_congestion_ratio
    for found in (merged, direct):
        # Values are their own ranks, spread evenly over [0, 3); results are rounded to a thousandth.
        for value, rank in ((found.median_congestion_ratio, 0.5), (found.p95_congestion_ratio, 0.95)):
            assert abs(value / 3 - rank) <= 1 / corridors.PERCENTILE_ACCURACY + 0.0005 / 3


def test_groups_without_a_ratio_have_no_percentiles(spark):
    readings = spark.createDataFrame(
        [("c", "C", 1, "weekday", 8, "x", "severe", None, None, 5)],
        "corridor_id STRING, corridor_name STRING, day_of_week INT, day_type STRING, hour_of_day INT, time_period STRING, "
        "congestion_severity STRING, congestion_ratio DOUBLE, duration_seconds INT, distance_meters INT",
    ).withColumn("poll_date", F.current_date())
    found = corridors.congestion_patterns_of(corridors.congestion_state(readings)).first()
    assert (found.num_observations, found.median_congestion_ratio, found.avg_congestion_ratio) == (1, None, None)
    assert (found.avg_duration_seconds, found.avg_distance_meters, found.severe_count) == (None, 5, 1)


def test_the_sample_computes_derived_columns_once(spark):
    derived = spark.range(1_000).select(F.col("id").alias("k"), F.concat(F.lit("at "), F.col("id").cast("string")).alias("at"))
    picked = _sample(derived, [F.col("k"), F.col("at")], 4)
    plan = picked._jdf.queryExecution().optimizedPlan().toString()
    conditions = [line for line in plan.splitlines() if "Filter" in line]
    assert conditions and not any("concat(" in line or "xxhash64(" in line for line in conditions)
    assert picked.columns == ["k", "at"] and 0 < picked.count() < 1_000
    assert sorted(picked.collect()) == sorted(_sample(derived.repartition(5), [F.col("k"), F.col("at")], 4).collect())


def test_a_join_over_salts_does_not_sort_the_large_side(spark):
    left = skewed(spark).withColumn("unique", F.col("b"))
    right = left.select(F.col("k").alias("name"), F.lit(1).alias("found")).distinct()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = HotKeys.of(left, "k", 8).join(left, right, "k", "name", "left")
        assert joined.where("found = 1").count() == 8_000
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "ShuffledHashJoin" in plan and "SortMergeJoin" not in plan
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_small_groups_take_small_sketches_and_all_stay_exact(spark, monkeypatch):
    monkeypatch.setattr(corridors, "SMALL_SKETCH_SIZE", 16)
    group = F.when(F.col("id") < 16, "few").when(F.col("id") < 40, "many").otherwise(F.concat(F.lit("over days"), F.pmod("id", F.lit(3))))
    ratio = F.when(F.pmod("id", F.lit(7)) > 0, F.pmod(F.col("id") * 37, F.lit(101)) / 100)
    day = F.date_add(F.lit("2026-03-01"), F.when(F.col("id") < 40, 0).otherwise(F.pmod("id", F.lit(11)) * 7).cast("int"))
    fixed = {"corridor_name": F.lit(None).cast("string"), "day_of_week": F.lit(1), "day_type": F.lit("weekend"), "hour_of_day": F.lit(8), "time_period": F.lit("morning_rush")}
    measured = {"congestion_ratio": ratio, "duration_seconds": F.col("id").cast("int"), "distance_meters": F.lit(100)}
    readings = spark.range(130).select(group.alias("corridor_id"), day.alias("poll_date"), *[c.alias(k) for k, c in (fixed | measured).items()])
    readings = readings.withColumn("congestion_severity", F.lit("light"))
    state = corridors.congestion_state(readings)
    assert state.count() == state.select("corridor_id", "poll_date").distinct().count()
    described = {r.corridor_id: r.text for r in state.select("corridor_id", F.expr("kll_sketch_to_string_double(ratio_sketch)").alias("text")).collect()}
    size = {key: int(re.search(r"\bK\s*:\s*(\d+)", text)[1]) for key, text in described.items()}
    assert size["few"] == 16 and size["many"] == corridors.SKETCH_SIZE
    expected = sorted(corridors.congestion_patterns(readings, 1_000_000).collect(), key=str)
    assert sorted(corridors.congestion_patterns_of(state).collect(), key=str) == expected
