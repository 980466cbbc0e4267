"""Keep-latest, neighbours and change tracking, against plain Python, on ordinary and on hot keys."""

import random

import pytest
from pyspark.sql import Observation, functions as F

from headway.operators.changes import current_versions, scd1, scd2, versions_as_of
from headway.operators.latest import keep_latest, latest_snapshot
from headway.operators.ordered import neighbour_by_range, split_by_heat, with_neighbour
from headway.operators.quality import drop_violations, not_null


def versions_by_hand(feed):
    """Expected history of (key, sequence, value) rows without repeated (key, sequence)."""
    expected = []
    for key in {k for k, _, _ in feed}:
        run = []
        for _, seq, value in sorted((r for r in feed if r[0] == key), key=lambda r: r[1]):
            if not run or run[-1][1] != value:
                run.append((seq, value))
        for i, (seq, value) in enumerate(run):
            expected.append((key, value, seq, run[i + 1][0] if i + 1 < len(run) else None))
    return sorted(expected, key=str)


def feed_frame(spark, feed, sequence_type="INT"):
    return spark.createDataFrame(feed, f"k STRING, q {sequence_type}, v STRING")


@pytest.mark.parametrize("hot_rows", [None, 1_000_000, 0])
@pytest.mark.parametrize(
    "values,expected",
    [
        ("ABA", [("A", 1, 2), ("B", 2, 3), ("A", 3, None)]),
        ("AAB", [("A", 1, 3), ("B", 3, None)]),
        ("A", [("A", 1, None)]),
        ([None, None, "A", None], [(None, 1, 3), ("A", 3, 4), (None, 4, None)]),
    ],
)
def test_scd2_versions(spark, rows, values, expected, hot_rows):
    df = feed_frame(spark, [("k", i + 1, v) for i, v in enumerate(values)])
    assert rows(scd2(df, ["k"], "q", hot_rows=hot_rows), "v", "__START_AT", "__END_AT") == sorted(expected, key=str)


def test_scd2_bounds_keep_the_type_of_the_sequence(spark):
    df = feed_frame(spark, [("k", "2026-03-08", "A"), ("k", "2026-03-15", "B")], "STRING")
    history = scd2(df, ["k"], "q", except_columns=["q"])
    assert history.schema["__START_AT"].dataType.typeName() == "string"
    assert history.columns == ["k", "v", "__START_AT", "__END_AT"]


def test_late_value_splits_a_joined_version(spark, rows):
    df = feed_frame(spark, [("k", 1, "A"), ("k", 3, "A"), ("k", 2, "B")])
    assert rows(scd2(df, ["k"], "q"), "v", "__START_AT", "__END_AT") == [("A", 1, 2), ("A", 3, None), ("B", 2, 3)]


def skewed_feed(seed, n=600, share=3):
    """A third of all rows on one key; sequence values repeat across keys, never within one."""
    rng = random.Random(seed)
    feed, used = [], set()
    while len(feed) < n:
        key = "hot" if rng.randrange(share) == 0 else f"k{rng.randrange(40)}"
        seq = rng.randrange(5000)
        if (key, seq) not in used:
            used.add((key, seq))
            feed.append((key, seq, rng.choice(["a", "b", None])))
    return feed


@pytest.mark.parametrize("hot_rows", [None, 50, 0])
@pytest.mark.parametrize("seed", [1, 2])
def test_scd2_matches_plain_python_with_a_hot_key(spark, rows, seed, hot_rows):
    feed = skewed_feed(seed)
    history = scd2(feed_frame(spark, feed).repartition(5), ["k"], "q", hot_rows=hot_rows)
    assert rows(history, "k", "v", "__START_AT", "__END_AT") == versions_by_hand(feed)


@pytest.mark.parametrize("hot_rows", [None, 0])
def test_scd2_counts_one_row_per_key_and_sequence(spark, hot_rows):
    feed = [("k", 1, "A"), ("k", 1, "A"), ("k", 2, "B"), ("k", 2, "C")]
    history = scd2(feed_frame(spark, feed), ["k"], "q", hot_rows=hot_rows)
    assert history.count() == 2
    again = scd2(feed_frame(spark, feed[::-1]), ["k"], "q", hot_rows=None)
    assert sorted(map(tuple, history.collect())) == sorted(map(tuple, again.collect()))


def test_history_has_neither_gaps_nor_overlaps_and_its_current_slice_is_scd1(spark, rows):
    df = feed_frame(spark, skewed_feed(3))
    history = scd2(df, ["k"], "q", except_columns=["q"])
    per_key = {}
    for k, _, start, end in (tuple(r) for r in history.orderBy("k", "__START_AT").collect()):
        assert per_key.get(k, start) == start
        per_key[k] = end
    assert set(per_key.values()) == {None}
    assert rows(current_versions(history), "k", "v") == rows(scd1(df, ["k"], "q", ["q"]), "k", "v")


def test_as_of_slice(spark, rows):
    history = scd2(feed_frame(spark, [("k", 1, "A"), ("k", 5, "B")]), ["k"], "q")
    assert [rows(versions_as_of(history, F.lit(at)), "v") for at in (0, 1, 4, 5, 9)] == [
        [],
        [("A",)],
        [("A",)],
        [("B",)],
        [("B",)],
    ]


def test_scd1_ignores_rows_that_arrive_late(spark, rows):
    df = feed_frame(spark, [("k", 1, "one"), ("k", 3, "three"), ("k", 2, "two")])
    assert rows(scd1(df, ["k"], "q", ["q"])) == [("k", "three")]


def neighbours_by_hand(data, step):
    expected = []
    for key in {k for k, *_ in data}:
        group = sorted((r for r in data if r[0] == key), key=lambda r: r[1:])
        for i, row in enumerate(group):
            j = i + step
            other = group[j] if 0 <= j < len(group) else (None, None, None)
            expected.append((*row, other[1], other[2]))
    return sorted(expected, key=str)


@pytest.mark.parametrize("ranges", [None, 1, 7])
@pytest.mark.parametrize("step", [1, -1])
def test_neighbours_match_plain_python(spark, rows, step, ranges):
    rng = random.Random(step)
    data = [("hot" if rng.random() < 0.4 else f"k{rng.randrange(30)}", rng.randrange(50), i) for i in range(700)]
    df = spark.createDataFrame(data, "k STRING, a INT, b INT").repartition(6)
    order = [F.col("a"), F.col("b")]
    got = with_neighbour(df, ["k"], order, {"na": F.col("a"), "nb": F.col("b")}, step, ranges)
    assert rows(got) == neighbours_by_hand(data, step)


def test_neighbour_of_a_null_is_told_from_no_neighbour(spark, rows):
    df = spark.createDataFrame([("k", i, None if i % 2 else str(i)) for i in range(40)], "k STRING, a INT, v STRING")
    got = neighbour_by_range(df, ["k"], [F.col("a")], {"n": F.col("v"), "seen": F.lit(1)})
    by_position = {r.a: (r.n, r.seen) for r in got.collect()}
    assert by_position[39] == (None, None)
    assert all(by_position[i] == (None if (i + 1) % 2 else str(i + 1), 1) for i in range(39))


def test_only_the_hot_key_leaves_the_plain_way(spark):
    df = spark.createDataFrame([("hot",)] * 300 + [(f"k{i}",) for i in range(300)], "k STRING")
    ordinary, hot = split_by_heat(df, ["k"], hot_rows=100)
    assert hot.where("k = 'hot'").count() == 300
    assert ordinary.count() + hot.count() == 600
    assert ordinary.where("k = 'hot'").count() == 0
    assert split_by_heat(df, ["k"], hot_rows=1000)[1] is None


def test_hot_key_rows_are_spread_over_tasks(spark):
    df = spark.range(4000).select(F.lit("hot").alias("k"), F.col("id").alias("a"))
    got = neighbour_by_range(df, ["k"], [F.col("a")], {"n": F.col("a")}).withColumn("task", F.spark_partition_id())
    largest = got.groupBy("task").count().agg(F.max("count")).first()[0]
    assert largest < 4000


def test_keep_latest_breaks_ties_the_same_way_every_time(spark):
    data = [("c", 1, f"v{i}") for i in range(20)]
    picks = set()
    for seed in range(3):
        random.Random(seed).shuffle(data)
        df = spark.createDataFrame(data, "k STRING, t INT, v STRING").repartition(seed + 1)
        picks.add(tuple(keep_latest(df, ["k"], [F.col("t").desc()]).first()))
    assert len(picks) == 1


def test_keep_latest_limits_rows_before_the_shuffle(spark):
    df = spark.range(1000).select(F.pmod("id", F.lit(2)).alias("k"), F.col("id").alias("t"))
    plan = keep_latest(df, ["k"], [F.col("t").desc()])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_latest_snapshot_prunes_partitions(spark, tmp_path, rows):
    path = str(tmp_path / "t")
    data = [(1, "2026-03-08"), (2, "2026-03-15"), (3, "2026-03-15")]
    spark.createDataFrame(data, "v INT, d STRING").write.partitionBy("d").parquet(path)
    latest = latest_snapshot(spark.read.schema("v INT, d STRING").parquet(path), "d")
    assert rows(latest, "v") == [(2,), (3,)]
    assert "PartitionFilters: [isnotnull(d" in latest._jdf.queryExecution().executedPlan().toString()


def test_expectations_drop_and_count(spark, rows):
    df = spark.createDataFrame([("a", 1), (None, 2), ("b", None)], "stop_id STRING, n INT")
    seen = Observation()
    kept = drop_violations(df, {**not_null("stop_id"), "positive": F.col("n") > 0}, seen)
    assert rows(kept) == [("a", 1)]
    assert seen.get == {"rows_in": 3, "dropped_stop_id_not_null": 1, "dropped_positive": 1}


@pytest.mark.parametrize("width", [65_536, 16])
def test_exact_quantiles_equal_the_builtin_percentile(spark, monkeypatch, width):
    """On folded rows with negative values, NULL keys, one row per group, and values over many bins."""
    from headway.operators import quantiles

    monkeypatch.setattr(quantiles, "BIN_WIDTH", width)
    rng = random.Random(9)
    data = [(rng.choice(["a", "b", None]), rng.randrange(-300, 300), rng.randrange(1, 5)) for _ in range(400)]
    data.append(("single", 7, 1))
    folded = spark.createDataFrame(data, "k STRING, v INT, n LONG")
    got = quantiles.exact_quantiles(folded, ["k"], "v", "n", {"median": 0.5, "p95": 0.95})
    wanted = folded.groupBy("k").agg(
        F.percentile("v", F.lit(0.5), F.col("n")).alias("median"), F.percentile("v", F.lit(0.95), F.col("n")).alias("p95")
    )
    as_rows = [sorted(((str(r.k), round(r.median, 9), round(r.p95, 9)) for r in df.collect())) for df in (got, wanted)]
    assert as_rows[0] == as_rows[1] and len(as_rows[0]) == 4
