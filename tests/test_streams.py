"""File streams and incremental change flows: exactly once, in any split and order, replay-safe."""

import random

import pytest
from pyspark.sql import functions as F

from headway import schemas
from headway.operators.changes import scd1, scd2
from headway.operators.quality import not_null
from headway.sources.feeds import read_schedule, read_schedule_by_header, read_traffic
from headway.streaming.changeflow import ChangeFlow, fold_scd1, fold_scd2, read_state, run_scd1, run_scd2
from headway.streaming.changeflow import _commit, _load
from headway.streaming.ingest import ingest_feed, read_bronze, start_ingest_by_header, stream_bronze
from tests.test_ordered_and_changes import skewed_feed

ROUTES_HEADER = (
    "route_id,agency_id,route_short_name,route_long_name,route_desc,route_type,route_url,route_color,route_text_color"
)


def put(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text)


def routes_file(*lines):
    return "\n".join([ROUTES_HEADER, *lines]) + "\n"


def test_ingest_reads_each_file_once_and_keeps_provenance(spark, tmp_path, rows):
    landing, bronze = tmp_path / "landing", str(tmp_path / "bronze")
    put(landing / "2026-03-08/routes.txt", routes_file("009,AG,9,East/West,,3,,0000FF,FFFFFF"))
    for _ in range(2):
        table = ingest_feed(spark, schemas.ROUTES, str(landing), bronze)
        assert table.count() == 1
    put(landing / "2026-03-15/routes.txt", routes_file("009,AG,9,East,,3,,0000FF,FFFFFF", "R1,AG,R1,North,,x,,,"))
    table = ingest_feed(spark, schemas.ROUTES, str(landing), bronze)
    assert rows(table, "route_id", "route_long_name", "route_desc", "route_type", "gtfs_snapshot_date", "_source_file") == [
        ("009", "East", None, 3, "2026-03-15", "routes.txt"),
        ("009", "East/West", None, 3, "2026-03-08", "routes.txt"),
        ("R1", "North", None, None, "2026-03-15", "routes.txt"),
    ]
    assert table.schema["gtfs_snapshot_date"].dataType.typeName() == "string"
    assert rows(read_schedule(spark, str(landing), schemas.ROUTES)) == rows(table)


def test_ingest_in_small_batches_gives_the_same_rows(spark, tmp_path):
    landing = tmp_path / "landing"
    for day in range(1, 6):
        put(landing / f"2026-03-0{day}/routes.txt", routes_file(f"{day},AG,,,,3,,,"))
    table = ingest_feed(spark, schemas.ROUTES, str(landing), str(tmp_path / "bronze"), files_per_batch=2)
    assert sorted(r.route_id for r in table.collect()) == ["1", "2", "3", "4", "5"]


def test_reordered_columns_fail_instead_of_swapping_values(spark, tmp_path):
    header = ROUTES_HEADER.split(",")
    header[0], header[1] = header[1], header[0]
    put(tmp_path / "landing/2026-03-08/routes.txt", ",".join(header) + "\nAG,009,9,E,,3,,,\n")
    with pytest.raises(Exception, match="FAILED_READ_FILE"):
        ingest_feed(spark, schemas.ROUTES, str(tmp_path / "landing"), str(tmp_path / "bronze"))


def test_by_header_read_takes_any_column_order_and_missing_columns(spark, tmp_path, rows):
    put(tmp_path / "2026-03-08/routes.txt", "route_type,route_id\n3,009\n")
    put(tmp_path / "2026-03-15/routes.txt", "route_id,route_url,route_type,unknown\n010,u,2,z\n")
    files = [str(tmp_path / d / "routes.txt") for d in ("2026-03-08", "2026-03-15")]
    got = read_schedule_by_header(spark, files, schemas.ROUTES)
    assert rows(got, "route_id", "route_type", "route_url", "agency_id", "gtfs_snapshot_date") == [
        ("009", 3, None, None, "2026-03-08"),
        ("010", 2, "u", None, "2026-03-15"),
    ]


def test_by_header_stream_reads_each_file_once(spark, tmp_path, rows):
    landing, bronze = tmp_path / "landing", str(tmp_path / "bronze")
    put(landing / "2026-03-08/routes.txt", "route_type,route_id\n3,009\n")
    for date, text in ((None, None), ("2026-03-15", "route_id,route_url,route_type\n010,u,2\n"), (None, None)):
        if date:
            put(landing / date / "routes.txt", text)
        start_ingest_by_header(spark, schemas.ROUTES, str(landing), bronze, files_per_batch=1).awaitTermination()
    table = read_bronze(spark, schemas.ROUTES, bronze)
    assert rows(table, "route_id", "route_type", "route_url", "gtfs_snapshot_date", "_source_file") == [
        ("009", 3, None, "2026-03-08", "routes.txt"),
        ("010", 2, "u", "2026-03-15", "routes.txt"),
    ]
    flow = ChangeFlow(str(tmp_path / "t"), ("route_id",), schemas.SNAPSHOT_DATE, (schemas.SOURCE_FILE,))
    run_scd1(flow, stream_bronze(spark, schemas.ROUTES, bronze), str(tmp_path / "cp"))
    assert rows(read_state(spark, flow), "route_id") == [("009",), ("010",)]


def test_traffic_stream_keeps_bad_values_as_null_and_the_arrival_time(spark, tmp_path):
    good = '{"corridor_id":"c1","duration_seconds":105,"congestion_ratio":1.203,"polled_at":"2026-03-22T05:00:00"}'
    bad = '{"corridor_id":"c2","duration_seconds":"soon","congestion_ratio":1.2,"polled_at":"2026-03-22T05:15:00"}'
    put(tmp_path / "in/2026-03-22_traffic.json", good + "\n" + bad + "\n")
    table = ingest_feed(spark, schemas.TRAFFIC, str(tmp_path / "in"), str(tmp_path / "bronze"))
    got = {r.corridor_id: r for r in table.collect()}
    assert (got["c1"].duration_seconds, got["c2"].duration_seconds) == (105, None)
    assert str(got["c1"].polled_at) == "2026-03-22 05:00:00"
    assert got["c1"]._source_file == "2026-03-22_traffic.json" and got["c1"]._file_arrival_time is not None
    batch = read_traffic(spark, str(tmp_path / "in"), schemas.TRAFFIC)
    assert sorted(map(str, batch.collect())) == sorted(map(str, table.collect()))


DDL = "k STRING, q INT, v STRING"


def deliveries(seed, parts):
    rng = random.Random(seed)
    feed = skewed_feed(seed, n=240)
    rng.shuffle(feed)
    return feed, [feed[i::parts] for i in range(parts)]


def test_scd1_flow_equals_the_batch_result_for_any_order(spark, tmp_path, rows):
    feed, parts = deliveries(5, 3)
    flow = ChangeFlow(str(tmp_path / "target"), ("k",), "q", ("q",), not_null("k"))
    for part in parts:
        spark.createDataFrame(part + [(None, 1, "dropped")], DDL).write.mode("append").parquet(str(tmp_path / "feed"))
        stream = spark.readStream.schema(DDL).parquet(str(tmp_path / "feed"))
        run_scd1(flow, stream, str(tmp_path / "checkpoint"))
    assert rows(read_state(spark, flow)) == rows(scd1(spark.createDataFrame(feed, DDL), ["k"], "q", ["q"]))


def test_scd2_flow_equals_the_batch_result_for_any_order(spark, tmp_path, rows):
    feed, parts = deliveries(6, 4)
    parts.append([("late", 3, "A"), ("late", 1, "A")])
    parts.append([("late", 2, "B"), ("new", 9, "Z")])
    flow = ChangeFlow(str(tmp_path / "target"), ("k",), "q", ("q",), not_null("k"))
    for part in parts:
        spark.createDataFrame(part, DDL).write.mode("append").parquet(str(tmp_path / "feed"))
        stream = spark.readStream.schema(DDL).parquet(str(tmp_path / "feed"))
        run_scd2(
            flow, stream, lambda session: session.read.schema(DDL).parquet(str(tmp_path / "feed")), str(tmp_path / "cp")
        )
    everything = spark.createDataFrame([r for part in parts for r in part], DDL)
    assert rows(read_state(spark, flow)) == rows(scd2(everything, ["k"], "q", ["q"]))


def test_keys_in_order_never_touch_the_history(spark, rows):
    flow = ChangeFlow("unused", ("k",), "q", ("q",))
    first = spark.createDataFrame([("a", 1, "A"), ("a", 2, "B"), ("b", 1, "X")], DDL)
    second = spark.createDataFrame([("a", 5, "B"), ("a", 6, "C"), ("c", 1, "N")], DDL)
    nothing = spark.createDataFrame([], DDL)
    empty = spark.createDataFrame([], "k STRING, v STRING, __START_AT INT, __END_AT INT, __SEQUENCE INT")
    state = fold_scd2(flow, empty, first, nothing)
    state = fold_scd2(flow, state, second, nothing)
    assert rows(state, "k", "v", "__START_AT", "__END_AT") == [
        ("a", "A", 1, 2),
        ("a", "B", 2, 6),
        ("a", "C", 6, None),
        ("b", "X", 1, None),
        ("c", "N", 1, None),
    ]


def test_replaying_a_batch_gives_the_same_state(spark, tmp_path, rows):
    flow = ChangeFlow(str(tmp_path / "target"), ("k",), "q", ("q",))
    schema = spark.createDataFrame([], "k STRING, v STRING, __SEQUENCE INT").schema
    batches = [[("a", 1, "A")], [("a", 2, "B"), ("b", 1, "X")], [("b", 2, "Y")], [("a", 3, "C")]]

    def apply(batch_id):
        state = _load(spark, flow, schema, before=batch_id)
        batch = spark.createDataFrame(batches[batch_id], DDL)
        _commit(spark, flow, batch_id, fold_scd1(flow, state, batch))

    for batch_id in range(4):
        apply(batch_id)
        apply(batch_id)
    assert rows(read_state(spark, flow)) == [("a", "C"), ("b", "Y")]


def test_bronze_of_a_feed_can_be_streamed_on(spark, tmp_path, rows):
    landing, bronze = tmp_path / "landing", str(tmp_path / "bronze")
    flow = ChangeFlow(
        str(tmp_path / "routes"),
        ("route_id",),
        schemas.SNAPSHOT_DATE,
        (schemas.SOURCE_FILE, schemas.SNAPSHOT_DATE),
        not_null("route_id"),
    )
    for date, name in (("2026-03-15", "second"), ("2026-03-08", "first, delivered late")):
        put(landing / date / "routes.txt", routes_file(f'009,AG,9,"{name}",,3,,,', f",AG,9,{date},,3,,,"))
        ingest_feed(spark, schemas.ROUTES, str(landing), bronze)
        run_scd1(flow, stream_bronze(spark, schemas.ROUTES, bronze), str(tmp_path / "checkpoint"))
    state = read_state(spark, flow)
    assert rows(state, "route_id", "route_long_name") == [("009", "second")]
    assert state.columns == schemas.ROUTES.typed.fieldNames()
