from __future__ import annotations

import datetime
import time
from collections import Counter

import pytest
from pyspark.sql import functions as F

from weftline.plans import queries_streams
from weftline.plans.registry import QUERIES
from weftline.sources.sinks import write_parquet
from weftline.streaming import fraud, joins, run, sources, windows
from weftline.workspace import workspace

START = datetime.datetime(2024, 1, 1)


def at(minutes: float) -> datetime.datetime:
    return START + datetime.timedelta(minutes=minutes)


def replay(spark, build, schema, *waves):
    """Append the waves one by one and process each before the next one arrives."""
    inbox, out = workspace(spark, "inbox"), workspace(spark, "out")
    for i, wave in enumerate(waves):
        write_parquet(spark.createDataFrame(wave, schema).coalesce(1), f"{inbox}/wave={i}")
        frame = spark.createDataFrame([], schema)
        result = build(sources.file_stream(spark, f"{inbox}/wave=*", frame.schema))
        run.append_available(result, out)
    return spark.read.schema(result.schema).parquet(out)


def test_bad_json_and_missing_fields_give_null(spark):
    values = [('{"ride_id": "r1", "fare": 2.5, "start_location": {"lat": 1.0}}',), ("not json",)]
    df = spark.createDataFrame(values, "value STRING").select(
        F.col("value").cast("binary").alias("value"),
        F.lit(START).cast("timestamp").alias("timestamp"),
    )
    decoded = sources.decode_json(df, sources.RIDE_SCHEMA).collect()
    assert (decoded[0].ride_id, decoded[0].fare, decoded[0].driver_id) == ("r1", 2.5, None)
    assert decoded[0].start_location.lat == 1.0 and decoded[0].start_location.lon is None
    assert decoded[1].ride_id is None and decoded[1].event_time == START


def test_encode_and_decode_are_inverse(spark, rows):
    df = spark.createDataFrame([(1, "a", START), (2, None, at(1))], "id INT, v STRING, ts TIMESTAMP")
    back = sources.decode_json(sources.encode_json(df, "ts", "id"), "id INT, v STRING")
    assert rows(back) == [(1, "a", START), (2, None, at(1))]


SCHEMA = "driver_id STRING, fare DOUBLE, ride_id STRING, event_time TIMESTAMP"


def ride(driver, minutes, fare=1.0, ride_id="r"):
    return (driver, fare, ride_id, at(minutes))


def test_session_gap_is_inclusive(spark, rows):
    events = [ride("d", m) for m in (0, 10, 19 + 59.999 / 60, 30)] + [ride("z", 600)]
    counts = replay(spark, lambda s: windows.session_count(s, "driver_id"), SCHEMA, events)
    assert rows(counts) == [
        (at(0), at(29 + 59.999 / 60), "d", 3),
        (at(30), at(40), "d", 1),
    ]


def test_window_edges_and_late_rows(spark, rows):
    first = [ride("d", 0), ride("d", 1), ride("d", 1.99), ride("d", 10)]
    late = [ride("d", 1.5), ride("d", 9.5), ride("d", 30)]

    def build(stream):
        return windows.tumbling_agg(stream, "driver_id", "fare", "ride_id")

    counts = replay(spark, build, SCHEMA, first, late)
    assert rows(counts) == [
        (at(0), at(1), "d", 1.0, 1),
        (at(1), at(2), "d", 2.0, 2),  # 1.5 came behind the watermark
        (at(9), at(10), "d", 1.0, 1),  # 9.5 came late, but its window was open
        (at(10), at(11), "d", 1.0, 1),
    ]


def test_sliding_windows_overlap(spark, rows):
    counts = replay(
        spark,
        lambda s: windows.sliding_count(s, "driver_id"),
        SCHEMA,
        [ride("d", 4), ride("d", 600)],
    )
    assert rows(counts) == [(at(m), at(m + 5), "d", 1) for m in (0, 2, 4)]


def test_stream_equals_batch_on_closed_windows(spark, rows):
    events = [ride(f"d{i % 7}", i * 0.7, float(i % 5)) for i in range(400)]

    def build(df):
        return windows.tumbling_agg(df, "driver_id", "fare", "ride_id", length="10 minutes")

    batch = build(spark.createDataFrame(events, SCHEMA)).filter(
        F.col("window_end") <= F.lit(at(399 * 0.7 - 1))
    )
    assert rows(replay(spark, build, SCHEMA, events)) == rows(batch)


PROFILE = "customer_id STRING, name STRING, event_time TIMESTAMP"
TRIP = "ride_id INT, customer_id STRING, driver_id STRING, fare DOUBLE, event_time TIMESTAMP"


def _trips(n):
    return [(i, "hot" if i % 3 else f"c{i % 5}", f"d{i % 2}", 1.0, at(i)) for i in range(n)]


@pytest.mark.parametrize(("within", "salts"), [(None, 1), ("1 day", 1), ("1 day", 4)])
def test_stream_join_equals_batch_join(spark, rows, within, salts):
    trips, people = workspace(spark, "trips"), workspace(spark, "people")
    rides = spark.createDataFrame(_trips(60), TRIP)
    profiles = spark.createDataFrame([("hot", "H", START), ("c0", "Z", START)], PROFILE)
    write_parquet(rides, trips)
    write_parquet(profiles, people)
    joined = joins.join_streams(
        sources.file_stream(spark, trips, rides.schema),
        sources.file_stream(spark, people, profiles.schema),
        "customer_id",
        within=within,
        salts=salts,
        row_id="ride_id",
    )
    expected = rides.join(profiles.drop("event_time"), "customer_id").select(*joined.columns)
    assert rows(run.run_to_table(joined, "joined")) == rows(expected)


def test_profile_outside_its_validity_does_not_match(spark):
    rides = spark.createDataFrame([(1, "c", "d", 1.0, at(0)), (2, "c", "d", 1.0, at(90))], TRIP)
    profiles = spark.createDataFrame([("c", "n", at(-30))], PROFILE)
    joined = joins.join_streams(rides, profiles, "customer_id", within="1 hour")
    assert [r.ride_id for r in joined.collect()] == [1]


def test_static_join_above_the_broadcast_limit_is_salted(spark, rows, plan, monkeypatch):
    rides = spark.createDataFrame(_trips(30), TRIP)
    people = spark.createDataFrame([("hot", "H"), ("c0", "Z")], "customer_id STRING, name STRING")
    small = joins.join_static(rides, people, "customer_id", row_id="ride_id")
    monkeypatch.setattr(joins, "BROADCAST_LIMIT_BYTES", 0)
    large = joins.join_static(rides, people, "customer_id", row_id="ride_id")
    assert "__part" in plan(large) and "__part" not in plan(small)
    assert rows(large.select(*small.columns)) == rows(small)


def test_busy_customers_and_drivers(spark, rows):
    trips = [(i, "c1", f"d{i}", 1.0, at(0.1 * i)) for i in range(6)]
    trips += [(10 + i, f"x{i % 2}", "d0", 2.0, at(1 + 0.1 * i)) for i in range(5)]
    trips += [(99, "end", "end", 0.0, at(60))]
    customers = replay(spark, fraud.busy_customers, TRIP, trips)
    assert rows(customers) == [(at(0), at(1), "c1", 6.0, 6)]
    alerts = replay(spark, fraud.busy_drivers, TRIP, trips)
    assert rows(alerts) == [(at(1), at(2), "d0", 10.0, 5)]
    counts = replay(spark, fraud.driver_customers, TRIP, trips)
    report = fraud.driver_report(counts).collect()
    assert [(r.driver_id, r.ride_count, r.customer_ids) for r in report] == [
        ("d0", 5, ["x0", "x0", "x0", "x1", "x1"])
    ]
    parts = fraud.driver_report(counts, part_rows=2).collect()
    assert len(parts) > 1 and {r.ride_count for r in parts} == {5}
    assert Counter(c for r in parts for c in r.customer_ids) == {"x0": 3, "x1": 2}


def test_report_expands_counts_across_blocks(spark, monkeypatch):
    monkeypatch.setattr(fraud, "BLOCK", 4)
    counts = spark.createDataFrame(
        [(at(0), at(1), "d", "a", 9), (at(0), at(1), "d", "b", 4)],
        "window_start TIMESTAMP, window_end TIMESTAMP, driver_id STRING, customer_id STRING, rides BIGINT",
    )
    row = fraud.driver_report(counts).first()
    assert row.ride_count == 13 and Counter(row.customer_ids) == {"a": 9, "b": 4}


def test_queries_start_with_the_defaults(spark, tmp_path):
    stream = spark.readStream.format("rate").load().withWatermark("timestamp", "1 minute")
    counts = stream.groupBy(F.session_window("timestamp", "5 minutes"), "value").count()
    query = run.start(run.table_writer(counts, str(tmp_path / "out")), spark)
    try:
        assert all(spark.conf.get(name) == value for name, value in run.DEFAULTS.items())
        state = []
        for _ in range(100):
            progress = query.lastProgress
            state = progress.stateOperators if progress else []
            if state:
                break
            time.sleep(0.3)
        assert any("rocksdb" in name for name in state[0].customMetrics)
    finally:
        query.stop()


@pytest.mark.parametrize("days", [90, -5 * 365])
def test_stream_joins_keep_every_ride_at_any_date(spark, days):
    """The tables' events, moved in time; the joins, in waves, must give the rows of plain joins."""
    source, moved = "/root/testdata/sf0.001", workspace(spark, "moved")
    shift = F.col("ts") + F.expr(f"INTERVAL {days} DAYS")
    spark.read.parquet(f"{source}/events.parquet").withColumn("ts", shift).write.parquet(f"{moved}/events.parquet")
    for name in ("customer", "supplier"):
        spark.read.parquet(f"{source}/{name}.parquet").write.parquet(f"{moved}/{name}.parquet")
    for name in ("stream_join_inner", "stream_join_three_way"):
        here, there = (QUERIES[name](spark, d).drop("event_time") for d in (source, moved))
        assert here.count() > 0
        assert sorted(map(tuple, here.collect())) == sorted(map(tuple, there.collect()))


def test_slices_drop_no_row_and_let_state_go(spark, monkeypatch):
    seen = []
    start = run.start

    def watched(writer, session):
        query = start(writer, session)
        seen.append(query)
        return query

    monkeypatch.setattr(run, "start", watched)
    monkeypatch.setattr(queries_streams, "BATCH_BYTES", 20_000)
    here = QUERIES["stream_tumbling_agg"](spark, "/root/testdata/sf0.001")
    assert len(seen) == 1  # one query, whatever the number of slices
    progress = [p for p in seen[0].recentProgress if p.stateOperators]
    fed = [p for p in progress if p.numInputRows]
    assert len(fed) > 2
    state = [p.stateOperators[0] for p in progress]
    assert sum(o.numRowsDroppedByWatermark for o in state) == 0
    assert state[-1].numRowsTotal < sum(o.numRowsUpdated for o in state)  # closed windows are gone
    monkeypatch.setattr(queries_streams, "BATCH_BYTES", 1 << 30)
    whole = QUERIES["stream_tumbling_agg"](spark, "/root/testdata/sf0.001")
    assert sorted(map(str, here.collect())) == sorted(map(str, whole.collect()))


def test_several_tables_have_their_own_checkpoints(spark, tmp_path):
    streams = {}
    for name in ("a", "b"):
        write_parquet(spark.range(5 if name == "a" else 7), str(tmp_path / "in" / name))
        streams[name] = sources.file_stream(
            spark, str(tmp_path / "in" / name), spark.range(1).schema
        )
    root = str(tmp_path / "out")
    for _ in range(2):  # the second run finds nothing new
        for query in run.start_tables(streams, root, available_now=True).values():
            run.drain(query)
    assert spark.read.parquet(f"{root}/a").count() == 5
    assert spark.read.parquet(f"{root}/b").count() == 7
    assert (tmp_path / "out" / "a" / "_checkpoints").is_dir()


def test_a_failing_stream_raises(spark, tmp_path):
    write_parquet(spark.range(3), str(tmp_path / "in"))
    stream = sources.file_stream(spark, str(tmp_path / "in"), spark.range(1).schema)
    broken = stream.select(F.raise_error(F.lit("broken row")).cast("string").alias("x"))
    with pytest.raises(Exception, match="broken row"):
        run.append_available(broken, str(tmp_path / "out"))


def test_continuous_processing_of_a_map_only_stream(spark, tmp_path):
    # Continuous tasks hold their cores; leave some for the reads below.
    rate = spark.readStream.format("rate").options(rowsPerSecond=50, numPartitions=2)
    stream = rate.load()
    doubled = stream.select((F.col("value") * 2).alias("twice"))
    query = run.start_continuous(
        doubled, "memory", str(tmp_path / "c"), every="300 milliseconds", queryName="twice_rows"
    )
    try:
        for _ in range(100):
            if spark.table("twice_rows").count() >= 10:
                break
            time.sleep(0.3)
        values = [r.twice for r in spark.table("twice_rows").collect()]
        assert len(values) >= 10 and all(v % 2 == 0 for v in values)
    finally:
        query.stop()


def test_continuous_processing_refuses_files(spark, tmp_path):
    write_parquet(spark.range(3), str(tmp_path / "in"))
    stream = sources.file_stream(spark, str(tmp_path / "in"), spark.range(1).schema)
    with pytest.raises(Exception, match="[Cc]ontinuous"):
        query = run.start_continuous(stream, "memory", str(tmp_path / "c"), queryName="refused")
        query.processAllAvailable()


def test_batches_are_smaller_where_a_few_keys_have_all_events(spark, monkeypatch):
    asked, run_in_order = [], queries_streams.feed.run_in_order

    def noted(df, time, build, purpose, batch_bytes):
        asked.append(batch_bytes)
        return run_in_order(df, time, build, purpose, batch_bytes)

    monkeypatch.setattr(queries_streams.feed, "run_in_order", noted)
    found = queries_streams._join_three(spark, "/root/testdata/sf0.001")
    assert asked == [queries_streams.HOT_BATCH_BYTES] and asked[0] <= 1 << 27
    monkeypatch.setattr(queries_streams, "HOT_BATCH_BYTES", 30_000)
    cut = queries_streams._join_three(spark, "/root/testdata/sf0.001")
    assert asked[1] == 30_000 and found.count() > 0
    assert sorted(map(str, cut.collect())) == sorted(map(str, found.collect()))


def test_three_way_join_holds_customers_in_groups(spark, tmp_path, monkeypatch):
    """Every key of a batch costs messages to the JVM; state by group costs them for a few hundred groups."""
    seen, start = [], run.start
    monkeypatch.setattr(run, "start", lambda writer, session: seen.append(start(writer, session)) or seen[-1])
    spark.range(6000).selectExpr(
        "id AS event_id", "timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, 0, id) AS ts", "id % 3000 AS user_id",
        "'x' AS event_type", "CAST(id AS DOUBLE) AS value", "'' AS props",
    ).write.parquet(str(tmp_path / "events.parquet"))
    spark.range(2500).selectExpr("id AS c_custkey", "concat('c', id) AS c_name").write.parquet(str(tmp_path / "customer.parquet"))
    spark.range(1, 2000).selectExpr("id AS s_suppkey", "concat('s', id) AS s_name").write.parquet(str(tmp_path / "supplier.parquet"))
    found = QUERIES["stream_join_three_way"](spark, str(tmp_path)).collect()
    want = {(i, f"c{i % 3000}", f"s{i % 3000 % 10}") for i in range(6000) if i % 3000 < 2500 and i % 10}
    assert {(r.ride_id, r.customer_name, r.driver_name) for r in found} == want and len(found) == len(want)
    for operator in [p for p in seen[0].recentProgress if p.stateOperators][-1].stateOperators:
        assert 0 < operator.numRowsTotal <= 2 * 256  # parts of groups; a customer each before, and a timer
