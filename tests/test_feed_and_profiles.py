from __future__ import annotations

import datetime
import decimal
import functools
import pickle
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from weftline.streaming import feed, profiles, run, sources, windows
from weftline.workspace import workspace

START = datetime.datetime(2024, 1, 1)


def at(minutes: float) -> datetime.datetime:
    return START + datetime.timedelta(minutes=minutes)


EVENTS = "ride_id INT, customer_id STRING, fare DECIMAL(18, 2), event_time TIMESTAMP"
PROFILES = "customer_id STRING, name STRING, level INT, event_time TIMESTAMP"


def test_slices_are_cut_by_bytes_and_follow_each_other(spark):
    rng = random.Random(1)
    rows = [(i, at(rng.randrange(500))) for i in range(3000)] + [(i, None) for i in range(5)]
    df = spark.createDataFrame(rows, "id INT, t TIMESTAMP").repartition(4)
    slices = [s.collect() for s in feed.time_slices(df, "t", batch_bytes=8000)]
    assert len(slices) == 5 and Counter(tuple(r) for s in slices for r in s) == Counter(rows)
    times = [[r.t for r in s if r.t] for s in slices]
    assert all(max(a) < min(b) for a, b in zip(times, times[1:], strict=False))
    assert max(map(len, slices)) < 1000
    assert len(list(feed.time_slices(df, "t"))) == 1


def test_a_feed_in_order_drops_nothing_and_accounts_for_every_row(spark, rows):
    events = [(f"d{i % 7}", float(i % 5), "r", at(i * 0.7)) for i in range(2000)]
    df = spark.createDataFrame(events, "driver_id STRING, fare DOUBLE, ride_id STRING, event_time TIMESTAMP")

    def build(stream):
        return windows.tumbling_agg(stream, "driver_id", "fare", "ride_id", length="10 minutes")

    in_order = feed.run_in_order(df.repartition(3), "event_time", build, "in-order", batch_bytes=12_000)
    closed = build(df).where(F.col("window_end") <= F.lit(at(1999 * 0.7 - 1)))
    assert rows(in_order) == rows(closed)


def test_dropped_rows_are_counted(spark):
    schema = "event_type STRING, event_time TIMESTAMP"

    def build(stream):
        return windows.window_agg(stream, F.window("event_time", "10 minutes"), ["event_type"], {"n": F.count("*")}, "1 minute")

    with feed.Feed(spark, spark.createDataFrame([], schema).schema, build, "late") as late:
        late.put(spark.createDataFrame([("a", at(m)) for m in range(100)], schema))
        late.put(spark.createDataFrame([("b", at(m)) for m in (5, 5, 6, 97, 95)] + [("a", at(30))], schema))
        total = late.totals(F.col("n"), F.col("value.count")).first()
        assert late.account.arrived == 106 and 0 < late.account.dropped_groups <= 4
        assert (total.arrived, total.kept, total.open, total.dropped) == (106, 90, 12, 4)


def _latest(events, people, valid=None):
    found = Counter()
    for event in events:
        known = [p for p in people if p[0] == event[1] and p[0] is not None and p[3] <= event[3]]
        if known:
            best = max(known, key=lambda p: p[3])
            if valid is None or event[3] <= best[3] + datetime.timedelta(seconds=valid):
                found[(*event, best[1], best[2])] += 1
    return found


def _replay(spark, waves, valid=None):
    """Each wave is (events, profiles); both are processed before the next wave arrives."""
    inboxes = [workspace(spark, "events"), workspace(spark, "people")]
    out = workspace(spark, "latest")
    query = None
    try:
        for number, wave in enumerate(waves):
            # a wave's profiles first: an event is joined with what is known when it is processed
            for inbox, part, schema in zip(inboxes[::-1], wave[::-1], (PROFILES, EVENTS), strict=True):
                spark.createDataFrame(part, schema).write.parquet(f"{inbox}/part={number}")
            if query is None:
                streams = [
                    sources.file_stream(spark, f"{inbox}/part=*", spark.createDataFrame([], schema).schema).drop("part")
                    for inbox, schema in zip(inboxes, (EVENTS, PROFILES), strict=True)
                ]
                joined = profiles.join_latest(*streams, "customer_id", valid)
                query = run.start(run.table_writer(joined, out), spark)
            query.processAllAvailable()
        found = Counter(map(tuple, spark.read.schema(joined.schema).parquet(out).collect()))
        state = query.lastProgress.stateOperators[0].numRowsTotal if query.lastProgress.stateOperators else None
        return found, f"{out}/_checkpoints", state
    finally:
        if query is not None:
            query.stop()


def _rides(rng, low, high, n, first):
    return [
        (first + i, rng.choice(("hot", "hot", "c1", "c2", "none", None)), decimal.Decimal(i), at(rng.uniform(low, high)))
        for i in range(n)
    ]


def _state(spark, checkpoint, name):
    reader = spark.read.format("statestore").option("stateVarName", name)
    return reader.load(checkpoint)


@pytest.mark.parametrize("valid", [None, 1800])
def test_events_get_the_profile_of_their_time(spark, valid):
    rng = random.Random(4)
    people = [("hot", "A", 1, at(0)), ("hot", "B", 2, at(40)), ("hot", "C", 3, at(90)), ("c1", "D", 4, at(0.5)), ("c2", "E", 5, at(0))]
    waves = [(_rides(rng, 60 * w, 60 * w + 59, 40, 100 * w), []) for w in range(4)]
    # B and C come with a wave that also has events from before them
    waves[0] = (waves[0][0], [people[1]])
    waves[1] = (waves[1][0], [people[2]])
    early = [(900, "c1", decimal.Decimal(1), at(1)), (901, "c1", decimal.Decimal(1), at(0.2))]
    waves.insert(0, (early, [people[0], people[3], people[3], people[4]]))
    people.append(("new", "F", 6, at(300)))  # its time lets the watermark pass all others
    waves.append(([(999, "none", decimal.Decimal(1), at(400))], [people[-1]]))
    found, checkpoint, _ = _replay(spark, waves, valid)
    events = [e for wave, _ in waves for e in wave]
    assert found == _latest(events, people, valid)
    held = _state(spark, checkpoint, "profiles").select("key.*")
    # one profile a key, the newest; replaced and expired ones are gone
    alive = ["c1", "c2", "hot", "new"] if valid is None else ["new"]
    assert sorted(r[0] for r in held.collect()) == alive


def test_events_wait_for_their_profile(spark):
    rides = [(1, "c", decimal.Decimal(1), at(10)), (2, "c", decimal.Decimal(1), at(3)), (3, "x", decimal.Decimal(1), at(10))]
    first = (rides, [("other", "O", 0, at(0))])
    second = ([], [("c", "late", 7, at(9.5))])
    third = ([(9, "other", decimal.Decimal(1), at(600))], [("other", "P", 1, at(600))])
    found, checkpoint, _ = _replay(spark, [first, second, third])
    expected = _latest(rides + third[0], [*first[1], *second[1], *third[1]])
    assert found == expected and len(found) == 2
    assert _state(spark, checkpoint, "waiting").count() == 0


def test_clashing_columns_are_an_error(spark):
    a = spark.createDataFrame([], "k INT, name STRING, event_time TIMESTAMP")
    with pytest.raises(ValueError, match="name"):
        profiles.join_latest(a, a, "k")


@pytest.mark.parametrize("valid", [None, 1800])
def test_grouped_keys_get_the_profile_of_their_time(spark, monkeypatch, valid):
    """Keys that share a group, and groups that share a key, give what keys give by themselves."""
    grouped = functools.partial(profiles.join_latest, groups=3, copies=2)
    monkeypatch.setattr(profiles, "join_latest", grouped)
    rng = random.Random(5)
    people = [("hot", "A", 1, at(0)), ("hot", "B", 2, at(40)), ("hot", "C", 3, at(90)), ("c1", "D", 4, at(0.5)), ("c2", "E", 5, at(0))]
    waves = [(_rides(rng, 60 * w, 60 * w + 59, 40, 100 * w), []) for w in range(4)]
    waves[0] = (waves[0][0], [people[1], ("hot", "AB", 2, at(40))])  # of one time: the greater counts
    waves[1] = (waves[1][0], [people[2]])
    early = [(900, "c1", decimal.Decimal(1), at(1)), (901, "c1", decimal.Decimal(1), at(0.2))]
    waves.insert(0, (early, [people[0], people[3], people[3], people[4]]))
    people.append(("new", "F", 6, at(300)))  # its time lets the watermark pass all others
    waves.append(([(999, "none", decimal.Decimal(1), at(400))], [people[-1]]))
    found, checkpoint, _ = _replay(spark, waves, valid)
    both = [("hot", max("B", "AB", key=lambda n: pickle.dumps((n, 2))), 2, at(40))]
    known = [p for p in people if p[1] != "B"] + both
    assert found == _latest([e for wave, _ in waves for e in wave], known, valid)
    held = {}
    for (part,) in _state(spark, checkpoint, "profiles").select("list_element.part").collect():
        for key, (_, details) in pickle.loads(part).items():
            held[key] = details
    newest = {"c1": [("D", 4)], "c2": [("E", 5)], "hot": [("C", 3)], "new": [("F", 6)]}
    assert held == (newest if valid is None else {"new": newest["new"]})
    waiting = [e for r in _state(spark, checkpoint, "waiting").collect() for _, e in pickle.loads(r.list_element.part)]
    assert [event[0] for event in waiting] == [999]  # what the watermark has not passed


def test_events_wait_for_their_profile_in_a_group(spark, monkeypatch):
    grouped = functools.partial(profiles.join_latest, groups=2, copies=3)
    monkeypatch.setattr(profiles, "join_latest", grouped)
    test_events_wait_for_their_profile(spark)


def test_a_group_of_many_keys_is_kept_in_parts():
    class Held:
        rows = ()

        def get(self):
            return iter(self.rows)

        def put(self, rows):
            self.rows = rows

        def clear(self):
            self.rows = ()

    many = {key: ([key], [(f"n{key}",)]) for key in range(2 * profiles.CHUNK_KEYS + 5)}
    group = profiles.LatestProfiles("k", ["k"], ["name"], None)
    group.profiles = Held()
    group._write(group.profiles, map(dict, profiles._parts(many.items())))
    assert len(group.profiles.rows) == 3 and group._profiles() == many
