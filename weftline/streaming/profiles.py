"""Events joined with profiles that change while the stream runs.

Both streams are united and grouped by their key.  A key's state holds its profile once; a newer
profile replaces it as soon as no event between the two can arrive any more.

Every key of a batch costs several messages to the JVM.  Where there are millions of keys, they are
grouped by a hash and a group's state is read and written as a whole.
"""

from __future__ import annotations

import bisect
import pickle
from collections import defaultdict
from collections.abc import Iterator
from itertools import chain, islice

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from weftline.streaming import run

TIME = "event_time"
MICROS, IS_PROFILE, GROUP, COPY = "__micros", "__is_profile", "__group", "__copy"
CHUNK_KEYS = 10_000  # keys whose profiles are one row of a group's state


class LatestProfile(StatefulProcessor):
    """Per key: the profiles that events may still need, and events that wait for their profile.

    Input rows have ``names`` (an event's columns), ``details`` (a profile's columns), the time in
    microseconds and whether the row is a profile.  State times are microseconds, and rows are
    pickled as tuples, so that no type of a column is converted on the way.
    """

    def __init__(self, names: list[str], details: list[str], valid_micros: int | None):
        self.names, self.details, self.valid = names, details, valid_micros

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.profiles = handle.getListState("profiles", "micros BIGINT, row BINARY")
        self.waiting = handle.getListState("waiting", "micros BIGINT, row BINARY")

    def _found(self, times: list[int], profiles: list[tuple], micros: int) -> tuple | None:
        """The newest profile at or before a time that is still valid then."""
        at = bisect.bisect_right(times, micros) - 1
        if at < 0 or (self.valid is not None and micros > times[at] + self.valid):
            return None
        return profiles[at]

    def _split(self, rows: Iterator[Row], key: str | None = None) -> tuple[list[tuple], list[tuple]]:
        """(time, event) of the events and (time, key, details) of the profiles; places are looked up once."""
        events, arrived = [], []
        for first in islice(rows, 1):
            place = first.__fields__.index
            micros, is_profile = place(MICROS), place(IS_PROFILE)
            key = place(key or MICROS)
            names, details = [place(c) for c in self.names], [place(c) for c in self.details]
            for row in chain([first], rows):
                if row[is_profile]:
                    arrived.append((row[micros], row[key], tuple([row[i] for i in details])))
                else:
                    events.append((row[micros], tuple([row[i] for i in names])))
        return events, arrived

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        joined = Row(*self.names, *self.details)
        events, arrived = self._split(rows)
        arrived = [(micros, pickle.dumps(details)) for micros, _, details in arrived]
        held = list(self.profiles.get()) if self.profiles.exists() else []
        known = dict(held)
        for micros, row in arrived:  # of two profiles of one time the greater row counts, in any order
            known[micros] = max(row, known.get(micros, row))
        times = sorted(known)
        profiles = [pickle.loads(known[t]) for t in times]
        waited = self._waited()
        late, behind = [], timerValues.getCurrentWatermarkInMs() * 1000
        for micros, event in waited + events:
            found = self._found(times, profiles, micros)
            if found is not None:
                yield joined(*event, *found)
            elif micros >= behind:
                late.append((micros, event))
        self._hold(held, known, waited, late, behind)

    def _waited(self) -> list[tuple]:
        return [(m, pickle.loads(r)) for m, r in self.waiting.get()] if self.waiting.exists() else []

    def _hold(self, held: list, known: dict, waited: list, late: list, behind: int) -> None:
        """Keep what events from ``behind`` on may need, and wake when that changes.

        Every access of the state is a message to the JVM, so only changes are written.
        """
        times = sorted(known)
        first = max(0, bisect.bisect_right(times, behind) - 1)
        kept = [t for t in times[first:] if self.valid is None or t + self.valid >= behind]
        rows = [(t, known[t]) for t in kept]
        if rows != sorted(held):
            self.profiles.clear()
            if rows:
                self.profiles.put(rows)
        if waited:
            self.waiting.clear()
        if late:
            self.waiting.put([(m, pickle.dumps(e)) for m, e in late])
        ends = [m for m, _ in late] + kept[1:]
        if self.valid is not None:
            ends += [t + self.valid for t in kept]
        if waited or len(held) > 1 or self.valid is not None:
            for timer in list(self.handle.listTimers()):
                self.handle.deleteTimer(timer)
        if ends:
            self.handle.registerTimer(min(ends) // 1000 + 1)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        behind = timerValues.getCurrentWatermarkInMs() * 1000
        held = list(self.profiles.get()) if self.profiles.exists() else []
        waited = self._waited()
        self._hold(held, dict(held), waited, [(m, e) for m, e in waited if m >= behind], behind)
        return iter(())

    def close(self) -> None:
        pass


class LatestProfiles(LatestProfile):
    """``LatestProfile`` for a group of keys: what is known of all of them is read once a batch.

    State rows are pickled parts: of a dict from a key to its times in order and the details of each,
    and of the list of waiting (time, event).
    """

    def __init__(self, key: str, names: list[str], details: list[str], valid_micros: int | None):
        super().__init__(names, details, valid_micros)
        self.key, self.at = key, names.index(key)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.profiles = handle.getListState("profiles", "part BINARY")
        self.waiting = handle.getListState("waiting", "part BINARY")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        joined = Row(*self.names, *self.details)
        events, arrived = self._split(rows, self.key)
        known, waited, changed = self._profiles(), self._waited(), bool(arrived)
        new = defaultdict(list)
        for micros, key, details in arrived:
            new[key].append((micros, details))
        for key, rows in new.items():
            newest = dict(zip(*known.get(key, ((), ())), strict=True))
            for micros, details in rows:  # of two profiles of one time the greater row counts, in any order
                newest[micros] = max(details, newest.get(micros, details), key=pickle.dumps)
            times = sorted(newest)
            known[key] = (times, [newest[t] for t in times])
        late, behind = [], timerValues.getCurrentWatermarkInMs() * 1000
        for micros, event in chain(waited, events):
            found = self._found(*known.get(event[self.at], ((), ())), micros)
            if found is not None:
                yield joined(*event, *found)
            elif micros >= behind:
                late.append((micros, event))
        self._keep(known, changed, waited, late, behind)

    def _profiles(self) -> dict[object, tuple[list[int], list[tuple]]]:
        known = {}
        for (part,) in self.profiles.get():
            known |= pickle.loads(part)
        return known

    def _waited(self) -> list[tuple]:
        return [row for (part,) in self.waiting.get() for row in pickle.loads(part)]

    def _keep(self, known: dict, changed: bool, waited: list, late: list, behind: int) -> None:
        """``_hold`` for all keys of the group, with one timer for the first change of any."""
        ends = [micros for micros, _ in late]
        for key, (times, details) in known.items():
            if len(times) > 1 or self.valid is not None:
                first = max(0, bisect.bisect_right(times, behind) - 1)
                if self.valid is not None:
                    first = max(first, bisect.bisect_left(times, behind - self.valid))
                    ends += [t + self.valid for t in times[first:]]
                ends += times[first + 1 :]
                if first:
                    known[key], changed = (times[first:], details[first:]), True
        if changed:
            self._write(self.profiles, map(dict, _parts((k, v) for k, v in known.items() if v[0])))
        if waited != late:
            self._write(self.waiting, _parts(late))
        timers, wanted = list(self.handle.listTimers()), [min(ends) // 1000 + 1] if ends else []
        if timers != wanted:
            for timer in timers:
                self.handle.deleteTimer(timer)
            for timer in wanted:
                self.handle.registerTimer(timer)

    @staticmethod
    def _write(state, parts: Iterator) -> None:
        state.clear()
        rows = [(pickle.dumps(part),) for part in parts if part]
        if rows:
            state.put(rows)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        behind, waited = timerValues.getCurrentWatermarkInMs() * 1000, self._waited()
        self._keep(self._profiles(), False, waited, [(m, e) for m, e in waited if m >= behind], behind)
        return iter(())


def _parts(rows) -> Iterator[list]:
    rows = iter(rows)
    while part := list(islice(rows, CHUNK_KEYS)):
        yield part


def join_latest(
    events: DataFrame,
    profiles: DataFrame,
    key: str,
    valid_seconds: int | None = None,
    delays: tuple[str | None, str | None] = ("1 minute", "1 minute"),
    groups: int | None = None,
    copies: int = 1,
) -> DataFrame:
    """Every event with the profile its key had at the event's time; events without one wait for it.

    Of a key's profiles the newest at or before the event's ``event_time`` counts, for
    ``valid_seconds`` (None: until the next).  An event is joined as soon as its key has such a
    profile; one that arrives later doesn't change it.  A profile stays in state once a key, until
    the watermark has passed a newer one or its end; an event that waits is dropped when the
    watermark passes it, as no profile from before it can arrive then.  Rows without a key or time match
    nothing.  ``delays`` set the watermarks (None: the input has one).  The events of a key in one
    batch are held by its task, so bound what a batch reads (``feed`` does).

    ``groups`` is for many keys (strings, numbers or dates): they are dealt over so many groups, whose
    profiles a task holds one group at a time.  The events of a hot key go to as many as ``copies`` of
    them, all of which have its profiles.  Without ``groups`` each key is by itself.

    Needs the RocksDB state store, which ``run.start`` sets.
    """
    names = events.columns
    details = [c for c in profiles.columns if c not in (key, TIME)]
    if clash := sorted(set(names) & set(details)):
        raise ValueError(f"columns in both streams: {', '.join(clash)}")
    sides = []
    for side, delay, is_profile in ((events, delays[0], False), (profiles, delays[1], True)):
        side = side if delay is None else side.withWatermark(TIME, delay)
        present = side.where(F.col(key).isNotNull() & F.col(TIME).isNotNull())
        micros = F.unix_micros(F.col(TIME).cast("timestamp"))
        sides.append(present.withColumns({MICROS: micros, IS_PROFILE: F.lit(is_profile)}))
    both = sides[0].unionByName(sides[1], allowMissingColumns=True)
    fields = [events.schema[c] for c in names] + [profiles.schema[c] for c in details]
    shape = T.StructType([T.StructField(f.name, f.dataType, True) for f in fields])
    valid = None if valid_seconds is None else valid_seconds * 1_000_000
    run.set_defaults(events.sparkSession)  # the state store must be known when the query is planned
    processor = LatestProfile(names, details, valid)
    if groups is not None:
        number = F.lit(0)
        if copies > 1:
            spread = [c for c in names if isinstance(events.schema[c].dataType, T.AtomicType)]
            own = F.array(F.pmod(F.xxhash64(*spread), F.lit(copies)).cast("int"))
            every = F.sequence(F.lit(0), F.lit(copies - 1))
            both = both.withColumn(COPY, F.explode(F.when(F.col(IS_PROFILE), every).otherwise(own)))
            number = F.col(COPY)
        both = both.withColumn(GROUP, F.pmod(F.xxhash64(key, number), F.lit(groups)).cast("int")).drop(COPY)
        processor = LatestProfiles(key, names, details, valid)
    return both.groupBy(key if groups is None else GROUP).transformWithState(
        statefulProcessor=processor,
        outputStructType=shape,
        outputMode="Append",
        timeMode="EventTime",
        eventTimeColumnName=TIME,
    )

