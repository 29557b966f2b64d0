"""Jaccard join of shingle sets: prefix filter on groups of equal prefixes, then member checks.

Two sets with Jaccard similarity t or more, both ordered by the same order of shingles, share one
of their first ``n - ceil(t n) + 1``.  Rare shingles come first in the order, so few sets meet in
one; how rare a shingle is, is read from a table of hashed counts over all documents.  The table has
a fixed size; a shared counter only makes a shingle look more common, and any order is exact.

1. Documents with equal sets become one class, whose id is a 128-bit hash of the set.  Links join
   classes, never keys: a key may have several sets or be null.  Components get their keys last.
2. A shingle of a class's prefix is dropped where no other class has it in its own with a size and a
   place that leave a link possible; the first common shingle of two linked classes stays in both.
3. Classes with equal size and equal remaining prefix become a group.  First each member of a group
   is checked against its smallest, and that one against a few of the smallest of its shingles:
   a number of checks in proportion to the classes, after which most copies are in one component.
4. Where a shingle still has many units (a group's members of one component) of other components,
   each unit is checked against the nearest of a few others that are drawn for the shingle, again a
   number in proportion to the units.  This is repeated while most checks join components, so that a
   large group of near copies becomes one without meeting all its pairs; where few units would meet
   anyway, it is left out.
5. Then units are paired by their prefixes across components only, filtered by size, place in the
   prefix and bitmap, and expanded to members, which are checked in turn.  A link within a component
   adds nothing, and any other has its first common shingle in both prefixes, so no component is
   missed.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftline.llm.buffers import Words, blocks, lower_ascii, mix, text_bytes, words_between_blanks
from weftline.llm.components import components
from weftline.workspace import materialize

COUNTER_BITS = 24  # counters of the shingle table: 16 M, one byte each where it is read
SLICES = 256
FILTER_BITS = 25  # bits of the filter of sets to read: 4 MB
PERCENT = 90
WORDS = 3
TOKEN_ROWS = 5000  # units of a common shingle that meet others in one place, about
CROWD = 8  # units of other components in one shingle, from where on they are thinned out first
MEETINGS = 64  # meetings a unit, from where on units of crowded shingles are thinned out first
DRAWN = 3  # units of a shingle and size class that others are compared with
NEIGHBOURS = 8  # sets of next larger size in one shingle whose places are compared
CELL_ROWS = 500  # sets that are compared with one set in one place, about
BITMAP_WORDS = 4  # 64-bit words of a set's bitmap
WIDE_BITS = 1 << 16  # bits of the wide bitmap of a large set, at most

_MULTIPLIERS = mix(np.arange(1, 65, dtype=np.uint64) * np.uint64(0xA0761D6478BD642F)) | np.uint64(1)


def shingle_sets(data: np.ndarray, offsets: np.ndarray, width: int) -> list[np.ndarray]:
    """For each text, the sorted distinct 64-bit hashes of its ``width``-word shingles.

    Words are what lies between blanks, A-Z lowered.  A text of fewer words has one shingle, of all
    its words; one without words has none.
    """
    words = Words(data, offsets, words_between_blanks(), lower_ascii())
    key, ends = words.key, np.cumsum(words.count)
    rolled = np.zeros(max(0, len(key) - width + 1), np.uint64)
    for i in range(width):
        rolled += key[i : i + len(rolled)] * _MULTIPLIERS[i]
    rolled = mix(rolled)
    sets = []
    for end, count in zip(ends.tolist(), words.count.tolist(), strict=True):
        if count >= width:
            sets.append(np.unique(rolled[end - count : end - width + 1]))
        elif count:
            few = key[end - count : end] * _MULTIPLIERS[width : width + count]
            sets.append(mix(few.sum(dtype=np.uint64, keepdims=True) + np.uint64(count)))
        else:
            sets.append(key[:0])
    return sets


def set_hash(shingles: np.ndarray) -> tuple[int, int]:
    """Two independent signed 64-bit sums over a set: equal sets agree in both."""
    high = mix(shingles * _MULTIPLIERS[60]).sum(dtype=np.uint64)
    low = mix(shingles ^ _MULTIPLIERS[61]).sum(dtype=np.uint64)
    return int(high.view(np.int64)), int(low.view(np.int64))


def bitmap(shingles: np.ndarray) -> list[int]:
    """256 bits, each the parity of the shingles hashed to it: two sets differ in at least as many
    shingles as their bitmaps in bits."""
    bits = np.bincount((shingles >> np.uint64(20)) & np.uint64(64 * BITMAP_WORDS - 1), minlength=64 * BITMAP_WORDS)
    return np.packbits(bits & 1).view(np.int64).tolist()


def wide_bitmap(shingles: np.ndarray) -> bytes:
    """As ``bitmap`` with a bit or two for each shingle, a power of two; empty where that is no more."""
    bits = min(WIDE_BITS, 1 << max(0, len(shingles) - 1).bit_length())
    if bits <= 64 * BITMAP_WORDS:
        return b""
    places = (shingles >> np.uint64(20)) & np.uint64(bits - 1)
    return np.packbits(np.bincount(places, minlength=bits) & 1).tobytes()


def bits_apart(a: bytes, b: bytes) -> int:
    """The bits in which two wide bitmaps differ; halves of the wider one are folded by parity first."""
    x, y = np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)
    while len(x) != len(y):
        x, y = (x, y) if len(x) > len(y) else (y, x)
        x = x[: len(x) // 2] ^ x[len(x) // 2 :]
    return int(np.bitwise_count(x ^ y).sum())


def _counted(df: DataFrame, key: str, width: int) -> DataFrame:
    """Rows of documents (key, tag, n, high, low, bits, wide) and, apart, of each task's counters (slice, counts).

    A task counts to 255, which is as common as a shingle of its few documents needs to look.
    """
    schema = df.select(F.col("key")).schema.simpleString()[7:-1]
    counters = 1 << COUNTER_BITS

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, seen, kind = np.zeros(counters, np.uint8), set(), None
        for block in blocks(batches, "text"):
            kind = block.column("key").type
            sets = shingle_sets(*text_bytes(block.column("text")), width)
            hashes = [set_hash(s) for s in sets]
            for s, h in zip(sets, hashes, strict=True):
                if h not in seen:
                    seen.add(h)
                    at = s >> np.uint64(64 - COUNTER_BITS)
                    counts[at] = np.minimum(counts[at], 254) + 1
            yield pa.RecordBatch.from_arrays(
                [
                    block.column("key"),
                    block.column("tag"),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([h[0] for h in hashes], pa.int64()),
                    pa.array([h[1] for h in hashes], pa.int64()),
                    pa.array([bitmap(s) for s in sets], pa.list_(pa.int64())),
                    pa.array([wide_bitmap(s) for s in sets], pa.binary()),
                    pa.nulls(len(sets), pa.int32()),
                    pa.nulls(len(sets), pa.binary()),
                ],
                names=["key", "tag", "n", "high", "low", "bits", "wide", "slice", "counts"],
            )
        for number, part in enumerate(np.split(counts, SLICES) if kind is not None else ()):
            if part.any():
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.nulls(1, kind),
                        *(pa.nulls(1, pa.int64()) for _ in range(4)),
                        pa.nulls(1, pa.list_(pa.int64())),
                        pa.nulls(1, pa.binary()),
                        pa.array([number], pa.int32()),
                        pa.array([zlib.compress(part, 1)], pa.binary()),
                    ],
                    names=["key", "tag", "n", "high", "low", "bits", "wide", "slice", "counts"],
                )

    columns = "tag long, n long, high long, low long, bits array<bigint>, wide binary, slice int, counts binary"
    return df.mapInArrow(scan, f"{schema}, {columns}")


def _rarity(counted: DataFrame) -> np.ndarray:
    """The summed counters on a logarithmic scale of one byte: a table of 16 MB at any input size."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for number, part in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                counts = np.frombuffer(zlib.decompress(part), np.uint8)
                sums[number] = sums[number] + counts if number in sums else counts.astype(np.uint64)
        for number, total in sums.items():
            scaled = np.minimum(255, 6 * np.log2(1.0 + total)).astype(np.uint8)
            packed = zlib.compress(scaled, 1)  # the driver's JVM holds all rows at once
            yield pa.RecordBatch.from_pydict({"slice": pa.array([number], pa.int32()), "scaled": [packed]})

    slices = counted.where("slice IS NOT NULL").select("slice", "counts").repartition("slice")
    scaled = slices.mapInArrow(add, "slice int, scaled binary").collect()
    size = (1 << COUNTER_BITS) // SLICES
    table = np.zeros(1 << COUNTER_BITS, np.uint8)
    for row in scaled:
        table[row["slice"] * size : (row["slice"] + 1) * size] = np.frombuffer(zlib.decompress(row["scaled"]), np.uint8)
    return table


POSTING = np.dtype([("token", "<u8"), ("high", "<i8"), ("low", "<i8"), ("n", "<i4"), ("place", "<i4")])


def meeting(token: np.ndarray, n: np.ndarray, place: np.ndarray, percent: int) -> np.ndarray:
    """Marks postings, in order of shingle and size, that sizes and places let link with another of their shingle.

    One with more than NEIGHBOURS others in reach of its size on one side is marked whatever their places.
    """
    found = np.zeros(len(token), bool)
    for step in range(1, NEIGHBOURS + 2):
        n_a, n_b = n[:-step], n[step:]
        meet = (token[:-step] == token[step:]) & (100 * n_a >= percent * n_b)
        if step <= NEIGHBOURS:
            reach = np.minimum(n_a - place[:-step], n_b - place[step:])
            meet &= (100 + percent) * reach >= percent * (n_a + n_b)
        found[:-step] |= meet
        found[step:] |= meet
    return found


def _shared_prefixes(df: DataFrame, rarity, width: int, percent: int, buckets: int) -> DataFrame:
    """``high, low, n, place, token``: prefix shingles that two classes at least have in theirs and may link by.

    Postings travel as one array for each block of texts and bucket of shingles.  A task sends a
    class once, so copies don't pile up in the buckets of their shingles.
    """

    def post(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, seen = rarity.value, set()
        for block in blocks(batches, "text", 8 << 20):
            found = []
            for part in blocks([block], "text"):
                for s in shingle_sets(*text_bytes(part.column("text")), width):
                    h = set_hash(s)
                    if not len(s) or h in seen:
                        continue
                    seen.add(h)
                    order = table[s >> np.uint64(64 - COUNTER_BITS)].astype(np.uint64) << np.uint64(56)
                    first = np.sort(order | (s >> np.uint64(8)))[: len(s) + 1 + (-percent * len(s) // 100)]
                    rows = np.empty(len(first), POSTING)
                    rows["token"], rows["high"], rows["low"] = first, *h
                    rows["n"], rows["place"] = len(s), np.arange(len(first))
                    found.append(rows)
            if not found:
                continue
            rows = np.concatenate(found)
            bucket = (mix(rows["token"]) % np.uint64(buckets)).astype(np.int32)
            order = np.argsort(bucket, kind="stable")
            rows, bucket = rows[order], bucket[order]
            starts = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]])
            parts = [p.tobytes() for p in np.split(rows, starts[1:])]
            yield pa.RecordBatch.from_pydict(
                {"bucket": pa.array(bucket[starts], pa.int32()), "postings": pa.array(parts, pa.binary())}
            )

    def shared(group: pa.Table) -> pa.Table:
        data = b"".join(group.column("postings").to_pylist())
        rows = np.frombuffer(data, POSTING)
        rows = rows[np.lexsort([rows[c] for c in ("place", "low", "high", "n", "token")])]
        rows = rows[np.r_[True, rows[1:] != rows[:-1]][: len(rows)]]
        n, place = (rows[c].astype(np.int64) for c in ("n", "place"))
        rows = rows[meeting(rows["token"], n, place, percent)]
        return pa.table(
            {
                "high": rows["high"],
                "low": rows["low"],
                "n": rows["n"].astype(np.int64),
                "place": rows["place"].astype(np.int64),
                "token": rows["token"].view(np.int64) if len(rows) else np.zeros(0, np.int64),
            }
        )

    posted = df.select("text").mapInArrow(post, "bucket int, postings binary")
    return posted.groupBy("bucket").applyInArrow(
        shared, "high long, low long, n long, place long, token long"
    )


def _filter(nodes: DataFrame) -> np.ndarray:
    """A bitmap of the tags of ``nodes``: of a fixed size, so others may pass it, but none is missed."""

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits, used = np.zeros(1 << FILTER_BITS, bool), False
        for batch in batches:
            bits[_filter_place(batch.column("tag").to_numpy())] = True
            used = True
        for number, part in enumerate(np.split(np.packbits(bits), SLICES) if used else ()):
            if part.any():
                packed = pa.array([zlib.compress(part, 1)], pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array([number], pa.int32()), packed], names=["slice", "bits"])

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        joined: dict[int, np.ndarray] = {}
        for batch in batches:
            for number, part in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                bits = np.frombuffer(zlib.decompress(part), np.uint8)
                joined[number] = joined[number] | bits if number in joined else bits
        for number, bits in joined.items():
            packed = zlib.compress(bits, 1)
            yield pa.RecordBatch.from_pydict({"slice": pa.array([number], pa.int32()), "bits": [packed]})

    marked = nodes.select("tag").mapInArrow(mark, "slice int, bits binary").repartition("slice")
    size = (1 << FILTER_BITS) // 8 // SLICES
    whole = np.zeros((1 << FILTER_BITS) // 8, np.uint8)
    for row in marked.mapInArrow(join, "slice int, bits binary").collect():
        whole[row["slice"] * size : (row["slice"] + 1) * size] = np.frombuffer(zlib.decompress(row["bits"]), np.uint8)
    return whole


def _filter_place(tag: np.ndarray) -> np.ndarray:
    return (tag.view(np.uint64) >> np.uint64(64 - FILTER_BITS)).astype(np.int64)


def _read_sets(rows: DataFrame, wanted, width: int) -> DataFrame:
    """``high, low, shingles`` of the documents whose tag passes the filter, equal ones once a task."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bitmap_of, seen = wanted.value, set()
        for batch in batches:
            place = _filter_place(batch.column("tag").to_numpy())
            passes = (bitmap_of[place >> 3] >> (7 - (place & 7))) & 1
            found = []
            for block in blocks([batch.filter(pa.array(passes == 1))], "text"):
                for s in shingle_sets(*text_bytes(block.column("text")), width):
                    h = set_hash(s)
                    if len(s) and h not in seen:
                        seen.add(h)
                        found.append((*h, s))
            if found:
                high, low, kept = zip(*found, strict=True)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(high, pa.int64()),
                        pa.array(low, pa.int64()),
                        pa.array([s.tobytes() for s in kept], pa.binary()),
                    ],
                    names=["high", "low", "shingles"],
                )

    return rows.select("tag", "text").mapInArrow(read, "high long, low long, shingles binary")


def _needed(a, b, percent: int):
    """The overlap that sets of sizes a and b must have."""
    return F.ceil(percent * (a + b) / F.lit(100 + percent))


def _may_link(a: str, b: str, percent: int):
    """Whether bitmaps and sizes (columns ``bits``, ``n`` with suffixes) leave a link possible."""
    n = F.col(f"n{a}") + F.col(f"n{b}")
    return _distance(a, b) * (100 + percent) <= n * (100 - percent)


def _distance(a: str, b: str):
    """The number of bits in which two bitmaps differ."""
    words = (F.col(f"bits{a}")[i].bitwiseXOR(F.col(f"bits{b}")[i]) for i in range(BITMAP_WORDS))
    return sum(map(F.bit_count, words), F.lit(0))


def _near(pairs: DataFrame, members: DataFrame, percent: int) -> DataFrame:
    """The ``a, b`` of ``pairs`` whose wide bitmaps leave a link possible."""
    for side in ("a", "b"):
        wide = members.select(F.col("node").alias(side), *(F.col(c).alias(f"{c}_{side}") for c in ("n", "wide")))
        pairs = pairs.join(wide, side)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = (batch.column(c).to_pylist() for c in ("n_a", "n_b", "wide_a", "wide_b"))
            keep = [
                not x or not y or bits_apart(x, y) * (100 + percent) <= (n + m) * (100 - percent)
                for n, m, x, y in zip(*columns, strict=True)
            ]
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return pairs.mapInArrow(compare, "a long, b long")


def _links(pairs: DataFrame, rows: DataFrame, members: DataFrame, percent: int, width: int) -> DataFrame:
    """The ``a, b`` of ``pairs`` whose sets are similar enough; the sets are read from the texts anew.

    A filter of text hashes keeps most texts without a pair from being read at all.  Sets travel to the cell of the
    set they are compared with; a set with very many others has several cells.
    """
    pairs = materialize(_near(pairs, members, percent), "near-pairs")
    if pairs.isEmpty():
        return pairs
    ends = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    nodes = materialize(members.select("node", "high", "low", "tag").join(ends, "node"), "nodes")
    wanted = rows.sparkSession.sparkContext.broadcast(_filter(nodes))  # 2 ** FILTER_BITS bits
    # a cell is a set (role 0) with a part of those it is compared with (role 1)
    parts = pairs.groupBy("a").agg(F.ceil(F.count("*") / CELL_ROWS).cast("int").alias("parts"))
    part = F.pmod(F.xxhash64("b"), F.col("parts")).cast("int")
    compared = pairs.join(parts, "a").select("a", part.alias("part"), F.col("b").alias("node"), F.lit(1).alias("role"))
    numbers = F.explode(F.sequence(F.lit(0), F.col("parts") - 1))
    with_all = parts.select("a", numbers.alias("part"), F.col("a").alias("node"), F.lit(0).alias("role"))
    roles = compared.unionByName(with_all).join(nodes.drop("tag"), "node")
    sets = _read_sets(rows, wanted, width).dropDuplicates(["high", "low"])
    cells = (
        sets.join(roles, ["high", "low"])
        .select("a", "part", "role", "node", "shingles")
        .repartition("a", "part")
        .sortWithinPartitions("a", "part", "role")
    )

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell, one = None, None
        for batch in batches:
            keep = []
            columns = (batch.column(c).to_pylist() for c in ("a", "part", "role"))
            data, ends = text_bytes(batch.column("shingles"))
            for a, part, role, start, end in zip(*columns, ends[:-1].tolist(), ends[1:].tolist(), strict=True):
                other = data[start:end].view(np.uint64)  # not a copy: sets may be large
                if role == 0:
                    cell, one = (a, part), other.copy()
                    keep.append(False)
                    continue
                if cell != (a, part):
                    raise ValueError("a cell has lost the set to compare with")
                both = len(np.intersect1d(one, other, assume_unique=True))
                keep.append(100 * both >= percent * (len(one) + len(other) - both))
            linked = batch.select(["a", "node"]).filter(pa.array(keep, pa.bool_()))
            yield linked.rename_columns(["a", "b"])

    schema = pairs.select("a", "b").schema.simpleString()[7:-1]
    return materialize(cells.mapInArrow(verify, schema), "links")


def _stars(members: DataFrame, percent: int) -> DataFrame:
    """Candidates ``a, b`` of the first round: a few for each class, whatever meets in a shingle.

    Members of a group meet its smallest class.  That class meets, of the smallest classes of its
    shingles and size classes (its own and both beside it), the one whose bitmap is nearest and the
    smallest that the bitmaps allow.
    """
    leaders = members.groupBy("group").agg(F.min("node").alias("leader"))
    led = members.join(leaders, "group").select("node", "leader", "n", "bits", "prefix")
    led = materialize(led, "led")
    columns = ("node", "n", "bits")
    heads = led.where("node = leader")
    inner = led.where("node <> leader").select("leader", *(F.col(c).alias(f"{c}_b") for c in columns))
    inner = inner.join(heads.select(*(F.col(c).alias(f"{c}_a") for c in columns)), F.col("leader") == F.col("node_a"))
    inner = inner.where(_may_link("_a", "_b", percent)).select(F.col("node_a").alias("a"), F.col("node_b").alias("b"))

    step = max(np.log(100 / percent), 0.01)  # sets of one size class and of those beside it can link
    rows = heads.withColumn("size", F.floor(F.log("n") / F.lit(float(step)))).select(
        "node", "size", F.explode("prefix.token").alias("token")
    )
    centres = rows.groupBy("token", "size").agg(F.min("node").alias("centre"))
    near = F.explode(F.array(F.col("size") - 1, F.col("size"), F.col("size") + 1)).alias("size")
    met = rows.select("node", "token", near).join(centres, ["token", "size"]).where("node <> centre")
    met = met.select("node", "centre").distinct()
    met = met.join(heads.select(*(F.col(c).alias(f"{c}_a") for c in columns)), F.col("node") == F.col("node_a"))
    met = met.join(heads.select(*(F.col(c).alias(f"{c}_b") for c in columns)), F.col("centre") == F.col("node_b"))
    met = met.where(_may_link("_a", "_b", percent)).select("node_a", "centre", _distance("_a", "_b").alias("far"))
    best = met.groupBy("node_a").agg(F.min_by("centre", "far").alias("nearest"), F.min("centre").alias("smallest"))
    outer = best.select(
        F.col("node_a").alias("a"), F.explode(F.array_distinct(F.array("nearest", "smallest"))).alias("b")
    )
    both = inner.unionByName(outer)
    return both.select(F.greatest("a", "b").alias("b"), F.least("a", "b").alias("a")).select("a", "b").distinct()


def _units(members: DataFrame, labels: DataFrame) -> DataFrame:
    """Members with their component and unit: what a group has of one component, named by its smallest."""
    named = members.join(labels, "node", "left").withColumn("component", F.coalesce("component", "node"))
    units = named.groupBy("group", "component").agg(F.min("node").alias("unit"), F.count("*").alias("many"))
    named = named.join(units, ["group", "component"]).select("unit", "node", "component", "n", "bits", "many", "prefix")
    return materialize(named, "units")


def _open_shingles(named: DataFrame) -> DataFrame:
    """Shingles of several components: the one with most units there, the units, and those of all others."""
    rows = named.where("node = unit").select("component", F.explode("prefix.token").alias("token"))
    tokens = rows.groupBy("token", "component").agg(F.count("*").alias("units"))
    tokens = tokens.groupBy("token").agg(
        F.max_by("component", "units").alias("major"),
        F.sum("units").alias("units"),
        F.count("*").alias("components"),
        (F.sum("units") - F.max("units")).alias("outside"),
    )
    tokens = tokens.where("components > 1").select(
        "token", "major", "units", "outside", F.ceil(F.col("units") / TOKEN_ROWS).cast("int").alias("cells")
    )
    return materialize(tokens, "open-shingles")


def _crowded(named: DataFrame, tokens: DataFrame) -> bool:
    """Whether units that meet in crowded shingles would do so very often for their number."""
    met = tokens.where(F.col("outside") > CROWD).agg(F.sum(F.col("outside") * F.col("units")).alias("met"))
    met = met.first()["met"] or 0
    return met > 0 and met > MEETINGS * named.count()


def _drawn(named: DataFrame, tokens: DataFrame, turn: int, percent: int) -> DataFrame:
    """Candidates ``a, b`` of a round between: for each unit in a crowded shingle the nearest of the
    units drawn there, by bitmap, that are of another component.  Each round draws others."""
    step = max(np.log(100 / percent), 0.01)
    units = named.where("node = unit").withColumn("size", F.floor(F.log("n") / F.lit(float(step))))
    rows = units.select("unit", "component", "size", "n", "bits", F.explode("prefix.token").alias("token"))
    rows = rows.join(tokens.where(F.col("outside") > CROWD).select("token"), "token")
    order = F.xxhash64("unit", "token", F.lit(turn))
    drawn = rows.groupBy("token", "size", F.pmod(order, F.lit(DRAWN)).alias("draw")).agg(
        F.min_by(F.struct(*(F.col(c).alias(f"{c}_b") for c in ("unit", "component", "n", "bits"))), order).alias("other")
    )
    drawn = drawn.select("token", F.col("size").alias("size_b"), "other.*")
    near = F.explode(F.array(F.col("size") - 1, F.col("size"), F.col("size") + 1)).alias("size_b")
    rows = rows.select("token", near, *(F.col(c).alias(f"{c}_a") for c in ("unit", "component", "n", "bits")))
    met = rows.join(drawn, ["token", "size_b"])
    met = met.where((F.col("component_a") != F.col("component_b")) & _may_link("_a", "_b", percent))
    best = met.groupBy("unit_a").agg(F.min_by("unit_b", F.struct(_distance("_a", "_b"), "unit_b")).alias("unit_b"))
    return best.select(F.least("unit_a", "unit_b").alias("a"), F.greatest("unit_a", "unit_b").alias("b")).distinct()


def _across(named: DataFrame, tokens: DataFrame, percent: int) -> DataFrame:
    """Candidates ``a, b`` of the last round: all that may link two components of those before.

    Units of different components meet in a shingle; of the largest component of a shingle one side
    only is taken, which is cut into cells, so that a large component costs one meeting for each unit
    outside it.
    """
    rows = named.where("node = unit").select(
        "unit", "component", "n", "many", F.when(F.col("many") == 1, F.col("bits")).alias("bits"), F.inline("prefix")
    )
    rows = rows.join(tokens.drop("units", "outside"), "token")
    columns = ("unit", "component", "n", "many", "bits", "place")
    cell = F.explode(F.sequence(F.lit(0), F.col("cells") - 1)).alias("cell")
    left = rows.where("component <> major").select("token", cell, *(F.col(c).alias(f"{c}_a") for c in columns))
    cell = F.pmod(F.xxhash64("unit"), F.col("cells")).cast("int").alias("cell")
    right = rows.select("token", cell, "major", *(F.col(c).alias(f"{c}_b") for c in columns))
    reach = F.least(F.col("n_a") - F.col("place_a"), F.col("n_b") - F.col("place_b"))
    met = left.join(
        right,
        (left["token"] == right["token"])
        & (left["cell"] == right["cell"])
        & (F.col("component_a") != F.col("component_b"))
        & ((F.col("component_b") == F.col("major")) | (F.col("unit_a") < F.col("unit_b")))
        & (F.col("n_a") * 100 >= F.col("n_b") * percent)
        & (F.col("n_b") * 100 >= F.col("n_a") * percent)
        & (reach >= _needed(F.col("n_a"), F.col("n_b"), percent))
        & F.coalesce(_may_link("_a", "_b", percent), F.lit(True)),
    )
    ends = (F.struct(F.col(f"many{x}").alias("many"), F.col(f"unit{x}").alias("unit")) for x in ("_a", "_b"))
    ends = F.array_sort(F.array(*ends))  # the smaller unit is expanded first
    met = met.select(ends.alias("ends")).selectExpr("ends[0].unit AS u", "ends[1].unit AS v")
    met = materialize(met.distinct(), "unit-pairs")

    columns = ("node", "n", "bits")
    few = met.join(named.select(F.col("unit").alias("u"), *(F.col(c).alias(f"{c}_a") for c in columns)), "u")
    candidates = few.join(named.select(F.col("unit").alias("v"), *(F.col(c).alias(f"{c}_b") for c in columns)), "v")
    candidates = candidates.where(_may_link("_a", "_b", percent))
    a, b = F.least("node_a", "node_b"), F.greatest("node_a", "node_b")
    return candidates.select(a.alias("a"), b.alias("b")).distinct()


def similar_components(
    df: DataFrame, key: str = "doc_id", text: str = "text", percent: int = PERCENT, width: int = WORDS
) -> DataFrame:
    """``key``, ``n_shingles`` and ``component_id`` of every row of ``df``.

    Rows link when their sets of ``width``-word shingles have ``100 * intersection >= percent *
    union``; the component id is the smallest key reachable by links.  A text without words, empty
    or null, has no shingles and is linked with nothing; a row with a null key gets its component's
    id but never names it; equal rows are all returned; other columns are not read; an empty table
    gives an empty result.  Runs several jobs; what they share is written to the workspace.
    """
    spark = df.sparkSession
    rows = df.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
    rows = rows.withColumn("tag", F.xxhash64("text"))
    counted = materialize(_counted(rows, "key", width), "shingles")
    rarity = spark.sparkContext.broadcast(_rarity(counted))  # 2 ** COUNTER_BITS bytes
    documents = counted.where("slice IS NULL").select("key", "tag", "n", "high", "low", "bits", "wide")
    classes = documents.where("n > 0").groupBy("high", "low").agg(
        F.min("key").alias("key"), F.first("n").alias("n"), F.first("bits").alias("bits"),
        F.first("wide").alias("wide"), F.min("tag").alias("tag"), F.count("*").alias("copies"),
    )
    # The number stands for (high, low) from here on; it is written once, so all later jobs read the same.
    # Classes of many copies have the smaller numbers: they are what others are most likely near to.
    few = F.lit(127) - F.least(F.floor(6 * F.log2("copies")), F.lit(127))
    number = F.shiftleft(few.cast("long"), 56) + F.monotonically_increasing_id()
    classes = materialize(classes.withColumn("node", number).drop("copies"), "classes")

    buckets = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    shared = _shared_prefixes(rows, rarity, width, percent, buckets)
    entry = F.struct("place", F.col("token"))
    prefixes = shared.groupBy("high", "low", "n").agg(F.sort_array(F.collect_list(entry)).alias("prefix"))
    group = F.unhex(F.md5(F.concat_ws(",", F.col("n"), F.to_json("prefix"))))
    prefixes = prefixes.join(classes.drop("key", "n"), ["high", "low"]).withColumn("group", group)
    members = materialize(
        prefixes.select("node", "group", "n", "prefix", "bits", "high", "low", "tag", "wide"), "members"
    )

    links = _links(materialize(_stars(members, percent), "pairs"), rows, members, percent, width)
    labels, turn = components(links), 0
    while True:
        named = _units(members, labels)
        tokens = _open_shingles(named)
        if not _crowded(named, tokens):
            break
        drawn = materialize(_drawn(named, tokens, turn, percent), "drawn")
        found = _links(drawn, rows, members, percent, width)
        joined = found.count()
        if joined:
            links, turn = materialize(links.unionByName(found), "all-links"), turn + 1
            labels = components(links)
        if 2 * joined < drawn.count():  # mostly of components that aren't linked: those must all be compared
            if joined:
                named = _units(members, labels)
                tokens = _open_shingles(named)
            break
    more = _links(materialize(_across(named, tokens, percent), "pairs"), rows, members, percent, width)
    if not more.isEmpty():
        labels = components(links.unionByName(more))

    least = labels.join(classes.select("node", "key"), "node").groupBy("component").agg(F.min("key").alias("least"))
    least = materialize(least, "component-keys")
    named = classes.join(labels.join(least, "component").select("node", "least"), "node", "left").select(
        "high", "low", F.coalesce("least", "key").alias("class_component")
    )
    named = materialize(named, "class-components")
    documents = documents.drop("tag", "bits", "wide")
    alone = documents.where("n = 0").withColumn("class_component", F.col("key"))
    linked = documents.where("n > 0").join(named, ["high", "low"])
    return alone.unionByName(linked).select(
        F.col("key").alias(key), F.col("n").alias("n_shingles"), F.col("class_component").alias("component_id")
    )
