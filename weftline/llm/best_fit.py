"""Packing token pieces into sequences: dominance reduction, then best fit, on a histogram of lengths.

A plan needs only how many pieces there are of each length, so the corpus is reduced to a histogram
of at most ``capacity`` counts, whatever its size.  :func:`plan` first fixes sets of pieces that
dominate every other way to fill a sequence with their largest piece (Martello and Toth), in bulk
for all pieces of a length, and packs the remainder by best fit decreasing, also in bulk.  Its
result is a list of ranges: the pieces of length L with ranks a to b go to sequences from s on, k
each, from offset o on.  Spark numbers the pieces of each length and looks up their range.
"""

from __future__ import annotations

import re
import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import chain

import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from weftline.llm.buffers import blocks
from weftline.workspace import materialize

CAPACITY = 4096
END_ID = 1
CACHED_RUNS = 600_000  # encoded runs that a worker keeps, some 250 bytes each; cleared when full
RANK_BUCKETS = 1024  # ranges in which the pieces of one length are numbered


#: Letters up to U+024F (one NFC form, one lower case, all \\p{L}) and a tail of punctuation.
PLAIN_RUN = re.compile("([A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u024f]+)([.,!?;:*$%&|#]*)")


def byte_letters() -> dict[int, str]:
    """The letter that byte-level tokenizers write for each byte: itself if printable, else 256 on."""
    own = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = iter(range(256, 512))
    return {byte: chr(byte if byte in own else next(others)) for byte in range(256)}


class Encoder:
    """Ids of many texts by the library, each distinct run between blanks encoded once.

    The tokenizer never joins characters across white space, and its steps before (NFC, lower case)
    do not look across it either, so the ids of a text are those of its runs in order.  Only space
    and line feed separate runs here; other white space stays inside a run, for the library.  Runs
    of plain letters and closing punctuation, which the tokenizer always parts, are handed to the
    library's model as two words; all others go through its whole pipeline.  A lower-cased word is a
    run too: its ids are kept under that name only, and capitals and punctuation build on them.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.model = self.tokenizer.model
        self.letters = byte_letters()
        self._clear()

    def _clear(self) -> None:
        self.known: dict[str, int] = {"": 0}
        self.tails: dict[str, list[int]] = {"": []}
        self.ids = np.zeros(0, np.uint32)
        self.start, self.size = np.zeros(1, np.int64), np.zeros(1, np.int64)

    def _word(self, word: str) -> list[int]:
        written = word if word.isascii() else "".join(map(self.letters.get, word.encode()))
        return [token.id for token in self.model.tokenize(written)]

    def _tail(self, tail: str) -> list[int]:
        found = self.tails.get(tail)
        if found is None:
            found = self.tails[tail] = self._word(tail)
        return found

    def _keep(self, runs: list[str], encoded: list[list[int]]) -> None:
        sizes = np.fromiter(map(len, encoded), np.int64, len(encoded))
        flat = np.fromiter(chain.from_iterable(encoded), np.uint32, int(sizes.sum()))
        first = len(self.ids) + np.cumsum(sizes) - sizes
        self.known.update(zip(runs, range(len(self.start), len(self.start) + len(runs)), strict=True))
        self.ids = np.concatenate([self.ids, flat])
        self.start = np.concatenate([self.start, first])
        self.size = np.concatenate([self.size, sizes])

    def _learn(self, runs: list[str]) -> None:
        """Keep the ids of new ``runs``, and of their lower-cased words as the runs that these are too."""
        words, formed, hard = {}, [], []
        for run in runs:
            if not (plain := PLAIN_RUN.fullmatch(run)):
                hard.append(run)
                continue
            word, tail = plain.groups()
            if (word := word.lower()) not in self.known:
                words[word] = None
            if run != word:
                formed.append((run, word, tail))
        # one by one: a batch goes to the library's threads, which cost a task of one core more than a few runs do
        whole = [self.tokenizer.encode(run, add_special_tokens=False).ids for run in hard]
        self._keep([*words, *hard], [*map(self._word, words), *whole])
        at = [self.known[word] for _, word, _ in formed]
        parts = zip(self.start[at].tolist(), self.size[at].tolist(), formed, strict=True) if formed else ()
        encoded = [self.ids[start : start + size].tolist() + self._tail(tail) for start, size, (_, _, tail) in parts]
        self._keep([run for run, _, _ in formed], encoded)

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        runs: list[str] = []
        ends = []
        for text in texts:
            runs += text.replace("\n", " ").split(" ")
            ends.append(len(runs))
        if len(self.known) > CACHED_RUNS:
            self._clear()
        new = list(set(runs).difference(self.known))
        if new:
            self._learn(new)
        at = np.fromiter(map(self.known.__getitem__, runs), np.int64, len(runs))
        sizes = self.size[at]
        after = np.cumsum(sizes)
        places = np.repeat(self.start[at] - (after - sizes), sizes) + np.arange(int(sizes.sum()))
        ids = self.ids[places]
        cuts = after[np.asarray(ends, np.int64) - 1] if runs else np.zeros(0, np.int64)
        return np.split(ids, cuts[:-1])


@dataclass
class Plan:
    """``ranges``: rows (length, rank from, rank to, first sequence, pieces a sequence, offset)."""

    capacity: int
    ranges: list[tuple[int, int, int, int, int, int]] = field(default_factory=list)
    sequences: int = 0
    fixed: int = 0  # sequences fixed by dominance

    def put(self, used: dict[int, int], length: int, n: int, first: int, each: int, offset: int) -> None:
        rank = used.get(length, 0)
        used[length] = rank + n
        self.ranges.append((length, rank, rank + n, first, each, offset))


def _dominating(item: int, left: dict[int, int], sizes: list[int], capacity: int) -> list[int] | None:
    """A set with ``item`` that no other use of it can beat; None if unproven.

    ``sizes`` are the lengths left in ascending order, larger ones than the item included.  A set
    {item} + P dominates when every other set with the item can trade its rest for pieces of P
    without making any sequence longer: each single piece or group of the rest must fit in the
    place of one piece of P.
    """
    room = capacity - item

    def count(size: int) -> int:
        return left[size] - (size == item)

    def largest(limit: int, without: tuple[int, ...] = ()) -> int:
        at = bisect_left(sizes, limit + 1) - 1
        while at >= 0 and count(sizes[at]) - without.count(sizes[at]) <= 0:
            at -= 1
        return sizes[at] if at >= 0 else 0

    best = largest(room)
    if not best or best == room:
        return [item, best] if best else [item]  # nothing fits, or an exact fit
    smallest: list[int] = []
    for size in sizes:
        smallest += [size] * min(4 - len(smallest), count(size))
        if len(smallest) >= 4:
            break
    if len(smallest) < 2 or smallest[0] + smallest[1] > room:
        return [item, best]  # one more piece at most: the largest
    if len(smallest) >= 3 and sum(smallest[:3]) <= room:
        return None
    # two more pieces at most: the best pair, and the largest second piece of any pair
    pair, second = (0, 0), 0
    for size in reversed(sizes[: bisect_left(sizes, room)]):
        if count(size) <= 0:
            continue
        other = largest(min(size, room - size), (size,))
        if other:
            pair = max(pair, (size, other), key=sum)
            second = max(second, other)
        if size * 2 <= room and sum(pair) >= 2 * size:
            break
    if best >= sum(pair):
        return [item, best]
    if pair[0] == best and pair[1] >= second:
        return [item, *pair]
    return None


PASSES = 4


def _fix_dominating(left: dict[int, int], result: Plan, used: dict[int, int]) -> list[tuple[int, int, int]]:
    """Fix dominating sets, taking their pieces out of ``left``; the room that they leave.

    Lengths are tried from the largest down.  One that is unproven stays among the pieces against
    which the others are proven.  Sets that are fixed remove alternatives, so unproven lengths are
    tried again, in ``PASSES`` passes at most: what is then left goes to best fit.
    """
    sizes = sorted(left)
    groups: list[tuple[int, int, int]] = []  # (room, first sequence, sequences), ascending
    for _ in range(PASSES):
        before = result.fixed
        for item in sizes[::-1]:
            while left.get(item):
                chosen = _dominating(item, left, sizes, result.capacity)
                if chosen is None:
                    break
                # in bulk: taking copies of the set only removes alternatives, so it dominates while they last
                many = min(left[s] // chosen.count(s) for s in set(chosen))
                offset = 0
                for size in chosen:
                    result.put(used, size, many, result.sequences, 1, offset)
                    left[size] -= many
                    if not left[size]:
                        del left[size]
                        sizes.pop(bisect_left(sizes, size))
                    offset += size
                if offset < result.capacity:
                    insort(groups, (result.capacity - offset, result.sequences, many))
                result.sequences += many
                result.fixed += many
        if result.fixed == before:
            break
    return groups


def _best_fit(left: dict[int, int], groups: list[tuple[int, int, int]], result: Plan, used: dict[int, int]) -> None:
    """Best fit decreasing of ``left`` into the room of ``groups`` and new sequences; equal ones are one group."""
    capacity = result.capacity
    for size in sorted(left, reverse=True):
        n = left[size]
        while n:
            at = bisect_left(groups, (size,))
            if at < len(groups):
                room, first, sequences = groups.pop(at)
            else:
                room, first = capacity, result.sequences
                sequences = -(-n // (capacity // size))
                result.sequences += sequences
            each = room // size
            full = min(sequences, n // each)
            if full:
                result.put(used, size, full * each, first, each, capacity - room)
                n -= full * each
                if room - each * size:
                    insort(groups, (room - each * size, first, full))
            if full < sequences and n and n < each:
                result.put(used, size, n, first + full, each, capacity - room)
                insort(groups, (room - n * size, first + full, 1))
                n, full = 0, full + 1
            if full < sequences:
                insort(groups, (room, first + full, sequences - full))


def plan(histogram: dict[int, int], capacity: int = CAPACITY) -> Plan:
    """Pack ``histogram`` (length -> pieces) into sequences of ``capacity``.

    The instance is reduced by dominating sets and best fit packs the rest, into their room too.
    Plain best fit packs the whole as well, and the plan of fewer sequences counts (of equal ones the
    reduced one), so a reduction never costs a sequence.  Work and result depend on the number of
    different lengths only: bulk steps leave at most a few groups of equal sequences for each.
    """
    pieces = {size: n for size, n in histogram.items() if n > 0}
    if any(not 0 < size <= capacity for size in pieces):
        raise ValueError(f"lengths must be 1 to {capacity}")
    plain, reduced = Plan(capacity), Plan(capacity)
    _best_fit(pieces, [], plain, {})
    left, used = dict(pieces), {}
    groups = _fix_dominating(left, reduced, used)
    _best_fit(left, groups, reduced, used)
    return reduced if reduced.sequences <= plain.sequences else plain


PIECE = "piece int, start long, length long, ids_crc32 long"


def token_pieces(df: DataFrame, key: str, text: str, tokenizer: str, capacity: int) -> DataFrame:
    """``key``, ``piece``, ``start``, ``length``, ``ids_crc32``: whole documents, the longer ones cut."""
    schema = df.select(F.col(key).alias("key")).schema.simpleString()[7:-1]
    rows = df.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(tokenizer)
        for block in blocks(batches, "text"):
            texts = [t or "" for t in block.column("text").to_pylist()]
            which, pieces, starts, lengths, sums = [], [], [], [], []
            for row, ids in enumerate(encoder.encode(texts)):
                ids = np.append(ids, np.uint32(END_ID)).astype("<u4")
                for piece, start in enumerate(range(0, len(ids), capacity)):
                    part = ids[start : start + capacity]
                    which.append(row)
                    pieces.append(piece)
                    starts.append(start)
                    lengths.append(len(part))
                    sums.append(zlib.crc32(part.tobytes()))
            yield pa.RecordBatch.from_arrays(
                [
                    block.column("key").take(pa.array(which, pa.int64())),
                    pa.array(pieces, pa.int32()),
                    pa.array(starts, pa.int64()),
                    pa.array(lengths, pa.int64()),
                    pa.array(sums, pa.int64()),
                ],
                names=["key", "piece", "start", "length", "ids_crc32"],
            )

    return rows.mapInArrow(cut, f"{schema}, {PIECE}").withColumnRenamed("key", key)


def pack(
    df: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    tokenizer: str | None = None,
    capacity: int = CAPACITY,
) -> DataFrame:
    """One row for each piece: ``key``, the columns of :func:`token_pieces`, ``sequence_id``, ``offset``.

    Runs two jobs (tokenize and store the pieces' sizes; count them).  The histogram that reaches
    the driver has at most ``capacity`` rows for each of 1024 hash ranges: pieces are ranked by
    (range, key) within their length, so that no length, however common, is numbered in one task.
    A null or empty text is one piece of one token; repeated rows are packed each; equal keys are
    ranked in any order; other columns are not read; an empty table gives an empty result.
    """
    path = tokenizer or public_tokenizers.path("word_bpe_49k.json")
    spread = F.pmod(F.xxhash64("key", "piece"), F.lit(RANK_BUCKETS)).cast("int")
    pieces = token_pieces(df.select(F.col(key).alias("key"), F.col(text)), "key", text, path, capacity)
    pieces = materialize(pieces.withColumn("bucket", spread), "pieces")
    counts = pieces.groupBy("length", "bucket").agg(F.count("*").alias("n"))
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    planned = plan(histogram, capacity)
    schema = "at_length long, low long, high long, first long, each long, from_offset long"
    spark = df.sparkSession
    ranges = spark.createDataFrame(pd.DataFrame(planned.ranges, columns=schema.split()[::2][:6]), schema) if (
        planned.ranges
    ) else spark.createDataFrame([], schema)
    earlier = Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    firsts = counts.select(
        F.col("length").alias("in_length"),
        F.col("bucket").alias("in_bucket"),
        F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"),
    )
    inside = Window.partitionBy("length", "bucket").orderBy("key", "piece")
    rank = F.col("before") + F.col("number")
    ranked = (
        pieces.withColumn("number", F.row_number().over(inside) - 1)
        .join(firsts, (F.col("length") == F.col("in_length")) & (F.col("bucket") == F.col("in_bucket")))
        .withColumn("rank", rank)
    )
    inside_range = F.col("rank") - F.col("low")
    return ranked.join(
        F.broadcast(ranges),  # a few ranges for each of at most `capacity` lengths
        (F.col("length") == F.col("at_length")) & (F.col("rank") >= F.col("low")) & (F.col("rank") < F.col("high")),
    ).select(
        F.col("key").alias(key),
        "piece",
        "start",
        "length",
        "ids_crc32",
        (F.col("first") + F.floor(inside_range / F.col("each"))).cast("long").alias("sequence_id"),
        (F.col("from_offset") + (inside_range % F.col("each")) * F.col("length")).alias("offset"),
    )
