"""Finding benchmark phrases in documents with an FM-index of each shard of texts.

A shard is a block of whole documents inside a task, so nothing is shuffled: its words become
symbols, its index is built, all phrases are searched backward at once, and what is found is
reported for its documents.  Phrases are sent to the tasks in blocks of a fixed number, one pass
over the documents each, so a benchmark of any size fits.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftline.llm.buffers import Words, blocks, lower_ascii, mix, text_bytes, words_of_letters_and_digits
from weftline.workspace import materialize

WINDOW = 13
SHARD_BYTES = 2 << 20  # a task holds some 40 bytes for each while it looks for words
SAMPLED = 16  # every 16th suffix position is kept
PHRASES = 200_000  # phrases sent to the tasks at once: at most 13 x 8 bytes each


class WaveletMatrix:
    """Ranks in a sequence of small integers: one bit a level, zeros before ones from level to level."""

    def __init__(self, values: np.ndarray, symbols: int):
        self.levels = max(1, int(symbols - 1).bit_length())
        self.ones, self.zeros = [], []
        for level in reversed(range(self.levels)):
            bits = (values >> level) & 1
            before = np.zeros(len(values) + 1, np.int32)
            np.cumsum(bits, out=before[1:])
            self.ones.append(before)
            self.zeros.append(len(values) - int(before[-1]))
            values = np.concatenate([values[bits == 0], values[bits == 1]])

    def rank(self, symbol: np.ndarray, place: np.ndarray) -> np.ndarray:
        """How often ``symbol`` stands before ``place``, pairwise."""
        low, high = np.zeros_like(place), place
        for n, (ones, zeros) in enumerate(zip(self.ones, self.zeros, strict=True)):
            bit = (symbol >> (self.levels - 1 - n)) & 1 == 1
            low = np.where(bit, zeros + ones[low], low - ones[low])
            high = np.where(bit, zeros + ones[high], high - ones[high])
        return high - low

    def access(self, place: np.ndarray) -> np.ndarray:
        symbol = np.zeros_like(place)
        for ones, zeros in zip(self.ones, self.zeros, strict=True):
            bit = ones[place + 1] - ones[place]
            place = np.where(bit == 1, zeros + ones[place], place - ones[place])
            symbol = 2 * symbol + bit
        return symbol


class FMIndex:
    """Index of a sequence of symbols; 0 separates and is in no pattern."""

    def __init__(self, text: np.ndarray, symbols: int, sampled: int = SAMPLED):
        text = np.append(text.astype(np.int64) + 1, 0)  # a last symbol of its own, below all others
        symbols += 1
        order = _suffix_order(text)
        self.length = len(text)
        self.last = WaveletMatrix(text[order - 1], symbols)
        totals = np.bincount(text, minlength=symbols)
        self.below = np.cumsum(totals) - totals
        keep = (order % sampled == 0) | (order == 0)
        self.kept_before = np.zeros(len(order) + 1, np.int64)
        np.cumsum(keep, out=self.kept_before[1:])
        self.kept = order[keep]

    def search(self, patterns: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows [low, high) of the suffixes that begin with each pattern (its first ``length`` columns)."""
        low = np.zeros(len(patterns), np.int64)
        high = np.full(len(patterns), self.length, np.int64)
        live = np.arange(len(patterns))
        for step in range(int(lengths.max(initial=0))):
            at = lengths[live] - 1 - step
            live = live[(at >= 0) & (low[live] < high[live])]
            if not len(live):
                break
            symbol = patterns[live, lengths[live] - 1 - step] + 1
            first = self.below[symbol]
            low[live] = first + self.last.rank(symbol, low[live])
            high[live] = first + self.last.rank(symbol, high[live])
        return low, np.maximum(low, high)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text places of suffix rows: step back in the text until a kept position."""
        place, steps = np.full(len(rows), -1, np.int64), np.zeros(len(rows), np.int64)
        live, at = np.arange(len(rows)), rows.copy()
        while len(live):
            kept = self.kept_before[at + 1] > self.kept_before[at]
            done = live[kept]
            place[done] = self.kept[self.kept_before[at[kept]]] + steps[done]
            live, at = live[~kept], at[~kept]
            steps[live] += 1
            symbol = self.last.access(at)
            at = self.below[symbol] + self.last.rank(symbol, at)
        return place


def _suffix_order(text: np.ndarray) -> np.ndarray:
    """Suffix order by prefix doubling; only what is still tied is sorted again."""
    n = len(text)
    order = np.argsort(text, kind="stable")
    ordered = text[order]
    new = np.r_[True, ordered[1:] != ordered[:-1]]
    rank = np.empty(n, np.int64)
    rank[order] = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    depth = 1
    tied = np.flatnonzero(~(new & np.r_[new[1:], True]))
    while len(tied):
        place = order[tied]
        next_rank = np.full(len(place), -1, np.int64)
        inside = place + depth < n
        next_rank[inside] = rank[place[inside] + depth]
        key = rank[place] * (n + 1) + next_rank + 1
        by_key = np.argsort(key, kind="stable")
        place, key = place[by_key], key[by_key]
        order[tied] = place
        new = np.r_[True, key[1:] != key[:-1]]
        rank[place] = np.maximum.accumulate(np.where(new, tied, 0))
        tied = tied[~(new & np.r_[new[1:], True])]
        depth *= 2
    return order


@dataclass
class Phrases:
    """A block of phrases: word hashes (rows padded with 0), lengths, the items of each phrase."""

    words: np.ndarray
    lengths: np.ndarray
    item: np.ndarray  # (phrase, item) pairs, ordered by phrase
    phrase: np.ndarray

    def __post_init__(self) -> None:
        inside = np.arange(self.words.shape[1]) < self.lengths[:, None]
        self.vocabulary = np.unique(self.words[inside])
        self.symbols = np.where(inside, np.searchsorted(self.vocabulary, self.words) + 1, 0)
        pairs = _pair(self.words[:, :-1], self.words[:, 1:])[inside[:, 1:]]
        self.pairs = np.unique(pairs)
        self.single = np.unique(self.words[self.lengths == 1, 0])
        self.shortest = int(min(self.lengths[self.lengths > 1], default=0))


def _pair(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return mix(a * np.uint64(0x9E3779B97F4A7C15) + b)


def _among(values: np.ndarray, chosen: np.ndarray) -> np.ndarray:
    """Which of ``values`` are in the sorted ``chosen``; a table of their top bits settles most."""
    table = np.zeros(1 << 18, bool)
    table[(chosen >> np.uint64(46)).astype(np.int64)] = True
    found = table[(values >> np.uint64(46)).astype(np.int64)]
    maybe = np.flatnonzero(found)
    at = np.searchsorted(chosen, values[maybe])
    found[maybe] = chosen[np.minimum(at, len(chosen) - 1)] == values[maybe] if len(chosen) else False
    return found


def phrase_blocks(benchmark: DataFrame, key: str, text: str, window: int) -> Iterator[Phrases]:
    """The windows of all items, in blocks of at most PHRASES, equal windows together.

    Windows are made and sorted by Spark; a block at a time is read by the driver.
    """
    items = benchmark.select(F.col(key).cast("string").alias("item"), F.col(text).cast("string").alias("text"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, "text"):
            words = Words(*text_bytes(block.column("text")), words_of_letters_and_digits(), lower_ascii())
            keys = words.key.view(np.int64)
            first = np.cumsum(words.count) - words.count
            item, windows = [], []
            for name, at, n in zip(block.column("item").to_pylist(), first.tolist(), words.count.tolist(), strict=True):
                for start in range(max(1, n - window + 1) if n else 0):
                    item.append(name)
                    windows.append(keys[at + start : at + min(n, start + window)])
            yield pa.RecordBatch.from_pydict(
                {"item": pa.array(item, pa.string()), "words": pa.array(windows, pa.list_(pa.int64()))}
            )

    windows = items.mapInArrow(cut, "item string, words array<bigint>").distinct()
    grouped = windows.groupBy("words").agg(F.collect_set("item").alias("items"))
    parts = F.pmod(F.xxhash64("words"), F.lit(1 << 20)).alias("part")
    grouped = materialize(grouped.select("words", "items", parts), "phrases")
    total = grouped.count()
    steps = max(1, -(-total * 5 // (PHRASES * 4))) if total else 0
    size = -(-(1 << 20) // max(1, steps))
    for step in range(steps):
        rows = grouped.where(F.col("part").between(step * size, (step + 1) * size - 1)).collect()
        if not rows:
            continue
        lengths = np.array([len(r["words"]) for r in rows])
        words = np.zeros((len(rows), window), np.int64)
        for i, r in enumerate(rows):
            words[i, : lengths[i]] = r["words"]
        items = [r["items"] for r in rows]
        yield Phrases(
            words.view(np.uint64),
            lengths,
            np.array([x for i in items for x in i], object),
            np.repeat(np.arange(len(rows)), [len(i) for i in items]),
        )


def find_in_shard(keys: np.ndarray, text: np.ndarray, phrases: Phrases) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``word, length, phrase`` of all occurrences; ``keys`` are the shard's words, ``text`` their rows.

    Only places where a phrase could stand are indexed: runs of words all of whose neighbouring
    pairs occur in phrases, as long as the shortest phrase, and words that are phrases themselves.
    """
    none = np.zeros(0, np.int64)
    if not len(keys):
        return none, none, none
    joined = (text[1:] == text[:-1]) & _among(_pair(keys[:-1], keys[1:]), phrases.pairs)
    edges = np.flatnonzero(np.diff(np.r_[False, joined, False]))
    begin, end = edges[0::2], edges[1::2] + 1  # words begin .. end - 1 are joined
    long = end - begin >= max(2, phrases.shortest)
    if not phrases.shortest:
        long[:] = False
    begin, end = begin[long], end[long]
    if len(phrases.single):
        alone = np.flatnonzero(_among(keys, phrases.single))
        covered = np.zeros(len(keys) + 1, np.int64)
        np.add.at(covered, begin, 1)
        np.add.at(covered, end, -1)
        alone = alone[np.cumsum(covered)[alone] == 0]
        begin, end = np.r_[begin, alone], np.r_[end, alone + 1]
    if not len(begin):
        return none, none, none
    size = end - begin
    at = np.cumsum(size + 1) - size - 1
    place = np.repeat(begin - at, size + 1) + np.arange(int((size + 1).sum()))
    symbols = np.zeros(len(place), np.int64)
    inside = np.ones(len(place), bool)
    inside[at + size] = False
    symbols[inside] = np.searchsorted(phrases.vocabulary, keys[place[inside]]) + 1
    index = FMIndex(symbols, len(phrases.vocabulary) + 1)
    low, high = index.search(phrases.symbols, phrases.lengths)
    count = high - low
    which = np.repeat(np.arange(len(count)), count)
    rows = np.arange(len(which)) - np.repeat(np.cumsum(count) - count, count) + low[which]
    return place[index.locate(rows)], phrases.lengths[which], which


def contamination(
    df: DataFrame,
    benchmark: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    item_key: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
) -> DataFrame:
    """``df`` with ``n_words``, ``n_hit``, ``hit_items``, ``hit_spans`` and ``contaminated``.

    A word is hit if it lies in an occurrence of ``window`` consecutive words of an item, or of a
    whole shorter item.  ``hit_items`` are the item ids as strings, sorted; ``hit_spans`` the merged
    byte spans of hit words, for :func:`cut_spans`; a row is contaminated if 20 * n_hit >= n_words
    and n_hit > 0.  Null and empty texts have no words, items without words no windows; repeated
    rows are all returned, equal items count as items of their own; columns named like the new ones
    are replaced; an empty table gives an empty result, an empty benchmark no hits.
    """
    added = ("n_words", "n_hit", "hit_items", "hit_spans", "contaminated")
    df = df.drop(*added)
    names = df.columns

    def search(sent) -> object:
        def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            phrases = sent.value if sent is not None else None
            for block in blocks(batches, text, SHARD_BYTES):
                yield _report(block, text, names, phrases)

        return task

    found = df.withColumns(
        {
            "n_words": F.lit(0).cast("long"),
            "__hits": F.array().cast("array<struct<start:bigint,end:bigint,first:bigint,last:bigint>>"),
            "__items": F.array().cast("array<string>"),
        }
    )
    schema = found.schema
    passes = 0
    for phrases in phrase_blocks(benchmark, item_key, item_text, window):  # each adds to the last
        sent = df.sparkSession.sparkContext.broadcast(phrases)
        found = (materialize(found, "found") if passes else found).mapInArrow(search(sent), schema)
        passes += 1
    if not passes:
        found = found.mapInArrow(search(None), schema)
    hits = F.aggregate(
        "__hits",
        F.lit(0).cast("long"),
        lambda total, h: total + h["last"] - h["first"],
    )
    spans = F.transform("__hits", lambda h: F.struct(h["start"].alias("start"), h["end"].alias("end")))
    return found.select(
        *names,
        "n_words",
        hits.alias("n_hit"),
        F.array_sort(F.array_distinct("__items")).alias("hit_items"),
        spans.alias("hit_spans"),
        ((hits > 0) & (hits * 20 >= F.col("n_words"))).alias("contaminated"),
    )


def _report(block: pa.RecordBatch, text: str, names: list[str], phrases: Phrases | None) -> pa.RecordBatch:
    """The block with the occurrences of ``phrases`` added to those found before."""
    data, offsets = text_bytes(block.column(text))
    words = Words(data, offsets, words_of_letters_and_digits(), lower_ascii())
    keys, rows, starts, ends, count = words.key, words.text, words.start, words.end, words.count
    if phrases is None:
        at = length = which = np.zeros(0, np.int64)
    else:
        at, length, which = find_in_shard(keys, rows, phrases)
    before = block.column("__hits")
    earlier = np.repeat(np.arange(len(block)), before.value_lengths().to_numpy(zero_copy_only=False))
    flat, origin = before.flatten(), (np.cumsum(count) - count)[earlier]
    hit = np.zeros(len(keys) + 1, np.int64)
    np.add.at(hit, np.r_[at, origin + flat.field("first").to_numpy(zero_copy_only=False)], 1)
    np.add.at(hit, np.r_[at + length, origin + flat.field("last").to_numpy(zero_copy_only=False)], -1)
    hit = np.cumsum(hit[:-1]) > 0
    new = hit & np.r_[True, ~hit[:-1] | (rows[1:] != rows[:-1])] if len(hit) else hit
    first = np.flatnonzero(new)
    after = np.flatnonzero(hit & np.r_[~hit[1:] | (rows[1:] != rows[:-1]), True]) + 1 if len(hit) else first
    row = rows[first]
    spans = {
        "start": starts[first] - offsets[row],
        "end": ends[after - 1] - offsets[row],
        "first": first - (np.cumsum(count) - count)[row],
        "last": after - (np.cumsum(count) - count)[row],
    }
    per_row = np.searchsorted(row, np.arange(len(block) + 1))
    values = pa.StructArray.from_arrays([pa.array(v.astype(np.int64)) for v in spans.values()], names=list(spans))
    hits = pa.ListArray.from_arrays(pa.array(per_row, pa.int32()), values)
    items = [set(found) for found in block.column("__items").to_pylist()]
    if phrases is not None and len(at):
        found = np.unique(np.stack([rows[at], which], axis=1), axis=0)
        low, high = (np.searchsorted(phrases.phrase, found[:, 1], side) for side in ("left", "right"))
        for r, a, b in zip(found[:, 0].tolist(), low.tolist(), high.tolist(), strict=True):
            items[r].update(phrases.item[a:b])
    columns = [block.column(n) for n in names]
    columns += [pa.array(count.astype(np.int64)), hits, pa.array([sorted(i) for i in items], pa.list_(pa.string()))]
    return pa.RecordBatch.from_arrays(columns, names=[*names, "n_words", "__hits", "__items"])


def cut_spans(text: bytes, spans: list[tuple[int, int]]) -> bytes:
    """``text`` without the byte spans."""
    kept, at = [], 0
    for start, end in spans:
        kept.append(text[at:start])
        at = end
    return b"".join([*kept, text[at:]])

