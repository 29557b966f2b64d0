"""Whole-batch views of text columns: one byte array and the offsets of its texts, without copies."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa

BLOCK_BYTES = 1 << 18  # texts handled together; only a longer single text makes a larger block


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string or binary column and ``len + 1`` offsets; null is empty."""
    if column.null_count:
        column = column.fill_null("" if not pa.types.is_binary(column.type) else b"")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, places, data = column.buffers()
    offsets = np.frombuffer(places, np.int64 if wide else np.int32)
    offsets = offsets[column.offset : column.offset + len(column) + 1].astype(np.int64)
    whole = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return whole[offsets[0] : offsets[-1]], offsets - offsets[0]


def blocks(
    batches: Iterable[pa.RecordBatch], text: str, limit: int = BLOCK_BYTES
) -> Iterator[pa.RecordBatch]:
    """Slices of the batches with at most ``limit`` bytes of text, one row at least.

    After the last, what Arrow keeps of freed batches goes back to the system: workers live on.
    """
    for batch in batches:
        if not len(batch):
            continue
        _, offsets = text_bytes(batch.column(text))
        start = 0
        while start < len(batch):
            end = int(np.searchsorted(offsets, offsets[start] + limit, "right")) - 1
            end = min(max(end, start + 1), len(batch))
            yield batch.slice(start, end - start)
            start = end
    pa.default_memory_pool().release_unused()


def mix(h: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit numbers."""
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(32)
    return h


_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_BASE = 0x2545F4914F6CDD1D
_INVERSE = pow(_BASE, -1, 1 << 64)


_KEPT: dict[int, np.ndarray] = {}
_KEPT_POWERS = 1 << 22


def _powers(base: int, n: int) -> np.ndarray:
    """base ** 0 .. base ** (n - 1), modulo 2 ** 64; up to 4 M of them are kept for the next block."""
    kept = _KEPT.get(base, _BYTE[:0])
    if len(kept) >= n:
        return kept[:n]
    out = _make_powers(base, min(_KEPT_POWERS, 2 * n) if n <= _KEPT_POWERS else n)
    if len(out) <= _KEPT_POWERS:
        _KEPT[base] = out
    return out[:n]


def _make_powers(base: int, n: int) -> np.ndarray:
    out = np.ones(max(n, 1), np.uint64)
    done, step = 1, np.uint64(base)
    while done < n:
        take = min(done, n - done)
        out[done : done + take] = out[:take] * step
        done += take
        with np.errstate(over="ignore"):
            step = step * step
    return out


def range_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hashes of byte ranges: prefix sums of ``byte * base ** place``, moved back to the start."""
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE[data] * _powers(_BASE, len(data)), out=total[1:])
    moved = (total[end] - total[start]) * _powers(_INVERSE, len(data) + 1)[start]
    return mix(moved + (end - start).astype(np.uint64))


class Words:
    """The words of a block of texts: maximal runs of bytes that ``is_word`` marks.

    ``start`` and ``end`` are byte places in the block, ``text`` the row of each word and
    ``key`` a 64-bit hash of its bytes after ``fold`` (a table of 256 bytes).  Words never
    cross texts.  Equal bytes have equal keys; different words share one with odds of 2**-64.
    """

    def __init__(
        self, data: np.ndarray, offsets: np.ndarray, is_word: np.ndarray, fold: np.ndarray
    ):
        inside = np.empty(len(data) + 2, bool)
        inside[0] = inside[-1] = False
        inside[1:-1] = is_word[data]
        change = inside[1:] != inside[:-1]
        # a text that ends in a word directly before one that starts with a word
        inner = offsets[1:-1]
        inner = inner[(inner > 0) & (inner < len(data))]
        joined = np.unique(inner[inside[inner] & inside[inner + 1]]) if len(inner) else inner
        edges = np.flatnonzero(change)
        if len(joined):
            edges = np.sort(np.concatenate([edges, joined, joined]))
        self.start, self.end = edges[0::2], edges[1::2]
        self.text = np.searchsorted(offsets, self.start, "right") - 1
        self.count = np.bincount(self.text, minlength=len(offsets) - 1)
        self._data, self._fold = data, fold

    @property
    def key(self) -> np.ndarray:
        return range_hashes(self._fold[self._data], self.start, self.end)


def lower_ascii() -> np.ndarray:
    """A byte table that maps A-Z to a-z and all else to itself."""
    table = np.arange(256, dtype=np.uint8)
    table[65:91] += 32
    return table


def words_between_blanks() -> np.ndarray:
    """Marks the bytes of ``[^\\x20\\x09-\\x0D]``."""
    table = np.ones(256, bool)
    table[[32, 9, 10, 11, 12, 13]] = False
    return table


def words_of_letters_and_digits() -> np.ndarray:
    """Marks the bytes of ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]``: 0-9, a-z, A-Z (folded) and non-ASCII."""
    table = np.zeros(256, bool)
    table[48:58] = table[97:123] = table[65:91] = table[128:] = True
    return table
