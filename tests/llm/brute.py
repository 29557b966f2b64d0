"""Plain Python versions of the operators, on lists of (key, text)."""

from __future__ import annotations

import hashlib
import re
from collections import Counter, defaultdict

BLANKS = re.compile(r"[^\x20\x09-\x0D]+")
LETTERS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(text: str | None) -> str:
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def shingles(text: str | None, width: int) -> frozenset:
    words = BLANKS.findall(lower(text))
    if len(words) < width:
        return frozenset([tuple(words)]) if words else frozenset()
    return frozenset(zip(*(words[i:] for i in range(width)), strict=False))


def similar(rows, percent: int = 90, width: int = 3) -> Counter:
    sets = [(key, shingles(text, width)) for key, text in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, (_, a) in enumerate(sets):
        for j, (_, b) in enumerate(sets[:i]):
            both = len(a & b)
            if a and b and 100 * both >= percent * (len(a) + len(b) - both):
                parent[find(i)] = find(j)
    least: dict[int, int] = {}
    for i, (key, _) in enumerate(sets):
        if key is not None:
            least[find(i)] = min(key, least.get(find(i), key))
    return Counter((key, len(s), least.get(find(i)) if s else key) for i, (key, s) in enumerate(sets))


def without_repeats(rows, width: int = 50) -> Counter:
    first: dict[bytes, int] = {}
    for key, text in rows:
        data = (text or "").encode()
        for p in range(len(data) - width + 1):
            window = data[p : p + width]
            if key is not None:
                first[window] = min(key, first.get(window, key))
    out = Counter()
    for key, text in rows:
        data = (text or "").encode()
        keep = [True] * len(data)
        for p in range(len(data) - width + 1):
            if key is not None and first[data[p : p + width]] < key:
                keep[p : p + width] = [False] * width
        kept = bytes(b for b, k in zip(data, keep, strict=True) if k)
        spans = sum(not k and (i == 0 or keep[i - 1]) for i, k in enumerate(keep))
        out[(key, len(data), len(data) - len(kept), spans, hashlib.sha256(kept).hexdigest())] += 1
    return out


def contaminated(rows, items, window: int = 13) -> Counter:
    found = defaultdict(set)
    for item, text in items:
        words = LETTERS.findall(lower(text))
        for s in range(max(1, len(words) - window + 1) if words else 0):
            found[tuple(words[s : s + window])].add(str(item))
    out = Counter()
    for key, text in rows:
        words = LETTERS.findall(lower(text))
        hit, hits = set(), set()
        for n in {len(w) for w in found}:
            for s in range(len(words) - n + 1):
                if items_there := found.get(tuple(words[s : s + n])):
                    hit.update(range(s, s + n))
                    hits |= items_there
        digest = hashlib.sha256(",".join(sorted(hits)).encode()).hexdigest()
        dirty = bool(hit) and 20 * len(hit) >= len(words)
        out[(key, len(words), len(hit), len(hits), digest, dirty)] += 1
    return out


def base_counts(text: str | None) -> tuple:
    text = text or ""
    words = BLANKS.findall(text)
    windows = Counter(zip(words, words[1:], words[2:], strict=False))
    repeated = set()
    for i in range(len(words) - 2):
        if windows[tuple(words[i : i + 3])] > 1:
            repeated |= {i, i + 1, i + 2}
    seen, again = set(), 0
    for line in text.split("\n"):
        if BLANKS.search(line):
            again += line in seen
            seen.add(line)
    symbols = sum(text.count(c) for c in "#*$%&|<>")
    return len(words), sum(map(len, words)), symbols, again, len(repeated)
