"""Secrets in texts: patterns, and encoded candidates that are decoded and parsed before they count.

A run of base64 or hex digits is reported when what it encodes has the structure of a private key
(DER with nested lengths that fill each other exactly, or the OpenSSH container) or when it is a
signed token whose header names its algorithm and whose signature has that algorithm's length.
"""

from __future__ import annotations

import base64
import binascii
import json
import re
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame

# The base patterns are fixed by the contract of the query; letters of the names in either case.
ASSIGN = re.compile(
    r"""(?ai:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
ACCESS = re.compile("AKIA[A-Z0-9]+")
HEX = re.compile("(?<![0-9a-f])[0-9a-f]{24,}")  # maximal runs, which `[0-9a-f]+` matches as well
LEAST_SECRET, LEAST_ACCESS = 6, 20

#: In the order in which spans with one start are listed.
KINDS = ("assign", "access", "hex", "key", "openssh", "jwt")

# A DER sequence or the container's name in base64, 40 digits at least in the first line.  Lines may
# be wrapped, as in PEM bodies, by line breaks or by their escapes in quoted strings.
WRAP = r"(?:\r?\n|(?:\\r)?\\n)"
DIGITS = "[A-Za-z0-9+/_-]"
BASE64_RUN = re.compile(
    rf"(?:(?<!{DIGITS})|(?<=\\n))(?:M[A-P]|b3BlbnNzaC1rZXktdjE){DIGITS}{{38,}}(?:{WRAP}{DIGITS}+)*={{0,2}}"
)
HEX_RUN = re.compile(r"(?<![0-9A-Fa-f])(?:30|6[fF]70656[eE])(?:[0-9A-Fa-f]{2}){19,}")
JWT = re.compile(rf"(?<!{DIGITS})(ey[A-Za-z0-9_-]+)\.([A-Za-z0-9_-]+)\.([A-Za-z0-9_-]+)")
SIGNATURE_BYTES = {"HS256": 32, "HS384": 48, "HS512": 64, "ES256": 64, "ES384": 96, "ES512": 132, "EDDSA": 64}
OPENSSH = b"openssh-key-v1\0"

SEQUENCE, INTEGER, OCTETS, OID, BITS = 0x30, 0x02, 0x04, 0x06, 0x03


class Span(NamedTuple):
    start: int
    kind: int
    end: int


def base_spans(text: str) -> list[Span]:
    """Matches of the three patterns, leftmost and without overlap in each; too short ones go."""
    spans = []
    for m in ASSIGN.finditer(text):
        if m.end(1) - m.start(1) >= LEAST_SECRET:
            spans.append(Span(m.start(), 0, m.end()))
    spans += [Span(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= LEAST_ACCESS]
    return spans + [Span(m.start(), 2, m.end()) for m in HEX.finditer(text)]


def element(data: bytes, at: int, end: int) -> tuple[int, int, int] | None:
    """(tag, start, end) of the contents of the DER element at ``at``, if it lies before ``end``."""
    if at + 2 > end:
        return None
    tag, size, at = data[at], data[at + 1], at + 2
    if size & 0x80:
        digits = size & 0x7F
        if not 1 <= digits <= 4 or at + digits > end or data[at] == 0:
            return None
        size, at = int.from_bytes(data[at : at + digits], "big"), at + digits
        if size < 0x80:
            return None  # DER takes the shortest form
    return (tag, at, at + size) if at + size <= end else None


def children(data: bytes, start: int, end: int) -> list[tuple[int, int, int]] | None:
    """The elements that fill ``start`` to ``end`` exactly; no element more than a key can have."""
    found = []
    while start < end:
        inner = element(data, start, end)
        if inner is None or len(found) == 16:
            return None
        found.append(inner)
        start = inner[2]
    return found


def der_key_size(data: bytes) -> int:
    """The bytes of the DER private key that ``data`` starts with, or 0."""
    outer = element(data, 0, len(data))
    if outer is None or outer[0] != SEQUENCE:
        return 0
    inside = children(data, outer[1], outer[2])
    if not inside:
        return 0
    tags = [tag for tag, _, _ in inside]

    def algorithm(part: tuple[int, int, int]) -> bool:
        named = children(data, part[1], part[2])
        return bool(named) and named[0][0] == OID and named[0][2] > named[0][1]

    def small(part: tuple[int, int, int], values: tuple[int, ...]) -> bool:
        return part[2] - part[1] == 1 and data[part[1]] in values

    if tags[:3] == [INTEGER, SEQUENCE, OCTETS]:  # PKCS 8
        fits = small(inside[0], (0, 1)) and algorithm(inside[1]) and inside[2][2] > inside[2][1]
    elif tags == [SEQUENCE, OCTETS]:  # PKCS 8, encrypted
        fits = algorithm(inside[0]) and inside[1][2] - inside[1][1] >= 16
    elif tags[:2] == [INTEGER, OCTETS]:  # elliptic curve
        size = inside[1][2] - inside[1][1]
        rest = all(tag in (0xA0, 0xA1) and children(data, a, e) for tag, a, e in inside[2:])
        fits = small(inside[0], (1,)) and 16 <= size <= 66 and rest
    elif len(tags) in (9, 6) and set(tags) == {INTEGER}:  # RSA and DSA
        fits = small(inside[0], (0, 1)) and inside[1][2] - inside[1][1] >= 32
    else:
        fits = False
    return outer[2] if fits else 0


def openssh_size(data: bytes) -> int:
    """The bytes of the OpenSSH private key container that ``data`` starts with, or 0."""
    if not data.startswith(OPENSSH):
        return 0
    at, parts = len(OPENSSH), []
    for number in range(6):  # cipher, derivation, its options, number of keys, public, private
        if at + 4 > len(data):
            return 0
        size = int.from_bytes(data[at : at + 4], "big")
        at += 4
        if number == 3:
            if size != 1:
                return 0
            continue
        if at + size > len(data):
            return 0
        parts.append(data[at : at + size])
        at += size
    cipher, derivation, _, public, private = parts
    named = int.from_bytes(public[:4], "big")
    whole = cipher and derivation and 0 < named <= len(public) - 4 and len(private) >= 16
    return at if whole else 0


def _key(data: bytes) -> tuple[int, int]:
    """(kind, bytes) of the key at the start of ``data``; (0, 0) if there is none."""
    if size := der_key_size(data):
        return KINDS.index("key"), size
    if size := openssh_size(data):
        return KINDS.index("openssh"), size
    return 0, 0


def _decoded(digits: str) -> bytes:
    """The bytes of base64 digits in either alphabet, without an incomplete last group."""
    plain = digits.replace("-", "+").replace("_", "/")
    if len(plain) % 4 == 1:
        plain = plain[:-1]
    return base64.b64decode(plain + "=" * (-len(plain) % 4))


def base64_spans(text: str) -> Iterator[Span]:
    """Keys in base64 runs.  The lengths inside say where the key ends; what follows isn't part of it."""
    for m in BASE64_RUN.finditer(text):
        lines = list(re.finditer(f"{DIGITS}+", re.sub(r"\\[rn]", "  ", m[0])))
        kind, size = _key(_decoded("".join(line[0] for line in lines)))
        if not size:
            continue
        left = -(-size * 8 // 6)  # digits of the key
        padding = -left % 4
        for line in lines:
            if left <= len(line[0]):
                break
            left -= len(line[0])
        end = line.start() + left
        while padding and m[0][end : end + 1] == "=":
            end, padding = end + 1, padding - 1
        yield Span(m.start(), kind, m.start() + end)


def hex_spans(text: str) -> Iterator[Span]:
    """Keys in hex runs."""
    for m in HEX_RUN.finditer(text):
        kind, size = _key(binascii.unhexlify(m[0]))
        if size:
            yield Span(m.start(), kind, m.start() + 2 * size)


def token_spans(text: str) -> Iterator[Span]:
    """Signed tokens: a JSON header with an algorithm, a JSON object, a signature of fitting length."""
    for m in JWT.finditer(text):
        try:
            header, claims = (json.loads(_decoded(part)) for part in m.groups()[:2])
            signature = _decoded(m[3])
        except (ValueError, RecursionError):
            continue
        name = header.get("alg") if isinstance(header, dict) else None
        if not isinstance(name, str) or name.lower() == "none" or not isinstance(claims, dict):
            continue
        size = SIGNATURE_BYTES.get(name.upper())
        if len(signature) == size if size else len(signature) >= 32:
            yield Span(m.start(), KINDS.index("jwt"), m.end())


def confirmed_spans(text: str) -> list[Span]:
    """What the structure of decoded candidates confirms."""
    return [*base64_spans(text), *hex_spans(text), *token_spans(text)]


def listed(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[s.kind]}:{s.start}:{s.end}" for s in sorted(spans))


def find_secrets(df: DataFrame, text: str = "text") -> DataFrame:
    """Add ``n_assign``, ``n_access``, ``n_hex``, ``base_spans`` and ``spans`` to every row.

    Spans are ``kind:start:end`` in code points, the end exclusive, by start and then kind, comma
    joined; ``spans`` holds the base spans and those that decoding confirmed, which may overlap.
    Null and empty texts have none.  Every row is judged by itself and returned, whole texts of any
    length in one pass; columns named like the new ones are replaced; an empty table stays empty.
    """
    new = ["n_assign", "n_access", "n_hex", "base_spans", "spans"]
    df = df.drop(*(c for c in new if c != text))
    rest = [c for c in df.columns]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts: list[list[int]] = [[], [], []]
            base, every = [], []
            for value in batch.column(text):
                whole = value.as_py() or ""
                spans = base_spans(whole)
                for kind in range(3):
                    counts[kind].append(sum(s.kind == kind for s in spans))
                base.append(listed(spans))
                every.append(listed(spans + confirmed_spans(whole)))
            found = [*(pa.array(c, pa.int64()) for c in counts), pa.array(base), pa.array(every)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *found], names=[*rest, *new])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)
    return df.mapInArrow(
        scan, f"{fields}, n_assign long, n_access long, n_hex long, base_spans string, spans string"
    )
