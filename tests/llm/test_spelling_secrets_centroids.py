from __future__ import annotations

import base64
import hashlib
import json
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from weftline.llm import centroids, secrets, spelling_trie

# spelling variants


def _near(a: str, b: str) -> bool:
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    p = 0
    while p < min(len(a), len(b)) and a[p] == b[p]:
        p += 1
    return a[p + (len(a) >= len(b)) :] == b[p + (len(b) >= len(a)) :]


def _variants(rows, least_letters=7, least_count=2, ratio=10, drop_every=31):
    counts = Counter()
    for key, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if key is None else key}:{run}".encode())
            if h % drop_every == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    words = {w: n for w, n in counts.items() if len(w) >= least_letters and n >= least_count}
    found = {}
    for word, n in words.items():
        near = [w for w in words if _near(word, w)]
        best = min(near, key=lambda w: (-words[w], w), default=None)
        form = best if best and words[best] >= ratio * n else None
        found[word] = (n, len(near), form, words[form] if form else None)
    out = Counter()
    for word, (n, n_near, form, form_n) in found.items():
        root = word
        while found[root][2]:
            root = found[root][2]
        out[(word, n, n_near, form, form_n, root)] += 1
    return out


COLUMNS = ("word", "n", "n_near", "form", "form_n", "root")


def test_variants_equal_those_of_all_pairs(spark, counted):
    rng = random.Random(5)
    words = [
        "".join(rng.choices("abé", k=rng.randint(5, 11))).replace("b", rng.choice("bB")) for _ in range(500)
    ]
    rows = [(i, " ".join(rng.choices(words, [1 + 40 * (j % 29 == 0) for j in range(500)], k=60))) for i in range(200)]
    rows += [(None, "aaaaaaa aaaaaaaa " * 3), (7, None), (8, ""), (9, "×÷ÀÿÀÿÀÿ ×÷ÀÿÀÿÀÿ"), (9, "×÷ÀÿÀÿÀÿ")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("word", F.lit(1)).withColumn("n", F.lit(2))
    for drop_every in (31, 3):
        found = spelling_trie.spelling_variants(df, drop_every=drop_every)
        assert counted(found, *COLUMNS) == _variants(rows, drop_every=drop_every)


def test_long_words_and_chains_of_forms(spark, counted):
    rng = random.Random(6)
    giant = "".join(rng.choices("abcdefgh", k=40_000))
    texts = [giant, giant, giant[:15_000] + giant[15_001:], "z" + giant, giant[:-1] + "q", "x" * 30_000, "x" * 29_999]
    texts += ["tableau"] * 300 + ["tablebu"] * 30 + ["tabcebu"] * 3 + ["tabcebux"] * 2
    rows = [(i, f"{t} {t}") for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    found = counted(spelling_trie.spelling_variants(df, drop_every=1 << 40), *COLUMNS)
    assert found == _variants(rows, drop_every=1 << 40)
    assert ("tabcebu", 6, 2, "tablebu", 60, "tableau") in found


def test_variants_of_odd_rows(odd_docs, odd_rows, no_docs, counted):
    assert counted(spelling_trie.spelling_variants(odd_docs), *COLUMNS) == _variants(odd_rows)
    assert spelling_trie.spelling_variants(no_docs).count() == 0
    with pytest.raises(ValueError):
        spelling_trie.spelling_variants(odd_docs, ratio=1)


def test_rows_made_of_lists_are_never_broadcast(spark, monkeypatch):
    """Spark takes them for as small as what they are made of, and would send them through the driver."""
    rng = random.Random(9)
    words = sorted({"".join(rng.choices("abcd", k=rng.randint(7, 9))) for _ in range(300)})
    rows = [(n, " ".join([word] * rng.choice((2, 30)))) for n, word in enumerate(words)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    plans = defaultdict(list)
    written = spelling_trie.materialize

    def seen(df, purpose):
        plans[purpose].append(df._jdf.queryExecution().executedPlan().toString())
        return written(df, purpose)

    monkeypatch.setattr(spelling_trie, "materialize", seen)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "100m")
    try:
        found = spelling_trie.spelling_variants(docs)
        plans["result"].append(found._jdf.queryExecution().executedPlan().toString())
        assert found.where("form IS NOT NULL").count() > 10
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    for name in ("trie-paths", "spelling-forms", "spelling-roots", "result"):
        assert not [p for p in plans[name] if "Broadcast" in p], name
    assert "SortMergeJoin" in plans["trie-paths"][0] and "Broadcast" not in plans["trie-states"][0]


def test_prefix_rows_start_at_the_middle():
    words = pa.array(["aaaaaaa" + w for w in ("b", "c", "dé")])
    for back in (False, True):
        node, depth, path, lo, hi = spelling_trie.prefix_rows(words, np.arange(3), back)
        of = {w: sorted(depth[path == 2 * w + back].tolist()) for w in range(3)}
        assert of == {0: [4, 5, 6, 7, 8], 1: [4, 5, 6, 7, 8], 2: list(range(5 if back else 4, 10))}
        assert ((lo != 0) != (hi != 0)).all()
        shared = node[(path == 0 + back) & (depth == 5)], node[(path == 2 + back) & (depth == 5)]
        assert (shared[0] == shared[1]).all() != back


# secrets


def _der(tag: int, *parts: bytes) -> bytes:
    body = b"".join(parts)
    size = len(body)
    head = bytes([size]) if size < 128 else bytes([0x80 | (n := (size.bit_length() + 7) // 8)]) + size.to_bytes(n, "big")
    return bytes([tag]) + head + body


def _keys(rng: random.Random) -> dict[str, bytes]:
    number = lambda n: _der(2, bytes([1, *rng.randbytes(n - 1)]))
    algorithm = _der(0x30, _der(6, b"\x2a\x86\x48"), _der(5))
    rsa = _der(0x30, _der(2, b"\0"), number(129), number(3), number(128), *(number(64) for _ in range(5)))
    curve = _der(0x30, _der(2, b"\1"), _der(4, rng.randbytes(32)), _der(0xA0, _der(6, b"\x2a\x86")))
    string = lambda b: len(b).to_bytes(4, "big") + b
    public = string(b"ssh-ed25519") + string(rng.randbytes(32))
    shell = b"openssh-key-v1\0" + string(b"none") + string(b"none") + string(b"")
    return {
        "rsa": rsa,
        "curve": curve,
        "wrapped": _der(0x30, _der(2, b"\0"), algorithm, _der(4, curve)),
        "encrypted": _der(0x30, algorithm, _der(4, rng.randbytes(64))),
        "openssh": shell + (1).to_bytes(4, "big") + string(public) + string(rng.randbytes(96)),
    }


def _token(header, claims, signature: bytes) -> str:
    parts = [json.dumps(p).encode() if not isinstance(p, bytes) else p for p in (header, claims)]
    return ".".join(base64.urlsafe_b64encode(p).decode().rstrip("=") for p in (*parts, signature))


def _spans(text: str) -> list[tuple[str, str]]:
    return [(secrets.KINDS[s.kind], text[s.start : s.end]) for s in sorted(secrets.confirmed_spans(text))]


def test_encoded_keys_are_found_whole_and_nothing_after_them():
    rng = random.Random(1)
    for name, data in _keys(rng).items():
        kind = "openssh" if name == "openssh" else "key"
        plain = base64.b64encode(data).decode()
        lines = "\n".join(plain[i : i + 64] for i in range(0, len(plain), 64))
        for body in (plain, lines, lines.replace("\n", "\r\n"), lines.replace("\n", "\\n")):
            wrap = "\\n" if "\\n" in body else "\n"
            for before, after in (("", ""), (f"-----BEGIN KEY-----{wrap}", f"{wrap}-----END"), ('k="', '" rest'), ("é ", "\nword")):
                assert _spans(before + body + after) == [(kind, body)], (name, before, after)
        assert _spans(f"x {data.hex()} y") == [(kind, data.hex())]
        assert _spans(data.hex().upper() + "00ff") == [(kind, data.hex().upper())]


def test_candidates_without_structure_are_left_alone():
    rng = random.Random(2)
    for data in _keys(rng).values():
        assert _spans(base64.b64encode(data[:-1]).decode()) == []
        at = data.index(b"\0\0\0\4") if data.startswith(b"openssh") else 1
        broken = data[:at] + bytes([data[at] ^ 0x7F]) + data[at + 1 :]
        assert _spans(base64.b64encode(broken).decode()) == []
    certificate = _der(0x30, _der(0x30, _der(2, b"\7")), _der(0x30, _der(6, b"\x2a")), _der(3, rng.randbytes(64)))
    random_digits = base64.b64encode(rng.randbytes(3000)).decode()
    for text in (base64.b64encode(certificate).decode(), random_digits, "MI" + "A" * 5000, "30" * 4000, "MIIE" * 30_000):
        assert _spans(text) == []


def test_signed_tokens_need_header_claims_and_signature():
    header, claims, signature = {"alg": "HS256", "typ": "JWT"}, {"sub": "1"}, bytes(range(32))
    token = _token(header, claims, signature)
    assert _spans(f"Bearer {token}, next. line") == [("jwt", token)]
    long = _token({"alg": "RS256"}, claims, bytes(256))
    assert _spans(f"a\n{long}\nb") == [("jwt", long)]
    for bad in (
        _token({"alg": "none"}, claims, signature),
        _token({"typ": "JWT"}, claims, signature),
        _token({"alg": 5}, claims, signature),
        _token([1], claims, signature),
        _token(header, b"no json", signature),
        _token(header, claims, signature[:-1]),
        "eyes.open.wide",
        "ey" + "A" * 100_000 + ".a.b",
        _token(b"[" * 100_000, claims, signature),
    ):
        assert _spans(bad) == []


def _base(text: str | None) -> list[tuple[int, int, int]]:
    """The base matches as the contract words them, too short ones dropped afterwards."""
    text = text or ""
    names = "(password|passwd|secret|token|api_?key)"
    assign = re.compile(names + r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text)
    found = [(m.start(), 0, m.end()) for m in assign.finditer(lowered) if len(m[2]) >= 6]
    found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    return found + [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]


def test_base_spans_follow_the_contract():
    rng = random.Random(3)
    bits = ["password", "PassWd", "toKen", "token", "secret", "api_key", "APIKEY", "apikey", '"', "'", " ", ":", "=", "AKIA"]
    bits += ["ABCD1234", "deadbeef", "0123456789abcdef", "Z", "\n", "é", "x.y-z", "ſecret"]
    for _ in range(3000):
        text = "".join(rng.choices(bits, k=rng.randint(0, 14)))
        assert sorted(secrets.base_spans(text)) == sorted(_base(text)), text


def test_secrets_of_odd_rows(spark, odd_docs, odd_rows, no_docs):
    found = secrets.find_secrets(odd_docs)
    assert Counter((r.doc_id, r.text) for r in found.collect()) == Counter(odd_rows)
    assert secrets.find_secrets(no_docs).count() == 0
    token = _token({"alg": "HS256"}, {}, bytes(32))
    text = f"é token={token} AKIA{'A' * 16} {'ab' * 12}"
    one = spark.createDataFrame([(None, text, "x"), (1, None, "y")], "doc_id long, text string, spans string")
    a, b = sorted(secrets.find_secrets(one).collect(), key=lambda r: r.text is None)
    assert (a.n_assign, a.n_access, a.n_hex) == (1, 1, 1) and (b.n_assign, b.spans) == (0, "")
    at = 8 + len(token)
    access, digits = f"access:{at + 1}:{at + 21}", f"hex:{at + 22}:{at + 46}"
    assert a.base_spans == f"assign:2:{at},{access},{digits}"
    assert a.spans == f"assign:2:{at},jwt:8:{at},{access},{digits}"


# centroid clustering


def _clusters(rows, count=16, rounds=3, size=64, scale=64):
    kept = []
    for key, vector in rows:
        if vector is not None and len(vector) == size and all(x is not None and np.isfinite(x) for x in vector):
            kept.append((key, [int(np.floor(scale * x)) for x in vector]))
    named = sorted((hashlib.sha256(f"1:{'' if k is None else k}".encode()).hexdigest(), v) for k, v in kept)
    centres = [v for _, v in named[:count]]

    def place(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c, strict=True)), i) for i, c in enumerate(centres))

    for _ in range(rounds):
        members = defaultdict(list)
        for _, v in kept:
            members[place(v)[1]].append(v)
        for i, inside in members.items():
            centres[i] = [sum(x) // len(inside) for x in zip(*inside, strict=True)]
    placed = [(k, *place(v)) for k, v in kept]
    inertia = Counter()
    for _, distance, cluster in placed:
        inertia[cluster] += distance
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centres]
    return Counter((k, c, d, inertia[c], sum(inertia.values()), digest[c]) for k, d, c in placed)


NUMBERS = ("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def _vectors(rng, n):
    middles = [[rng.gauss(0, 1) for _ in range(64)] for _ in range(9)]
    rows = []
    for i in range(n):
        middle = middles[0 if i % 3 == 0 else rng.randrange(9)]
        spread = rng.choice((0, 0.05, 0.4))
        rows.append((i, [m + rng.gauss(0, spread) for m in middle]))
    return rows


def test_clusters_equal_those_of_the_full_search(spark, counted):
    rng = random.Random(8)
    rows = _vectors(rng, 400)
    rows += [rows[5]] * 40 + [(None, rows[7][1]), (None, rows[7][1])]
    rows += [(900, None), (901, []), (902, [1.0] * 63), (903, [None] + [1.0] * 63), (904, [float("nan")] * 64)]
    rows += [(905, [float("inf")] + [0.0] * 63), (906, [-0.0] * 64), (907, [1000.5] * 64)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(5)
    df = df.withColumn("cluster", F.lit("x")).withColumn("distance", F.lit(None))
    assert counted(centroids.cluster_vectors(df), *NUMBERS) == _clusters(rows)


def test_clusters_of_few_rows_ties_and_none(spark, counted):
    schema = "vec_id long, embedding array<float>"
    few = [(1, [0.0] * 64), (1, [0.0] * 64), (2, [0.5] * 64), (3, [0.25] * 64)]
    df = spark.createDataFrame(few, schema)
    assert counted(centroids.cluster_vectors(df), *NUMBERS) == _clusters(few)
    assert centroids.cluster_vectors(df.limit(0)).count() == 0
    with pytest.raises(Exception, match="64 bits"):
        centroids.cluster_vectors(spark.createDataFrame([(1, [1e30] * 64)], schema))


def test_search_is_exact_and_rejects_most_centroids():
    rng = np.random.default_rng(4)
    centres = centroids.Centroids(rng.integers(-200, 200, (64, 64)) + rng.integers(-300, 300, (64, 1)))
    vectors = centres.vectors[rng.integers(0, 64, 3000)] + rng.integers(-9, 9, (3000, 64))
    vectors = np.concatenate([vectors, rng.integers(-500, 500, (500, 64))])
    cluster, distance, summed = centroids.nearest(vectors, centres)
    full = ((vectors[:, None] - centres.vectors[None]) ** 2).sum(axis=2)
    assert (distance == full.min(axis=1)).all() and (cluster == full.argmin(axis=1)).all()
    assert summed < full.size / 3
