from __future__ import annotations

import random

import pytest

WORDS = "the of and river bread stone lamp tide Ärger été niño 中文 seed old map dough, north. south;".split()

SCHEMA = "doc_id long, text string, lang string, n_bytes string, score string, kept string, shard string"


def _prose(rng: random.Random, n: int) -> str:
    return " ".join(rng.choice(WORDS) + rng.choice(("", "", "er", "ing", str(rng.randint(0, 99)))) for _ in range(n))


@pytest.fixture(scope="session")
def odd_rows():
    """(key, text): null keys and texts, empty and blank texts, one very long, ties, copies, near
    copies, shared passages, periodic text."""
    rng = random.Random(3)
    passage = _prose(rng, 40)
    base = _prose(rng, 120)
    rows = [
        (1, None), (2, ""), (3, " \t\n "), (None, _prose(rng, 60)), (None, None), (4, "one"), (5, "One"), (6, "one two"),
        (7, base), (8, base), (8, base), (8, base), (9, base + " end"), (10, "start " + base),
        (11, _prose(rng, 70)), (11, _prose(rng, 70)), (12, "la " * 300), (13, "la " * 290), (14, "ab" * 30), (15, "ab" * 60),
        (16, _prose(rng, 30000)), (17, "é" * 24 + "x"), (18, "é" * 25 + "x"), (19, "y" + "é" * 25), (30, base), (29, base),
    ]
    for key in range(40, 80):
        words = base.split()
        words[rng.randrange(len(words))] = f"w{key}"
        rows.append((key, " ".join(words)))
    for key in range(100, 140):
        rows.append((key, f"{_prose(rng, rng.randint(0, 80))}\n{passage} {_prose(rng, 20)}"))
    return rows


@pytest.fixture(scope="session")
def odd_docs(spark, odd_rows):
    """The odd rows with columns whose names the operators use themselves."""
    return spark.createDataFrame([(k, t, "xx", "a", "b", "c", "d") for k, t in odd_rows], SCHEMA)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture
def counted():
    from collections import Counter

    return lambda df, *names: Counter(tuple(r) for r in df.select(*names).collect())
