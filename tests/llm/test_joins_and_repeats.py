from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm import brute
from weftline.llm import components, fm_index, prefix_join, repeats, run_index

REPEAT_COLUMNS = ("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def test_components_of_a_long_chain_and_a_star(spark):
    links = [(i, i + 1) for i in range(100, 160)] + [(5, i) for i in range(6, 30)] + [(3, 3)]
    found = dict(components.components(spark.createDataFrame(links, "a long, b long")).collect())
    assert set(found) == {*range(100, 161), *range(5, 30)}
    assert all(c == (100 if n >= 100 else 5) for n, c in found.items())


@pytest.mark.parametrize(("percent", "width"), [(90, 3), (80, 5)])
def test_similar_components_match_brute_force(odd_docs, odd_rows, counted, percent, width):
    found = prefix_join.similar_components(odd_docs, percent=percent, width=width)
    assert found.columns == ["doc_id", "n_shingles", "component_id"]
    assert counted(found, *found.columns) == brute.similar(odd_rows, percent, width)


def test_similar_components_of_nothing(no_docs):
    assert prefix_join.similar_components(no_docs).count() == 0


def test_near_copies_that_link_only_through_others(spark, counted):
    rng = random.Random(5)
    words = [f"w{i}" for i in range(200)]
    rows = []
    for key in range(60):  # each differs from the one before in one word: a chain
        words = list(words)
        words[rng.randrange(200)] = f"n{key}"
        rows.append((key, " ".join(words)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert counted(prefix_join.similar_components(docs), "doc_id", "n_shingles", "component_id") == brute.similar(rows)


@pytest.mark.parametrize(("percent", "width", "cell"), [(90, 3, 5000), (80, 5, 2), (60, 1, 2)])
def test_components_of_copies_that_share_passages(spark, counted, monkeypatch, percent, width, cell):
    """Copies near and far of a few texts, all with one passage: many components meet in a shingle."""
    rng = random.Random(percent)
    monkeypatch.setattr(prefix_join, "TOKEN_ROWS", cell)
    shared, rows = [f"s{i}" for i in range(60)], []
    for family in range(6):
        base = [f"f{family}x{i}" for i in range((40, 90, 200, 230, 270, 600)[family])] + shared
        rows += [(len(rows) + i, " ".join(base)) for i in range(family)]
        for _ in range(25):
            words = list(base)
            for _ in range(rng.randint(1, 9)):
                words[rng.randrange(len(words))] = f"n{rng.randrange(40)}"
            rows.append((len(rows), " ".join(words[rng.randint(0, 9) :])))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = prefix_join.similar_components(docs, percent=percent, width=width)
    assert counted(found, *found.columns) == brute.similar(rows, percent, width)


def test_rows_link_by_their_sets_not_by_their_keys(spark, counted):
    rng = random.Random(8)

    def prose(n):
        return " ".join(f"w{rng.randrange(10**6)}" for _ in range(n))

    one, two, bridge = prose(120), prose(120), prose(120).split()
    ends = [" ".join(w[:6] + bridge[6:]) for w in (["x"] * 6, ["y"] * 6)]  # similar to the bridge only
    rows = [(5, one), (5, two), (7, one + " end"), (8, two + " end"), (5, prose(50))]
    rows += [(20, ends[0]), (None, " ".join(bridge)), (21, ends[1]), (None, prose(60)), (None, prose(60) + " " + one)]
    for key in range(30, 36):  # one key with many texts, each with a near copy
        text = prose(90)
        rows += [(5, text), (key, text + " more")]
    assert brute.similar(rows)[(21, brute.similar([(21, ends[1])]).most_common(1)[0][0][1], 20)] == 1
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert counted(prefix_join.similar_components(docs), "doc_id", "n_shingles", "component_id") == brute.similar(rows)


def test_bitmaps_never_exclude_a_link():
    rng = np.random.default_rng(1)
    a = np.unique(rng.integers(0, 2**63, 300).astype(np.uint64))
    b = np.unique(np.r_[a[5:], rng.integers(0, 2**63, 6).astype(np.uint64)])
    bits = sum((x ^ y).bit_count() for x, y in zip(*((v & (2**64 - 1) for v in prefix_join.bitmap(s)) for s in (a, b))))
    assert bits <= len(np.setxor1d(a, b))
    for n, m in ((300, 310), (500, 520), (5000, 4000), (80000, 70000)):
        a = np.unique(rng.integers(0, 2**63, n).astype(np.uint64))
        b = np.unique(np.r_[a[: m - m // 20], rng.integers(0, 2**63, m // 20).astype(np.uint64)])
        apart = prefix_join.bits_apart(prefix_join.wide_bitmap(a), prefix_join.wide_bitmap(b))
        assert 0 < apart <= len(np.setxor1d(a, b))
        assert apart == prefix_join.bits_apart(prefix_join.wide_bitmap(b), prefix_join.wide_bitmap(a))


def test_run_index_statistics_and_counts():
    rng = random.Random(2)
    for _ in range(30):
        strings = [bytes(rng.choices(b"ab", k=rng.randint(0, 12))) for _ in range(rng.randint(1, 12))]
        index = run_index.RunIndex(strings)
        for pattern in (b"a", b"ab", b"bb", b"aba", b"abab", b"c"):
            want = sum(s.startswith(pattern, i) for s in strings for i in range(len(s)))
            assert index.count(pattern) == want
        owners = np.array([rng.randint(0, 5) for _ in strings])
        least = index.smallest_owner(owners, 3)
        for number, string in enumerate(strings):
            for at in range(len(string)):
                window = string[at : at + 3]
                sharing = [o for s, o in zip(strings, owners, strict=True) if window in s]
                want = min(sharing) if len(window) == 3 else owners[number]
                assert least[index.start[number] + at] == want


def test_runs_do_not_grow_with_copies():
    one = bytes(random.Random(1).choices(b"abcdefgh", k=400))
    single, many = run_index.RunIndex([one]), run_index.RunIndex([one] * 50)
    assert len(many.run_row) < 3 * len(single.run_row)


@pytest.mark.parametrize("hot", [500, 3])
def test_repeats_match_brute_force(odd_docs, odd_rows, counted, monkeypatch, hot):
    monkeypatch.setattr(repeats, "HOT_DOCUMENTS", hot)
    found = repeats.remove_repeats(odd_docs)
    assert counted(found, *REPEAT_COLUMNS) == brute.without_repeats(odd_rows)
    assert found.columns[: len(odd_docs.columns) - 1] == [c for c in odd_docs.columns if c != "n_bytes"]
    texts = {r.doc_id: r.text for r in found.where("doc_id IN (1, 2, 7)").collect()}
    assert texts[1] is None and texts[2] == "" and texts[7] == dict(odd_rows)[7]


def test_repeats_of_nothing(no_docs):
    assert repeats.remove_repeats(no_docs).count() == 0


@pytest.mark.parametrize("hot", [500, 3])
def test_repeats_around_a_common_passage_and_among_near_copies(spark, counted, monkeypatch, hot):
    monkeypatch.setattr(repeats, "HOT_DOCUMENTS", hot)
    rng = random.Random(6)

    def prose(n):
        return " ".join(f"w{rng.randrange(10**5)}" for _ in range(n))

    passage, base = prose(25), prose(60).split()
    rows = [(key, f"{prose(10)} {passage} {prose(10)}") for key in range(40)]
    for key in range(40, 80):  # near copies, each with two words of its own
        words = list(base)
        for at in rng.sample(range(60), 2):
            words[at] = f"n{key}"
        rows.append((key, " ".join(words)))
    rows += [(key, "ab" * rng.randrange(20, 200)) for key in range(80, 100)]  # one gram, then another, and so on
    rows += [(40, rows[50][1] + passage), (None, passage)]
    rng.shuffle(rows)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert counted(repeats.remove_repeats(docs), *REPEAT_COLUMNS) == brute.without_repeats(rows)


def test_two_grams_depend_on_the_window_alone():
    rng = random.Random(3)
    window = bytes(rng.choices(b"ab c", k=50))
    found = set()
    for _ in range(5):
        before, after = (bytes(rng.choices(b"xyz", k=rng.randrange(30))) for _ in range(2))
        data = np.frombuffer(before + window + after, np.uint8)
        at = np.array([len(before)])
        grams = repeats._grams(data)[len(before) : len(before) + 35]
        least, second = repeats.two_grams(data, at, 50)
        found.add((int(least[0]), int(second[0])))
        assert [least[0], second[0]] == np.unique(grams)[:2].tolist()
    assert len(found) == 1
    same = np.frombuffer(b"a" * 60, np.uint8)
    least, second = repeats.two_grams(same, np.array([0]), 50)
    assert least[0] == repeats._grams(same)[0] and second[0] == np.iinfo(np.uint64).max


def test_merged_spans_of_several_texts():
    columns = ([1, 1, 1, 2, 1], [5, 5, 5, 5, 6], [0, 10, 50, 10, 20], [20, 30, 60, 20, 25])
    found = repeats._merged(*(np.array(c, np.int64) for c in columns))
    assert found.tolist() == [(1, 5, 0, 30), (1, 5, 50, 60), (1, 6, 20, 25), (2, 5, 10, 20)]
    assert not len(repeats._merged(*(np.zeros(0, np.int64) for _ in range(4))))


def test_merge_joins_touching_spans():
    start, end = repeats.merge(np.array([10, 0, 5, 30]), np.array([20, 5, 12, 31]))
    assert (start.tolist(), end.tolist()) == ([0, 30], [20, 31])


def test_fm_index_finds_all_occurrences():
    rng = random.Random(4)
    for _ in range(40):
        text = np.array([rng.randint(0, 3) for _ in range(rng.randint(1, 80))])
        index = fm_index.FMIndex(text, 4, sampled=4)
        patterns = np.array([[1, 2, 0], [3, 0, 0], [1, 1, 2], [2, 3, 1]])
        lengths = np.array([2, 1, 3, 3])
        low, high = index.search(patterns, lengths)
        for p, n, a, b in zip(patterns, lengths, low, high, strict=True):
            want = [i for i in range(len(text) - n + 1) if (text[i : i + n] == p[:n]).all()]
            assert sorted(index.locate(np.arange(a, b)).tolist()) == want


ITEMS = [(1, None), (2, "..."), (3, "Lamp"), (4, "old MAP north"), (5, "old map north")]


@pytest.mark.parametrize("block", [200_000, 40])
def test_contamination_matches_brute_force(spark, odd_docs, odd_rows, counted, monkeypatch, block):
    monkeypatch.setattr(fm_index, "PHRASES", block)
    items = [*ITEMS, (6, odd_rows[-1][1]), (7, odd_rows[10][1])]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    found = fm_index.contamination(odd_docs, benchmark)
    digest = F.sha2(F.concat_ws(",", "hit_items"), 256)
    columns = ["doc_id", "n_words", "n_hit", F.size("hit_items"), digest, "contaminated"]
    assert counted(found, *columns) == brute.contaminated(odd_rows, items)
    for row in found.where("n_hit > 0 AND doc_id IS NOT NULL").limit(5).collect():
        left = fm_index.cut_spans(row.text.encode(), [tuple(s) for s in row.hit_spans]).decode()
        assert len(brute.LETTERS.findall(brute.lower(left))) == row.n_words - row.n_hit


def test_contamination_without_benchmark_or_documents(spark, odd_docs, no_docs):
    nothing = spark.createDataFrame([], "item_id long, text string")
    assert fm_index.contamination(odd_docs, nothing).where("n_hit > 0").count() == 0
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert fm_index.contamination(no_docs, items).count() == 0


def test_near_copies_are_compared_in_proportion_to_their_number(spark, counted, monkeypatch):
    rng = random.Random(11)
    words = [f"w{i}" for i in range(120)]
    rows = []
    for key in range(400):  # each has its own few words changed: most pairs link, few with any one of them
        copy = list(words)
        for _ in range(rng.randrange(1, 4)):
            copy[rng.randrange(120)] = f"n{key}"
        rows.append((key, " ".join(copy)))
    compared, links = [], prefix_join._links

    def counted_links(pairs, *rest):
        compared.append(pairs.count())
        return links(pairs, *rest)

    monkeypatch.setattr(prefix_join, "_links", counted_links)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = prefix_join.similar_components(docs, percent=80, width=5)
    assert counted(found, *found.columns) == brute.similar(rows, 80, 5)
    assert sum(compared) < 8 * len(rows)


def test_postings_stay_where_sizes_and_places_let_them_link():
    rng = np.random.default_rng(7)
    for percent in (60, 80, 90):
        rows = [(t, n, rng.integers(0, n // 4)) for t in range(40) for n in rng.integers(20, 60, rng.integers(1, 30))]
        token, n, place = (np.array(c, np.int64) for c in zip(*sorted(rows), strict=True))
        near = (token[:, None] == token) & ~np.eye(len(token), dtype=bool)
        both, size = np.minimum.outer(n - place, n - place), np.add.outer(n, n)
        small, large = np.minimum.outer(n, n), np.maximum.outer(n, n)
        near &= (100 * small >= percent * large) & ((100 + percent) * both >= percent * size)
        found = prefix_join.meeting(token, n, place, percent)
        assert found[near.any(axis=1)].all()
        few = np.bincount(token)[token] <= prefix_join.NEIGHBOURS
        assert (found == near.any(axis=1))[few].all() and not found.all()


def test_shingles_of_sets_too_different_in_size_are_dropped(spark):
    short, long = "a b c d e f".split(), [f"w{i}" for i in range(200)]
    docs = spark.createDataFrame([(" ".join(short),), (" ".join(short + long),)], "text string")
    rarity = spark.sparkContext.broadcast(np.zeros(1 << prefix_join.COUNTER_BITS, np.uint8))
    assert prefix_join._shared_prefixes(docs, rarity, 3, 1, 4).count()
    assert not prefix_join._shared_prefixes(docs, rarity, 3, 90, 4).count()


def test_only_texts_whose_tag_passes_are_read(spark, monkeypatch):
    rows = spark.createDataFrame([(i, f"a b c d e{i}") for i in range(50)], "tag long, text string")
    rows = rows.withColumn("tag", F.xxhash64("text"))
    wanted = spark.sparkContext.broadcast(prefix_join._filter(rows.where("text LIKE '%e7'")))
    read = prefix_join._read_sets(rows, wanted, 3).collect()
    want = prefix_join.shingle_sets(np.frombuffer(b"a b c d e7", np.uint8), np.array([0, 10]), 3)[0]
    assert [(r.high, r.low) for r in read] == [prefix_join.set_hash(want)]


def test_maps_reach_the_driver_packed(spark, monkeypatch):
    """Maps of a fixed size come to the driver's JVM as rows; of few texts they are nearly empty."""
    words = [f"w{n}" for n in range(60)]
    rows = [(n, " ".join(words[n % 4 : n % 4 + 50])) for n in range(12)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    sizes = []

    def counted(rows):
        for row in rows:
            parts = [x for value in row for x in (value if isinstance(value, list) else [value])]
            sizes.append(sum(len(x) for x in parts if isinstance(x, (bytes, bytearray))))
            yield row

    kind = type(docs)
    collect, iterate = kind.collect, kind.toLocalIterator
    monkeypatch.setattr(kind, "collect", lambda self: list(counted(collect(self))))
    monkeypatch.setattr(kind, "toLocalIterator", lambda self, *args: counted(iterate(self, *args)))
    components = prefix_join.similar_components(docs)
    spans = repeats.repeated_spans(docs)
    monkeypatch.undo()
    assert components.count() == 12 and spans.count() == 11
    assert 0 < sum(sizes) < 1 << 20  # 16 MB of counters, 4 MB for each filter, 16 MB for each bitmap of grams


def test_an_index_is_made_only_of_windows_that_stand_twice(monkeypatch):
    rng = random.Random(12)

    def noise(n):
        return bytes(rng.choices(b"abcdefgh", k=n))

    # texts with one common run of 30 bytes, which gives shared grams and no shared window, and a few with 90
    short, long = noise(30), noise(90)
    texts = [noise(70) + short + noise(70) for _ in range(200)] + [noise(70) + long + noise(70) for _ in range(3)]
    rows, data = [], []
    for owner, text in enumerate(texts):
        whole = np.frombuffer(text, np.uint8)
        _, start, windows, _ = repeats.segments(whole, np.array([0, len(text)]), 50)
        part = np.zeros(len(start), repeats.SEGMENT)
        part["owner"], part["tag"], part["start"], part["windows"] = owner, owner, start, windows
        rows.append(part)
        data += [whole[a : a + n + 49] for a, n in zip(start, windows, strict=True)]
    rows, sent = np.concatenate(rows), np.concatenate(data)
    indexed = []

    class Counted(run_index.RunIndex):
        def __init__(self, strings):
            indexed.extend(map(len, strings))
            super().__init__(strings)

    monkeypatch.setattr(repeats, "RunIndex", Counted)
    spans = repeats._merged(*repeats._index_bucket(rows, sent, 50))
    # beside the 90 bytes may stand equal ones by chance
    assert [s["owner"] for s in spans] == [201, 202]
    assert all(s["start"] <= 70 and 160 <= s["end"] <= 170 for s in spans)
    assert sum(indexed) < 20 * 90 < 0.05 * len(sent)
