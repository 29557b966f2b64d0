from __future__ import annotations

from collections import Counter, defaultdict

import corpus_pipeline
from tests.llm import brute
from weftline.llm import line_crf
from weftline.workspace import workspace


def test_stages_match_brute_force(spark):
    sf_dir = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    names, items = docs.columns, [tuple(r) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    stages = dict(corpus_pipeline.STAGES)
    before = {r.doc_id: r.text for r in docs.collect()}

    def run(name):
        nonlocal docs
        path = workspace(spark, "stage")
        stages[name](spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        assert name == "best-fit packing" or docs.columns == names
        return docs

    found = {r.doc_id: r.text for r in run("quality rules").collect()}
    assert all(before[k] == t for k, t in found.items())
    for key, text in before.items():
        n, _, _, _, repeated = brute.base_counts(text)
        labels = line_crf.line_labels([text])[0]
        lines = [x for x in text.split("\n") if brute.BLANKS.search(x)]
        chars = [sum(map(len, brute.BLANKS.findall(x))) for x in lines]
        share = sum(c for c, x in zip(chars, labels, strict=True) if x) / max(1, sum(chars))
        assert (key in found) == (n >= 50 and 2 * repeated <= n and share >= line_crf.LEAST_CONTENT)

    groups = {key: c for key, _, c in brute.similar(list(found.items()), 80, 5)}
    before, found = found, {r.doc_id: r.text for r in run("n-gram Jaccard join").collect()}
    assert found == {k: t for k, t in before.items() if groups[k] == k}

    want = {k: kept for k, _, _, _, kept in brute.without_repeats(list(found.items()))}
    before, found = found, {r.doc_id: r.text for r in run("suffix-array dedup").collect()}
    assert set(found) <= set(before)
    for key, text in found.items():
        assert len(text) <= len(before[key]) and want[key]
        again = before[key].encode()
        assert text.encode() == again or len(text.encode()) < len(again)

    dirty = {k for k, _, _, _, _, bad in brute.contaminated(list(found.items()), items) if bad}
    before, found = found, {r.doc_id: r.text for r in run("benchmark decontamination").collect()}
    assert found == {k: t for k, t in before.items() if k not in dirty}

    pieces = run("best-fit packing").collect()
    assert {p.doc_id for p in pieces} == set(found)
    ends = defaultdict(int)
    for p in sorted(pieces, key=lambda p: (p.sequence_id, p.offset)):
        assert p.offset == ends[p.sequence_id]
        ends[p.sequence_id] += p.length
    assert max(ends.values()) <= 4096
    assert Counter(p.doc_id for p in pieces if p.piece == 0) == Counter(list(found))


def test_clean_documents_pass_and_planted_ones_do_not(spark):
    import random

    rng = random.Random(9)

    def prose(n):
        return " ".join(rng.choice(("river", "stone", "lamp", "seed", "road")) + str(rng.randrange(10**6)) for _ in range(n)) + "."

    item, base, passage = prose(30), prose(200), prose(60)
    rows = [(i, prose(120)) for i in range(30)]
    rows += [(100, base), (101, base), (102, base + " one more")]
    rows += [(200, prose(20) + " " + item + " " + prose(90)), (300, "win*** cash### " * 60), (301, "short")]
    rows += [(400, prose(90) + " " + passage), (401, passage + " " + prose(90))]
    root = workspace(spark, "planted")
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame([(k, t, "en", "s", len(t)) for k, t in rows], schema).write.parquet(f"{root}/documents.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{root}/benchmark.parquet")
    docs = spark.read.parquet(f"{root}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        path = workspace(spark, "stage")
        stage(spark, docs, root).write.parquet(path)
        docs = spark.read.parquet(path)
    kept = {r.doc_id: r.text for r in docs.collect()}
    assert set(kept) == {*range(30), 100, 400, 401}
    assert all(kept[k] == t for k, t in rows if k in kept and k != 401)
    assert passage in kept[400] and passage not in kept[401]
    assert {r.doc_id for r in corpus_pipeline.run(spark, root).collect()} == set(kept)


def test_near_duplicates_of_one_id_go_only_when_linked(spark):
    import random

    rng = random.Random(4)

    def prose(n):
        return " ".join(f"w{rng.randrange(10**6)}" for _ in range(n))

    a, b, c, d = (prose(100) for _ in range(4))
    rows = [(5, a, "en"), (5, b, "en"), (5, b, "en"), (5, b, "de"), (5, b + " end", "en")]
    rows += [(3, "start " + a, "en"), (5, c, None), (9, c + " end", "en"), (None, d, "en"), (None, d, "en")]
    rows += [(7, "", "en"), (7, "", "en"), (7, None, "en"), (7, " ", "en"), (8, "", "en")]
    schema = "doc_id long, text string, lang string"
    found = corpus_pipeline.near_duplicate_stage(spark, spark.createDataFrame(rows, schema), "")
    assert found.columns == ["doc_id", "text", "lang"]
    left = Counter(tuple(r) for r in found.collect())
    of_b = [r for r in left if r[1] and r[1].startswith(b)]
    assert len(of_b) == 1 and left.pop(of_b[0]) == 1
    blank = [(7, "", "en"), (7, None, "en"), (7, " ", "en"), (8, "", "en")]
    assert left == Counter([rows[5], (5, c, None), rows[8], rows[9], *blank])
    again = spark.createDataFrame(rows[::-1], schema).repartition(5)
    assert of_b[0] in {tuple(r) for r in corpus_pipeline.near_duplicate_stage(spark, again, "").collect()}
