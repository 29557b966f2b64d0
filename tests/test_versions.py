from __future__ import annotations

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from weftline.operators import versions
from weftline.sources.files import rows_to_frame

SCHEMA = "id INT, name STRING, age INT, role STRING"
STAFF = [
    (1, "Ana", 28, "Analyst"),
    (2, "Bruno", 35, "Engineer"),
    (3, "Carla", 41, "Architect"),
    (4, "Davi", 30, "Analyst"),
    (5, "Eva", 52, "Manager"),
    (6, "Fabio", 23, "Intern"),
    (7, "Gil", 38, "Engineer"),
    (8, "Hugo", 29, "Analyst"),
    (9, "Iris", 44, "Manager"),
    (10, "Joao", None, "Engineer"),
]
NEW = [(11, "Kim", 27, "Analyst"), (3, "Nobody", 1, "None")]
UPSERT = [(3, "Carla", 42, "Director"), (12, "Lia", 24, "Intern")]


@pytest.fixture
def chain(spark):
    v0 = spark.createDataFrame(STAFF, SCHEMA)
    v1 = versions.update_where(
        v0, F.col("name") == "Gil", {"age": F.lit(39), "role": F.lit("Lead")}
    )
    v2 = versions.delete_where(v1, F.col("age") <= 30)
    v3 = versions.merge_insert_only(v2, spark.createDataFrame(NEW, SCHEMA), "id")
    v4 = versions.merge_upsert(v3, spark.createDataFrame(UPSERT, SCHEMA), "id", ["age", "role"])
    return [v0, v1, v2, v3, v4]


@pytest.fixture
def history(chain):
    parts = [versions.with_version(v, i) for i, v in enumerate(chain)]
    united = parts[0]
    for part in parts[1:]:
        united = united.unionByName(part)
    return united


def _by_id(df):
    return {r.id: tuple(r)[1:] for r in df.collect()}


def test_each_version(chain):
    v0, v1, v2, v3, v4 = map(_by_id, chain)
    assert v1[7] == ("Gil", 39, "Lead") and v1[2] == v0[2]
    assert sorted(v2) == [2, 3, 5, 7, 9, 10]  # an unknown age is kept
    assert sorted(v3) == [2, 3, 5, 7, 9, 10, 11] and v3[3] == v0[3]
    assert v4[3] == ("Carla", 42, "Director") and v4[12] == ("Lia", 24, "Intern") and len(v4) == 8


def test_null_conditions_leave_rows_alone(spark, rows):
    df = spark.createDataFrame([(1, 5), (2, None), (3, 50)], "id INT, age INT")
    updated = versions.update_where(df, F.col("age") > 10, {"age": F.lit(0)})
    assert rows(updated) == [(1, 5), (2, None), (3, 0)]
    assert rows(versions.delete_where(df, F.col("age") > 10)) == [(1, 5), (2, None)]


def test_upsert_with_two_source_rows_for_one_target_row_fails(spark):
    target = spark.createDataFrame([(1, "a"), (2, "b")], "id INT, v STRING")
    source = spark.createDataFrame([(1, "x"), (1, "y")], "id INT, v STRING")
    merged = versions.merge_upsert(target, source, "id", ["v"])
    for action in (lambda: merged.count(), lambda: merged.collect()):
        with pytest.raises(Exception, match="several source rows"):
            action()


@pytest.mark.parametrize("rows_per_part", [1, 1000])
def test_upsert_inserts_repeated_and_null_source_keys_that_match_nothing(spark, rows, rows_per_part):
    target = spark.createDataFrame([(1, "a"), (1, "b"), (None, "c")], "id INT, v STRING")
    source = spark.createDataFrame([(1, "z"), (5, "x"), (5, "y"), (None, "n")], "id INT, v STRING")
    merged = versions.merge_upsert(target, source, "id", ["v"], rows_per_part=rows_per_part)
    assert rows(merged) == [(None, "c"), (None, "n"), (1, "z"), (1, "z"), (5, "x"), (5, "y")]


def _merged(target, source, update):
    """The merge row by row; None where it is ambiguous."""
    found = [(k, v, w) for k, v, w in target]
    for i, (k, v, w) in enumerate(target):
        matches = [s for s in source if k is not None and s[0] == k]
        if update and len(matches) > 1:
            return None
        if update and matches:
            found[i] = (k, matches[0][1], w)
    keys = {k for k, _, _ in target if k is not None}
    return Counter(found + [s for s in source if s[0] not in keys])


@pytest.mark.parametrize("rows_per_part", [2, 5, 1000])
def test_merges_equal_the_merge_row_by_row(spark, rows_per_part):
    rng = random.Random(rows_per_part)
    schema = "k INT, v STRING, w INT"
    for clash in (False, True):
        # 1 is hot in the target, 2 in the source, NULL in both; 1 is matched once
        target = [(1, "a", i % 2) for i in range(30)] + [(None, "n", 0)] * 20 + [(i, "t", i) for i in range(10, 30)]
        source = [(2, "s", i % 2) for i in range(30)] + [(None, "m", 0)] * 20 + [(i, "u", -i) for i in range(20, 40)]
        source += [(1, "changed", 9)] + [(2 if clash else 3, "x", 1)]
        target += [(2, "hit", 0)] * clash
        rng.shuffle(target), rng.shuffle(source)
        a = spark.createDataFrame(target, schema).repartition(3)
        b = spark.createDataFrame(source, schema).repartition(3)
        inserted = versions.merge_insert_only(a, b, "k", rows_per_part)
        assert Counter(map(tuple, inserted.collect())) == _merged(target, source, False)
        upserted = versions.merge_upsert(a, b, "k", ["v"], rows_per_part)
        expected = _merged(target, source, True)
        if expected is None:
            with pytest.raises(Exception, match="several source rows"):
                upserted.count()
        else:
            assert Counter(map(tuple, upserted.collect())) == expected


def test_merges_read_each_side_once_in_one_shuffle(spark, plan, tmp_path):
    a, b = str(tmp_path / "a"), str(tmp_path / "b")
    spark.range(500).selectExpr("id AS k", "'x' AS v").write.parquet(a)
    spark.range(400, 600).selectExpr("id AS k", "'y' AS v").write.parquet(b)
    target, source = spark.read.parquet(a), spark.read.parquet(b)
    for merged in (versions.merge_insert_only(target, source, "k"), versions.merge_upsert(target, source, "k", ["v"])):
        text = plan(merged)
        assert text.count("Scan parquet") // 2 == 2 and "Join" not in text
        tree = text[: text.index("\n\n(")]
        assert tree.count("Exchange") == 1 and "SortAggregate" not in tree
        assert merged.count() == 600


def test_history_tells_apart_what_fingerprints_must(spark, plan):
    old = [(1, "a", None, [1, None]), (2, None, "b", None), (3, "x", "y", []), (3, "x", "y", []), (4, "p", "q", [5])]
    new = [(1, None, "a", [1, None]), (2, None, "b", None), (3, "x", "y", []), (4, "p", "q", [5]), (4, "p", "r", [5])]
    schema = "id INT, u STRING, v STRING, w ARRAY<INT>, version INT"
    steps = [old, new, new[::-1], [(1, None, "a", [None, 1])]]
    history = spark.createDataFrame([(*r, i) for i, rows in enumerate(steps) for r in rows], schema)
    commits = rows_to_frame(spark, [(i, "WRITE") for i in range(4)], "version INT, operation STRING")
    log = versions.version_history(history, commits, "id")
    assert "SortAggregate" not in plan(log)
    counts = {r.version: (r.rows, r.inserted, r.updated, r.deleted) for r in log.collect()}
    assert counts == {0: (5, 4, 0, 0), 1: (5, 0, 3, 0), 2: (5, 0, 0, 0), 3: (1, 0, 1, 3)}


def test_diff_lists_pairs_seen_once(history, rows):
    both = history.filter(F.col("version").isin(0, 4))
    ages = versions.version_diff(both, ["id"], "age").filter("id IN (3, 7)")
    assert rows(ages) == [(3, 41, [0]), (3, 42, [4]), (7, 38, [0]), (7, 39, [4])]


def test_read_restore_and_average(history, chain):
    assert _by_id(versions.read_version(history, 2)) == _by_id(chain[2])
    restored = versions.restore_version(history, 2)
    assert _by_id(versions.read_version(restored, 5)) == _by_id(chain[2])
    assert versions.read_version(restored, 4).count() == 8
    with pytest.raises(ValueError, match="no version 9"):
        versions.restore_version(history, 9)
    averages = {r.version: r.a for r in versions.avg_by_version(history, "age", "a").collect()}
    assert averages[0] == pytest.approx(320 / 9)


def test_history_counts_changes_per_commit(spark, history):
    operations = ["WRITE", "UPDATE", "DELETE", "MERGE", "MERGE", "WRITE", "TRUNCATE"]
    commits = rows_to_frame(spark, list(enumerate(operations)), "version INT, operation STRING")
    restored = versions.restore_version(history, 2)
    log = {r.version: tuple(r)[1:] for r in versions.version_history(restored, commits, "id").collect()}
    assert log == {
        0: ("WRITE", 10, 10, 0, 0),
        1: ("UPDATE", 10, 0, 1, 0),
        2: ("DELETE", 6, 0, 0, 4),
        3: ("MERGE", 7, 1, 0, 0),
        4: ("MERGE", 8, 1, 1, 0),
        5: ("WRITE", 6, 0, 1, 2),
        6: ("TRUNCATE", 0, 0, 0, 6),
    }


def test_one_version_reads_one_folder(spark, history, plan, tmp_path):
    history.write.partitionBy("version").parquet(str(tmp_path / "h"))
    stored = versions.read_version(spark.read.parquet(str(tmp_path / "h")), 2)
    assert "PartitionFilters: [isnotnull(version" in plan(stored)
    assert stored.count() == 6


def test_versioned_table_logs_what_it_writes(spark, tmp_path, rows):
    made = versions.VersionedTable(spark, str(tmp_path / "t"))
    assert made.newest() == -1 and made.commits().count() == 0
    made.commit(spark.range(3), "WRITE")
    made.commit(versions.delete_where(made.read(0), F.col("id") == 1), "DELETE")
    assert made.restore(0) == 2
    assert rows(made.commits()) == [(0, "WRITE"), (1, "DELETE"), (2, "RESTORE")]
    assert rows(made.read(1)) == [(0,), (2,)]
    assert made.history().groupBy("version").count().orderBy("version").collect()[2]["count"] == 3
    with pytest.raises(ValueError, match="no version 3"):
        made.read(3)


def test_an_unlogged_snapshot_is_no_version(spark, tmp_path):
    made = versions.VersionedTable(spark, str(tmp_path / "t"))
    made.commit(spark.range(3), "WRITE")
    spark.range(9).write.parquet(str(tmp_path / "t" / "data" / "version=1"))  # a writer that died here
    assert made.history().count() == 3
    assert made.commit(spark.range(4), "WRITE") == 1 and made.history().count() == 7
