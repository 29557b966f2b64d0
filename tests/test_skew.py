from __future__ import annotations

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from weftline.operators import joins, skew


def _side(spark, rows, key, value, kind="BIGINT"):
    return spark.createDataFrame(rows, f"{key} {kind}, {value} INT")


def test_sketch_finds_planted_keys_and_nulls(spark, plan):
    rng = random.Random(1)
    rows = [(7, i) for i in range(3000)] + [(8, i) for i in range(500)] + [(None, i) for i in range(900)]
    rows += [(rng.randrange(10**9), i) for i in range(20_000)]
    rng.shuffle(rows)
    df = _side(spark, rows, "k", "v").repartition(7)
    heat = skew.sketch(df, F.col("k"), 0.01)
    assert (heat.rows, heat.nulls) == (len(rows), 900)
    assert {7, 8} <= set(heat.hot) and heat.hot[7] >= 3000 and heat.hot[8] >= 500
    assert all(n >= 0.01 * len(rows) for n in heat.hot.values())
    found = {r.k: r.n for r in skew.heavy_hitters(df, "k", 0.01).collect()}
    assert found == {7: 3000, 8: 500, None: 900}
    assert skew.heavy_hitters(df.limit(0), "k").count() == 0
    with pytest.raises(ValueError):
        skew.sketch(df, F.col("k"), 1e-6)


def test_salt_is_repeated_and_spreads_equal_rows(spark):
    df = spark.range(800).select(F.lit(1).alias("k")).repartition(8)
    salted = df.withColumn("s", F.pmod(skew.row_salt(df), F.lit(8)))
    assert salted.select("s").distinct().count() > 2
    assert Counter(r.s for r in salted.collect()) == Counter(r.s for r in salted.collect())


def _outer(left, right, how):
    pairs = Counter()
    for k, v in left:
        partners = [(k2, w) for k2, w in right if k is not None and k2 == k]
        for p in partners:
            pairs[(k, v, *p)] += 1
        if not partners and how in ("left", "outer"):
            pairs[(k, v, None, None)] += 1
    keys = {k for k, _ in left if k is not None}
    if how in ("right", "outer"):
        pairs.update((None, None, k, w) for k, w in right if k not in keys)
    return pairs


@pytest.mark.parametrize("how", joins.HOWS)
@pytest.mark.parametrize("kinds", [("BIGINT", "INT"), ("STRING", "STRING")])
def test_joins_by_heat_equal_nested_loops(spark, how, kinds):
    rng = random.Random(2)
    text = str if kinds[0] == "STRING" else int
    # 1 is hot on the left, 2 on the right, 3 on both, 4 on the left only and absent on the right, 5 on the right only
    left = [(1, i) for i in range(60)] + [(3, i % 3) for i in range(40)] + [(4, 0)] * 50 + [(2, 1), (2, 1), (2, 2)]
    right = [(2, i) for i in range(60)] + [(3, i % 3) for i in range(40)] + [(5, 0)] * 50 + [(1, 1), (1, 1)]
    left += [(None, i) for i in range(30)] + [(100 + i, i) for i in range(20)]
    right += [(None, i) for i in range(30)] + [(110 + i, i) for i in range(20)]
    left, right = ([(None if k is None else text(k), v) for k, v in rows] for rows in (left, right))
    rng.shuffle(left)
    rng.shuffle(right)
    a = _side(spark, left, "k", "v", kinds[0]).repartition(3)
    b = _side(spark, right, "k2", "w", kinds[1]).repartition(3)
    joined = joins.join_data(a, b, "k", "k2", how, rows_per_part=10)
    assert joined.columns == ["k", "v", "k2", "w"]
    assert Counter(map(tuple, joined.collect())) == _outer(left, right, how)


@pytest.mark.parametrize("how", ["left", "right", "outer"])
def test_outer_join_reads_each_side_once_and_splits_a_hot_right_key(spark, plan, tmp_path, how):
    a, b = str(tmp_path / "a"), str(tmp_path / "b")
    spark.range(50).selectExpr("id AS k", "id AS v").write.parquet(a)
    spark.range(5000).selectExpr("IF(id % 3 > 0, 7, id) AS k2", "id AS w").write.parquet(b)
    left, right = spark.read.parquet(a), spark.read.parquet(b)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        joined = joins.join_data(left, right, "k", "k2", how, rows_per_part=500)
        text = plan(joined)
        # the third scan is the table of hot keys, made in memory
        assert text.count("Scan parquet") // 2 == 2 and "ExistenceJoin" not in text
        expected = left.join(right, F.col("k") == F.col("k2"), how)
        assert Counter(map(tuple, joined.collect())) == Counter(map(tuple, expected.collect()))
        dealt = skew.deal(left, right, "k", "k2", 500).side(right, F.col("k2"), 1)
        cells = dealt.where("k2 = 7").groupBy("__cell1").count().collect()
        assert len(cells) >= 7 and max(r["count"] for r in cells) < 700
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_keys_that_nobody_shares_are_joined_plainly(spark, plan):
    a = spark.range(100).selectExpr("id AS k", "id AS v")
    b = spark.range(100).selectExpr("id AS k2", "id AS w")
    assert "__cell" not in plan(joins.join_data(a, b, "k", "k2", "outer"))
    odd = a.selectExpr("struct(k) AS k", "v"), b.selectExpr("struct(k2 AS k) AS k2", "w")
    assert joins.join_data(*odd, "k", "k2", "outer").count() == 100
    mixed = a.selectExpr("CAST(k AS STRING) AS k", "v")
    assert joins.join_data(mixed, b, "k", "k2", "outer").count() == 100


def test_salted_join_shuffles_no_key_counts(spark):
    big = spark.range(30_000).selectExpr("IF(id % 3 > 0, 1, id) AS k", "id AS v")
    small = spark.range(0, 30_000, 2).selectExpr("id AS k", "id AS w")
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("sketch", "hot keys of the big side")
    try:
        dealt = skew.deal(big, small, "k", "k", 1000, both=False)
    finally:
        spark.sparkContext.setJobGroup("", "")
    tasks = [tracker.getStageInfo(s).numTasks for j in tracker.getJobIdsForGroup("sketch") for s in tracker.getJobInfo(j).stageIds]
    assert min(tasks) == 1  # the sketches of all tasks meet in one; a shuffle by key would take more
    assert dealt.split == (True, False)
    salted = joins.join_salted(big, small, "k", rows_per_salt=1000)
    plain = big.join(small, "k").select(*salted.columns)
    assert Counter(map(tuple, salted.collect())) == Counter(map(tuple, plain.collect()))
