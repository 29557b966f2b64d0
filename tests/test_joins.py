from __future__ import annotations

import random
from collections import Counter

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from weftline.operators import joins
from weftline.operators.skew import deal

LEFT = [(1, "a"), (1, "b"), (2, "c"), (3, "d"), (None, "e"), (9, "f")]
RIGHT = [(1, "p"), (2, "q"), (2, "r"), (None, "s"), (7, "t")]


def _expected(left, right, how):
    pairs = [(k, v, k2, w) for k, v in left for k2, w in right if k is not None and k == k2]
    right_keys = {k for k, _ in right if k is not None}
    left_keys = {k for k, _ in left if k is not None}
    if how in ("left", "outer"):
        pairs += [(k, v, None, None) for k, v in left if k not in right_keys]
    if how in ("right", "outer"):
        pairs += [(None, None, k, w) for k, w in right if k not in left_keys]
    return Counter(pairs)


@pytest.mark.parametrize("how", joins.HOWS)
def test_join_data_matches_nested_loops(spark, how):
    left = spark.createDataFrame(LEFT, "k INT, v STRING")
    right = spark.createDataFrame(RIGHT, "k2 INT, w STRING")
    found = Counter(tuple(r) for r in joins.join_data(left, right, "k", "k2", how).collect())
    assert found == _expected(LEFT, RIGHT, how)


def test_unknown_join_kind_is_an_error(spark):
    with pytest.raises(ValueError, match="cross"):
        joins.join_data(spark.range(1), spark.range(1), "id", "id", "cross")


keys = st.one_of(st.none(), st.integers(0, 4))
tables = st.lists(st.tuples(keys, st.integers(0, 99)), max_size=30)


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(left=tables, right=tables, how=st.sampled_from(joins.SALTED_HOWS), salts=st.sampled_from([None, 3]))
def test_salted_join_equals_plain_join(spark, left, right, how, salts):
    big = spark.createDataFrame(left, "k INT, v INT")
    small = spark.createDataFrame(right, "k INT, w INT")
    salted = joins.join_salted(big, small, "k", how, salts=salts, rows_per_salt=2)
    plain = big.join(small, "k", how).select(*salted.columns)
    assert Counter(map(tuple, salted.collect())) == Counter(map(tuple, plain.collect()))


def test_salted_join_with_nine_tenths_on_one_key(spark):
    big = spark.range(1000).select(
        "id", F.when(F.col("id") < 900, 1).otherwise(F.col("id") % 7).alias("k")
    )
    small = spark.createDataFrame([(1, "hot"), (2, "cold")], "k BIGINT, name STRING")
    salted = joins.join_salted(big, small, "k", rows_per_salt=100)
    plain = big.join(small, "k")
    assert sorted(map(str, salted.collect())) == sorted(map(str, plain.select(*salted.columns).collect()))


def test_hot_rows_are_spread_in_proportion(spark):
    big = spark.range(1000).select("id", F.when(F.col("id") < 900, 1).otherwise(2).alias("k"))
    spread = deal(big, big, "k", "k", 100, both=False).side(big, F.col("k"), 0, ["id"])
    parts = {(r.k, r["__cell0"]): r["count"] for r in spread.groupBy("k", "__cell0").count().collect()}
    assert parts[(2, 0)] == 100
    hot_parts = [n for (k, _), n in parts.items() if k == 1]
    assert len(hot_parts) == 9 and sum(hot_parts) == 900 and max(hot_parts) < 160


@pytest.fixture
def no_auto_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_join_strategies_in_the_plan(spark, plan, no_auto_broadcast):
    fact = spark.range(1000).withColumnRenamed("id", "k")
    dim = spark.range(10).selectExpr("id AS k", "'x' AS name")
    assert "BroadcastHashJoin" in plan(joins.join_broadcast(fact, dim, "k"))
    assert "ShuffledHashJoin" in plan(joins.join_shuffle_hash(fact, dim, "k"))
    assert "SortMergeJoin" in plan(joins.join_sort_merge(fact, dim, "k"))


def test_broadcast_is_refused_above_the_limit(spark, plan, no_auto_broadcast):
    fact = spark.range(1000).withColumnRenamed("id", "k")
    dim = spark.range(100).selectExpr("id AS k")
    joined = joins.join_broadcast(fact, dim, "k", limit_bytes=100)
    assert "BroadcastHashJoin" not in plan(joined)
    assert joined.count() == 100


def test_a_build_side_that_does_not_fit_is_merged(spark, plan, no_auto_broadcast):
    fact = spark.range(1000).withColumnRenamed("id", "k")
    even = spark.range(1000).selectExpr("id AS k", "'x' AS name")
    hot = spark.range(1000).selectExpr("IF(id < 900, 1, id) AS k", "'x' AS name")
    limit = 30_000  # a partition of the even side has an eighth of some 100 KB
    for side, name in ((even, "ShuffledHashJoin"), (hot, "SortMergeJoin")):
        joined = joins.join_shuffle_hash(fact, side, "k", partition_bytes=limit)
        assert name in plan(joined) and joined.count() == 1000
    assert "SortMergeJoin" in plan(joins.join_shuffle_hash(fact, even, "k", partition_bytes=100))
    two = even.selectExpr("k", "k % 2 AS j", "name")
    pairs = joins.join_shuffle_hash(fact.selectExpr("k", "k % 2 AS j"), two, ["k", "j"])
    assert "ShuffledHashJoin" in plan(pairs) and pairs.count() == 1000


def test_star_join_order_does_not_change_rows(spark, rows):
    random.seed(1)
    fact = spark.createDataFrame([(i, i % 4, i % 6) for i in range(40)], "id INT, a INT, b INT")
    one = spark.createDataFrame([(i, f"a{i}") for i in range(3)], "ka INT, x STRING")
    two = spark.createDataFrame([(i, f"b{i}") for i in range(5)], "kb INT, y STRING")
    first = (one, F.col("a") == F.col("ka"))
    second = (two, F.col("b") == F.col("kb"))
    names = ["id", "x", "y"]
    forward = joins.join_star_left(fact, first, second).select(*names)
    assert rows(forward) == rows(joins.join_star_left(fact, second, first).select(*names))
    assert forward.count() == 40 and forward.filter("x IS NULL").count() == 10


def test_roles_join_one_dimension_twice(spark, rows):
    trips = spark.createDataFrame([("1", 2), ("2", 2), ("3", 9)], "pu STRING, do INT")
    zones = spark.createDataFrame([(1, "A"), (2, "B"), (3, "C")], "id INT, zone STRING")
    joined = joins.join_roles(trips, zones, "id", {"p": F.col("pu").cast("int"), "d": "do"})
    assert rows(joined.select("p.zone", "d.zone")) == [("A", "B"), ("B", "B")]


def test_aliased_join_keeps_both_keys(spark):
    a, b = spark.range(3), spark.range(2, 5)
    joined = joins.join_aliased(a, b, "id", ("r", "b"))
    assert [tuple(r) for r in joined.select("r.id", "b.id").collect()] == [(2, 2)]
    assert joins.join_using(a, b, "id").columns == ["id"]


@pytest.mark.parametrize("salts", [None, 16])
def test_repeated_rows_are_not_broadcast(spark, plan, salts):
    big = spark.range(1000).select("id", F.when(F.col("id") < 900, 1).otherwise(F.col("id") % 7).alias("k"))
    small = spark.range(7).selectExpr("id AS k", "id AS w")
    salted = joins.join_salted(big, small, "k", salts=salts, rows_per_salt=100)
    assert "SortMergeJoin" in plan(salted)
    assert salted.count() == 1000
