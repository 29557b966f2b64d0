from __future__ import annotations

import pytest
from pyspark.sql import functions as F
from pyspark.testing import assertDataFrameEqual

from weftline.operators import aggregates, ordering
from weftline.plans import jobs


def test_average_ratings(spark):
    reviews = spark.createDataFrame(
        [("r7", "u4", "cafe", 2), ("r8", "u5", "cafe", 3), ("r9", "u4", "cafe", 5), ("ra", "u6", "bar", None),
         ("rb", "u6", "bar", 1), ("rc", "u7", "pier", None), ("rd", "u4", None, 4)],
        "review_id STRING, user_id STRING, business_id STRING, stars INT",
    )
    expected = spark.createDataFrame(
        [("cafe", 10 / 3), ("bar", 1.0), ("pier", None), (None, 4.0)], "business_id STRING, avg_rating DOUBLE"
    )
    assertDataFrameEqual(jobs.average_ratings(reviews), expected)


def test_rating_job_end_to_end(spark, rows, tmp_path):
    spark.createDataFrame(
        [("1", "a", 0.5), ("2", "b", 4.0), ("3", "c", None)], "business_id STRING, name STRING, stars FLOAT"
    ).write.parquet(str(tmp_path / "b"))
    spark.createDataFrame([("1", 1), ("2", 2), ("2", 5)], "business_id STRING, stars INT").write.parquet(
        str(tmp_path / "r")
    )
    jobs.run_business_ratings(
        spark, str(tmp_path / "b"), str(tmp_path / "r"), str(tmp_path / "out"), keep_inputs=True
    )
    rated = spark.read.parquet(str(tmp_path / "out" / "rated"))
    assert rows(rated.select("id", "name", "avg_rating")) == [("2", "b", 3.5)]
    assert spark.read.parquet(str(tmp_path / "out" / "reviews")).count() == 3


def test_unknown_aggregate_is_an_error(spark):
    with pytest.raises(ValueError, match="median"):
        aggregates.calculate_aggregate(spark.range(1), "id", "id", "median", "m")


def test_count_column_skips_nulls_and_keeps_the_null_group(spark, rows):
    df = spark.createDataFrame([(1, "a"), (1, None), (None, "b"), (2, None)], "k INT, v STRING")
    assert rows(aggregates.count_column(df, "k", "v")) == [(None, 1), (1, 1), (2, 0)]
    assert rows(aggregates.count_column(df, "k", "k")) == [(None, 0), (1, 2), (2, 1)]


def test_sum_of_terms_leaves_out_rows_with_a_null_term(spark):
    df = spark.createDataFrame([(1, 2), (3, None)], "a INT, b INT")
    assert df.agg(aggregates.sum_of_terms("a", "b").alias("s")).first().s == 3


GROUPS = [("big", i) for i in range(25)] + [("two", 1), ("two", 1), ("one", 5), ("none", None)]


@pytest.mark.parametrize("part_rows", [100, 4])
def test_collected_parts_are_neighbouring_values(spark, part_rows):
    df = spark.createDataFrame(GROUPS, "k STRING, v INT").withColumn("id", F.monotonically_increasing_id())
    lists = aggregates.collect_values(df, ["k"], "v", "vs", ["id"], min_size=2, part_rows=part_rows)
    found = {(row.k, row.part): (row.size, row.vs) for row in lists.collect()}
    want = {("two", 0): (2, [1, 1])}
    want |= {("big", i // part_rows): (25, list(range(25))[i : i + part_rows]) for i in range(0, 25, part_rows)}
    assert found == want


@pytest.mark.parametrize("part_rows", [100, 1])
def test_size_limits_drop_whole_groups(spark, rows, part_rows):
    df = spark.createDataFrame(GROUPS, "k STRING, v INT").withColumn("id", F.monotonically_increasing_id())
    lists = aggregates.collect_values(
        df, ["k"], "v", "vs", ["id"], min_size=1, max_size=2, part_rows=part_rows
    )
    whole = [("one", 1, 0, [5]), ("two", 2, 0, [1, 1])]
    cut = [("one", 1, 0, [5]), ("two", 2, 0, [1]), ("two", 2, 1, [1])]
    assert rows(lists.select("k", "size", "part", "vs")) == (whole if part_rows == 100 else cut)


@pytest.mark.parametrize("value", ["v", "same"])
def test_a_hot_group_is_numbered_in_many_tasks(spark, value):
    df = spark.range(5_000).selectExpr("'hot' AS k", "id", "id AS v", "7 AS same")
    lists = aggregates.collect_values(df, ["k"], value, "vs", ["id"], part_rows=300)
    parts = {row.part: row.vs for row in lists.collect()}
    joined = [v for part in sorted(parts) for v in parts[part]]
    assert joined == ([7] * 5_000 if value == "same" else list(range(5_000)))
    assert all(len(vs) == 300 for part, vs in parts.items() if part < 16) and len(parts) == 17


def test_value_counts_order(spark):
    df = spark.createDataFrame([("b",), ("a",), ("c",), ("c",)], "v STRING")
    counts = [tuple(r) for r in aggregates.value_counts(df, "v").collect()]
    assert counts == [("c", 2), ("a", 1), ("b", 1)]


def test_describe_numeric(spark):
    df = spark.createDataFrame([(1, 2.0), (3, None)], "a INT, b DOUBLE")
    described = {r.column_name: r for r in aggregates.describe_numeric(df, ["a", "b"]).collect()}
    assert tuple(described["a"])[1:] == (2.0, 2.0, pytest.approx(2**0.5), 1.0, 3.0)
    assert tuple(described["b"])[1:] == (1.0, 2.0, None, 2.0, 2.0)


def test_orders(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (2, "a"), (3, "c")], "n INT, s STRING")
    assert [tuple(r) for r in ordering.sort_desc(df, "n", "s").collect()] == [
        (3, "c"), (2, "a"), (2, "b"), (1, "a"),
    ]
    assert [r.n for r in ordering.sort_keys(df, ["n", "s"]).collect()] == [1, 2, 2, 3]
    assert [r.s for r in ordering.sort_keys(df, ["n", "s"], descending=True).collect()] == list("cbaa")


def _largest_partition(df):
    return max(df.rdd.mapPartitions(lambda rows: [sum(1 for _ in rows)]).collect())


def test_tie_breakers_split_one_hot_value_over_tasks(spark, tmp_path):
    spark.range(20_000).selectExpr("1 AS v", "id").write.parquet(str(tmp_path / "hot"))
    df = spark.read.parquet(str(tmp_path / "hot"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert _largest_partition(ordering.sort_desc(df, "v")) == 20_000
        assert _largest_partition(ordering.sort_desc(df, "v", "id")) < 8_000
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_top_rows_do_not_sort_everything(spark, plan):
    top = ordering.take_top(spark.range(1000), 3, [F.desc("id")])
    assert [r.id for r in top.collect()] == [999, 998, 997]
    assert "TakeOrderedAndProject" in plan(top)


def test_union_is_by_position_and_keeps_duplicates(spark, rows):
    a = spark.createDataFrame([(1, "x")], "id INT, v STRING")
    b = spark.createDataFrame([(1, "x")], "other INT, name STRING")
    assert rows(ordering.union_positional(a, b)) == [(1, "x"), (1, "x")]


def test_a_sort_that_writes_first_runs_the_join_once(spark, plan):
    a = spark.range(1000).selectExpr("id AS k", "id % 7 AS v")
    joined = a.join(a.withColumnRenamed("v", "w"), "k")
    assert "Join" in plan(ordering.sort_desc(joined, "v", "k"))
    ordered = ordering.sort_desc(joined, "v", "k", write_first=True)
    assert "Join" not in plan(ordered)
    assert [tuple(r) for r in ordered.collect()] == sorted(map(tuple, joined.collect()), key=lambda r: (-r[1], r[0]))
