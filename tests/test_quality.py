from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from weftline.operators import layout, quality

NAN = float("nan")

BUSINESS = [("1", 3.5), ("1", 4.0), ("2", 4.5), ("3", 5.0)]
REVIEW = [("1", 5), ("1", 3), ("2", 6), ("3", 1)]
USER = [("1", 4.5), ("1", 5.5), ("2", 3.0), ("3", 0.0)]


def test_business_review_and_user_validators(spark):
    business = spark.createDataFrame(BUSINESS, "business_id STRING, stars FLOAT")
    review = spark.createDataFrame(REVIEW, "review_id STRING, stars INT")
    user = spark.createDataFrame(USER, "user_id STRING, average_stars FLOAT")
    assert quality.duplicate_keys(business, ["business_id"]).count() == 1
    assert quality.invalid_step(business, "stars").count() == 0
    assert quality.duplicate_keys(review, ["review_id"]).count() == 1
    assert quality.invalid_range(review, "stars", 1, 5).count() == 1
    assert quality.duplicate_keys(user, ["user_id"]).count() == 1
    assert quality.invalid_range(user, "average_stars", 0.0, 5.0).count() == 1


def test_rating_steps(spark):
    df = spark.createDataFrame([(0.0,), (0.5,), (0.7,), (5.0,), (5.5,), (None,)], "stars DOUBLE")
    assert sorted(r.stars for r in quality.invalid_step(df, "stars").collect()) == [0.0, 0.7, 5.5]


def test_missing_values_by_type(spark):
    df = spark.createDataFrame(
        [(1, NAN, "a", None), (None, None, None, None), (3, 1.0, "", None)],
        "i INT, f DOUBLE, s STRING, t TIMESTAMP",
    )
    assert quality.missing_values(df).first().asDict() == {"i": 1, "f": 2, "s": 1, "t": 3}


def _statuses(df, *checks):
    return {r.constraint: (r.ratio, r.status) for r in quality.run_checks(df, checks).collect()}


def test_checks(spark):
    df = spark.createDataFrame(
        [("a", 1.0, 1), ("b", 2.0, -1), ("b", 9.0, 0), (None, None, None)],
        "id STRING, stars DOUBLE, n INT",
    )
    found = _statuses(
        df,
        quality.is_complete("id"),
        quality.is_unique("id"),
        quality.is_contained_in("stars", [1.0, 2.0]),
        quality.is_non_negative("n"),
    )
    assert found == {
        "isComplete(id)": (0.75, "Failure"),
        "isUnique(id)": (pytest.approx(1 / 3), "Failure"),
        "isContainedIn(stars)": (0.75, "Failure"),
        "isNonNegative(n)": (0.75, "Failure"),
    }


def test_checks_on_no_rows_succeed(spark):
    df = spark.createDataFrame([], "id STRING")
    found = _statuses(df, quality.is_complete("id"), quality.is_unique("id"))
    assert {status for _, status in found.values()} == {"Success"}


def test_unknown_check_is_an_error(spark):
    with pytest.raises(ValueError, match="isOdd"):
        quality.run_checks(spark.range(1), [quality.Check("isOdd", "id")])


def test_analyzers_estimate_distinct_values_within_bounds(spark):
    df = spark.range(20_000).selectExpr("id % 5000 AS k", "IF(id % 4 = 0, NULL, id) AS v")
    found = {r.metric: r.value for r in quality.run_analyzers(df, "v", "k", "k").collect()}
    assert found["Size"] == 20_000 and found["Completeness"] == 0.75 and found["Mean"] == 2499.5
    assert found["ApproxCountDistinct"] == pytest.approx(5000, rel=0.15)


def test_profile_and_suggestions(spark, rows):
    df = spark.range(100).selectExpr(
        "id", "CAST(id % 4 AS STRING) AS kind", "IF(id < 50, NULL, -1.5D) AS x"
    )
    profile = {r.column_name: r for r in quality.column_profile(df, exact=True).collect()}
    assert tuple(profile["id"])[1:] == ("bigint", 1.0, 100, 49.5, 0.0, 99.0)
    assert tuple(profile["kind"])[1:] == ("string", 1.0, 4, None, None, None)
    assert tuple(profile["x"])[1:] == ("double", 0.5, 1, -1.5, -1.5, -1.5)
    assert rows(quality.suggest_constraints(df, exact=True)) == rows(quality.suggest_constraints(df)) == [
        ("id", "complete"),
        ("id", "non_negative"),
        ("id", "unique"),
        ("kind", "categorical"),
        ("kind", "complete"),
        ("x", "categorical"),
    ]


def test_profile_of_no_rows(spark):
    profile = quality.column_profile(spark.createDataFrame([], "a INT")).first()
    assert profile.completeness is None and profile.distinct_values == 0


def test_profile_reads_the_input_once(spark, plan, tmp_path):
    spark.range(10).selectExpr("id", "id AS b").write.parquet(str(tmp_path / "p"))
    df = spark.read.parquet(str(tmp_path / "p"))
    assert plan(quality.column_profile(df)).count("Scan parquet") == 2  # tree and details


def test_size_of_each_type(spark):
    df = spark.sql(
        "SELECT 1L AS l, 2 AS i, 'abç' AS s, array(1.0f, 2.0f) AS a, true AS b UNION ALL "
        "SELECT NULL, NULL, NULL, NULL, NULL"
    )
    sizes = {r.column_name: r.bytes for r in layout.estimate_size(df).collect()}
    assert sizes == {"l": 8, "i": 4, "s": 4, "a": 8, "b": 1, "total": 25}
    assert layout.total_bytes(df) == 25


def test_partitions(spark):
    df = spark.range(100)
    assert layout.repartition_n(df, 24).rdd.getNumPartitions() == 24
    base = layout.repartition_n(df, 16)
    assert layout.coalesce_n(base, 24).rdd.getNumPartitions() == 16
    assert layout.coalesce_n(base, 12).rdd.getNumPartitions() == 12
    profile = layout.partition_profile(layout.repartition_n(df, 5)).collect()
    assert len(profile) == 5 and sum(r.rows for r in profile) == 100
    one_key = layout.repartition_n(df.withColumn("k", F.lit(1)), 5, "k")
    assert sorted(r.rows for r in layout.partition_profile(one_key).collect()) == [0, 0, 0, 0, 100]
    summary = layout.partition_summary(one_key).first()
    assert tuple(summary) == (5, 4, 100, 5.0)
    assert layout.partition_summary(df.limit(0)).first().n_rows == 0


def test_three_kinds_of_size(spark, tmp_path):
    df = spark.range(1000).selectExpr("id", "repeat('x', CAST(id % 50 AS INT)) AS s")
    sizes = {r.kind: r.bytes for r in layout.size_kinds(df).collect()}
    assert sizes["data"] == 8000 + sum(i % 50 for i in range(1000)) and sizes["plan"] > 0
    assert sizes["build"] == 1000 * (2 * 24 + 32) + 2 * sum(-(-(i % 50) // 8) * 8 for i in range(1000))
    df.write.parquet(str(tmp_path / "t"))
    read = spark.read.parquet(str(tmp_path / "t"))
    written = sum(f.stat().st_size for f in (tmp_path / "t").glob("*.parquet"))
    assert abs(layout.plan_bytes(read) - written) < 0.01 * written
    assert layout.plan_bytes(read.where("id < 0")) <= layout.plan_bytes(read)
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("plan_size_")]


def test_reuse_is_released(spark):
    df = spark.range(10).selectExpr("id * 2 AS x")
    with layout.reused(df) as kept:
        assert kept.count() == 10 and kept.is_cached
    assert not df.is_cached


def test_column_statistics_are_stored(spark, tmp_path):
    spark.range(10).write.parquet(str(tmp_path / "t"))
    spark.catalog.createTable("t_stats", path=str(tmp_path / "t"), source="parquet")
    try:
        layout.analyze_columns(spark.range(0), "t_stats", ["id"])
        facts = {r[0]: r[1] for r in spark.sql("DESCRIBE EXTENDED t_stats id").collect()}
        assert facts["distinct_count"] == "10" and facts["max"] == "9"
    finally:
        spark.sql("DROP TABLE t_stats")


def test_estimates_do_not_hide_unique_columns(spark):
    df = spark.range(10_000).selectExpr("id", "CONCAT('n', id) AS name", "id % 5000 AS half", "id % 25 AS `it's`")
    found = {tuple(r) for r in quality.suggest_constraints(df).collect()}
    assert {c for c, s in found if s == "unique"} == {"id", "name"}
    assert {c for c, s in found if s == "categorical"} == {"it's"}


def test_exact_profiles_need_no_expand(spark, plan):
    df = spark.range(10).selectExpr("id", "id % 3 AS k", "CAST(id AS STRING) AS s")
    assert "Expand" not in plan(quality.column_profile(df, exact=True))


@pytest.mark.parametrize("error", [0.7, 1.4])
def test_suggestions_hold_when_estimates_are_far_off(spark, rows, monkeypatch, error):
    df = spark.range(1000).selectExpr("id", "id % 25 AS code", "id % 26 AS many", "id % 999 AS almost")
    want = rows(quality.suggest_constraints(df, exact=True))
    assert ("id", "unique") in want and ("code", "categorical") in want
    estimate = quality.F.approx_count_distinct
    monkeypatch.setattr(quality.F, "approx_count_distinct", lambda c: (quality.F.count_distinct(c) * error).cast("long"))
    found = rows(quality.suggest_constraints(df))
    monkeypatch.setattr(quality.F, "approx_count_distinct", estimate)
    assert found == want
