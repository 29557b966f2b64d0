from __future__ import annotations

import random
import statistics

from pyspark.sql import functions as F

from weftline.operators import layout, sketches
from weftline.operators.quality import column_profile
from weftline.plans import queries_quality
from weftline.workspace import materialize

SCHEMA = "part INT, amount DOUBLE, tag STRING, low STRING, empty INT"


def _rows(n, seed=1):
    rng = random.Random(seed)
    return [
        (rng.choice((1, 2, 3, None)), rng.choice((None, rng.gauss(50, 9))), f"t{rng.randrange(n // 2)}", "x", None)
        for _ in range(n)
    ]


def test_merged_parts_are_the_profile_of_the_whole(spark):
    rows = _rows(6000)
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    parts = materialize(sketches.sketch_parts(df, "part"), "sketches")
    assert parts.count() == 4 * 5
    merged = {r.column_name: r for r in sketches.merge_parts(parts).collect()}
    whole = {r.column_name: r for r in column_profile(df, exact=True).collect()}
    assert merged.keys() == whole.keys()
    for name, exact in whole.items():
        found = merged[name]
        assert found.n_rows == 6000 and found.completeness == exact.completeness
        assert (found.min_value, found.max_value) == (exact.min_value, exact.max_value)
        assert (found["mean"] is None) == (exact["mean"] is None)
        assert found["mean"] is None or abs(found["mean"] - exact["mean"]) < 1e-9
        assert abs(found.distinct_values - exact.distinct_values) <= 4 * sketches.DISTINCT_ERROR * exact.distinct_values
    amounts = sorted(r[1] for r in rows if r[1] is not None)
    rank = sum(a <= merged["amount"].median for a in amounts) / len(amounts)
    assert abs(rank - 0.5) <= 2 * sketches.RANK_ERROR
    assert merged["tag"].median is None and merged["empty"].median is None


def test_a_new_part_reads_its_own_rows_only(spark, plan):
    old = materialize(sketches.sketch_parts(spark.createDataFrame(_rows(500), SCHEMA), F.lit("day 1")), "sketches")
    new = spark.createDataFrame(_rows(300, 2), SCHEMA)
    grown = old.unionByName(sketches.sketch_parts(new, F.lit("day 2")))
    both = {r.column_name: r for r in sketches.merge_parts(grown).collect()}
    assert {r.n_rows for r in both.values()} == {800}
    again = sketches.merge_parts(grown.where("part = 'day 1'")).where("column_name = 'tag'").first()
    assert again.n_rows == 500 and again.distinct_values <= both["tag"].distinct_values
    total = [r[1] for seed, n in ((1, 500), (2, 300)) for r in _rows(n, seed) if r[1] is not None]
    assert abs(both["amount"]["mean"] - statistics.mean(total)) < 1e-9


def test_no_rows_and_odd_types(spark):
    odd = spark.sql(
        "SELECT CAST(id AS DECIMAL(10, 2)) AS `a.b`, array(id) AS list, map('k', id) AS m, named_struct('x', id) AS s,"
        " id % 2 = 0 AS b, DATE '2024-01-01' AS d, current_timestamp() AS t, CAST('z' AS BINARY) AS z FROM range(40)"
    )
    merged = {r.column_name: r for r in sketches.merge_parts(sketches.sketch_parts(odd, F.col("b"))).collect()}
    assert {n: r.distinct_values for n, r in merged.items()} == {
        "a.b": 40, "list": 40, "m": 40, "s": 40, "b": 2, "d": 1, "t": 1, "z": 1,
    }
    assert merged["a.b"].max_value == 39.0
    assert sketches.merge_parts(sketches.sketch_parts(odd.limit(0), F.col("b"))).count() == 0


def test_statistics_change_the_order_of_joins(spark, tmp_path):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    names = ["fact_t", "wide_t", "few_t"]
    frames = {
        "fact_t": spark.range(20_000).selectExpr("id % 5000 AS a", "id % 100 AS b"),
        "wide_t": spark.range(20_000).selectExpr("id % 5000 AS wa", "id AS x"),
        "few_t": spark.range(100).selectExpr("id AS fb", "id % 50 AS size"),
    }
    text = "SELECT count(*) AS n FROM fact_t JOIN wide_t ON a = wa JOIN few_t ON b = fb WHERE size = 7"
    try:
        for name, df in frames.items():
            df.write.mode("overwrite").option("path", str(tmp_path / name)).saveAsTable(name)

        def joined_first() -> bool:
            """Whether the filtered table meets the fact before the wide one does."""
            plan = spark.sql(f"EXPLAIN EXTENDED {text}").first()[0]
            plan = plan[plan.index("== Optimized Logical Plan ==") : plan.index("== Physical Plan ==")]
            depth = {n: next(line for line in plan.splitlines() if f".{n}" in line or f"`{n}`" in line).find("Relation") for n in names}
            return depth["few_t"] > depth["wide_t"]

        plain = joined_first()
        with layout.planned_by_cost(spark):
            unknown = joined_first()
            layout.analyze_columns(frames["fact_t"], "fact_t", ["a", "b"])
            layout.analyze_columns(frames["wide_t"], "wide_t", ["wa", "x"])
            layout.analyze_columns(frames["few_t"], "few_t", ["fb", "size"])
            analyzed = joined_first()
            assert spark.sql(text).first().n == 1600
        assert (plain, unknown, analyzed) == (False, False, True)
        assert spark.conf.get("spark.sql.cbo.enabled") == "false"
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        for name in names:
            spark.sql(f"DROP TABLE IF EXISTS {name}")


def test_a_cached_table_is_filled_at_once_and_released(spark, plan):
    df = spark.range(100).selectExpr("id", "id % 3 AS k")
    with layout.cached_table(df, "kept_numbers") as kept:
        assert spark.catalog.isCached("kept_numbers")
        joined = spark.range(1000).withColumnRenamed("id", "o").join(kept, F.col("o") == F.col("id"))
        text = plan(joined)
        assert "In-memory table kept_numbers" in text and "BroadcastHashJoin" in text
        assert joined.count() == 100
    assert not [t for t in spark.catalog.listTables() if t.name == "kept_numbers"]


def test_exact_values_beside_sketches_need_no_expand(plan, spark):
    found = queries_quality._profile_from_parts(spark, "/root/testdata/sf0.001")
    assert "Expand" not in plan(found)
    assert all(r.is_close for r in found.collect())
