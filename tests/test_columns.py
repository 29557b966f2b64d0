from __future__ import annotations

import pytest

from weftline.functions import codes, text, units
from weftline.operators import columns

LICENCES = [("HV0002",), ("HV0003",), ("HV0004",), ("HV0005",), ("X",), (None,)]


@pytest.fixture
def licences(spark):
    return spark.createDataFrame(LICENCES, "code STRING")


def test_native_mapping_keeps_unknown_codes(licences):
    named = licences.select(codes.map_codes("code").alias("n"))
    assert [r.n for r in named.collect()] == ["Juno", "Uber", "Via", "Lyft", "X", None]


def test_row_and_pandas_udf_agree_and_say_unknown(spark, licences):
    expected = ["Juno", "Uber", "Via", "Lyft", "Unknown", "Unknown"]
    row_udf, vector_udf = codes.udf_map_codes(), codes.pandas_udf_map_codes()
    assert [r.n for r in licences.select(row_udf("code").alias("n")).collect()] == expected
    assert [r.n for r in licences.select(vector_udf("code").alias("n")).collect()] == expected
    spark.udf.register("licence_name", row_udf)
    assert [r.n for r in licences.selectExpr("licence_name(code) AS n").collect()] == expected


def test_null_or_blank(spark):
    df = spark.createDataFrame([(None,), ("",), ("  ",), ("u",)], "user_id STRING")
    flags = [r.f for r in df.select(text.is_null_or_blank("user_id").alias("f")).collect()]
    assert flags == [True, True, True, False]


def test_text_compared_as_number_skips_bad_text(spark):
    df = spark.createDataFrame([("25",), ("31",), ("x",), (None,)], "idade STRING")
    assert [r.idade for r in columns.filter_number_above(df, "idade", 30).collect()] == ["31"]


def test_filter_takes_columns_and_sql(spark):
    df = spark.range(5)
    assert columns.filter_data(df, "id > 2").count() == columns.filter_data(df, df.id > 2).count() == 2


def test_date_and_range_filters_reach_the_scan(spark, plan, tmp_path):
    df = spark.sql(
        "SELECT TIMESTAMP_NTZ'2024-01-01 00:00:00' + make_dt_interval(0, id) AS ts, id FROM range(72)"
    )
    df.write.parquet(str(tmp_path / "e"))
    stored = spark.read.parquet(str(tmp_path / "e"))
    day = columns.on_date(stored, "ts", "2024-01-02")
    assert sorted(r.id for r in day.collect()) == list(range(24, 48))
    assert "GreaterThanOrEqual(ts" in plan(day)
    inside = columns.time_range(stored, "ts", "2024-01-01 10:00:00", "2024-01-01 12:00:00")
    assert sorted(r.id for r in inside.collect()) == [10, 11, 12]
    assert "GreaterThanOrEqual(ts" in plan(inside)


def test_struct_expansion_and_projection(spark):
    df = spark.sql("SELECT 1 AS id, struct(2 AS a, 3 AS b) AS data")
    assert columns.expand_struct(df, "data", "id").columns == ["a", "b", "id"]
    aliased = df.alias("t")
    assert columns.project_columns(aliased, {"t.id": "key", "t.data.a": "first"}).columns == ["key", "first"]


@pytest.mark.parametrize(
    ("size", "expected"),
    [
        (0, "0B"),
        (1, "1.0 B"),
        (1023, "1023.0 B"),
        (1024, "1.0 KB"),
        (1536, "1.5 KB"),
        (1024**2, "1.0 MB"),
        (1024**3 - 1, "1024.0 MB"),
        (5 * 1024**4, "5.0 TB"),
    ],
)
def test_format_bytes(spark, size, expected):
    df = spark.createDataFrame([(size,)], "bytes BIGINT")
    assert df.select(units.format_bytes("bytes").alias("t")).first().t == expected
