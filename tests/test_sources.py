from __future__ import annotations

import datetime

import pytest

from weftline.sources import files, generate, sinks, tables
from weftline.workspace import SETTING, materialize, workspace

PEOPLE = "id BIGINT, name STRING, at TIMESTAMP_NTZ"
AT = datetime.datetime(2024, 1, 2, 3, 4, 5, 678901)


@pytest.fixture
def people(spark):
    return files.rows_to_frame(spark, [(1, "a", AT), (2, None, None)], PEOPLE)


@pytest.mark.parametrize("fmt", ["parquet", "csv", "json", "orc"])
def test_round_trip_keeps_microseconds_and_nulls(spark, people, rows, tmp_path, fmt):
    sinks.write_data(people, str(tmp_path / fmt), fmt)
    assert rows(files.read_data(spark, str(tmp_path / fmt), fmt, PEOPLE)) == rows(people)


def test_unknown_formats_are_errors(spark, people, tmp_path):
    with pytest.raises(ValueError, match="xls"):
        files.read_data(spark, str(tmp_path), "xls")
    with pytest.raises(ValueError, match="xls"):
        sinks.write_data(people, str(tmp_path), "xls")


def test_empty_rows_keep_the_schema(spark):
    assert files.rows_to_frame(spark, [], PEOPLE).columns == ["id", "name", "at"]


def _json_parts(tmp_path):
    texts = ['{"user_id": 1, "kind": "a"}\n{"user_id": 2}', "", '{"user_id": 1, "extra": 9}']
    paths = []
    for i, text in enumerate(texts):
        path = tmp_path / f"part{i}.json"
        path.write_text(text)
        paths.append(str(path))
    return paths


def test_json_list_and_accumulated_union_keep_all_files(spark, rows, tmp_path):
    paths = _json_parts(tmp_path)
    schema = "user_id BIGINT, kind STRING"
    expected = [(1, None), (1, "a"), (2, None)]
    assert rows(files.scan_json(spark, paths, schema)) == expected
    assert rows(files.union_files(spark, paths, schema)) == expected


def test_csv_header_all_text_or_inferred(spark, tmp_path):
    (tmp_path / "a.csv").write_text("ID;Idade\n1;25\n2;31\n")
    text = files.scan_csv_header(spark, str(tmp_path / "a.csv"), sep=";")
    assert dict(text.dtypes) == {"ID": "string", "Idade": "string"}
    inferred = files.scan_csv_header(spark, str(tmp_path / "a.csv"), sep=";", infer=True)
    assert dict(inferred.dtypes) == {"ID": "int", "Idade": "int"}


def test_partitioned_sink_makes_one_folder_per_value(spark, rows, plan, tmp_path):
    df = spark.range(1000).selectExpr("id", "id % 3 AS k")
    path = str(tmp_path / "out")
    sinks.write_partitioned(df, path, ["k"])
    assert sorted(p.name for p in (tmp_path / "out").iterdir() if p.is_dir()) == ["k=0", "k=1", "k=2"]
    back = spark.read.parquet(path).filter("k = 1")
    assert back.count() == 333
    assert "PartitionFilters: [isnotnull(k" in plan(back)


@pytest.mark.parametrize("single", [True, False])
def test_json_report_is_sorted_in_one_file_or_in_several(spark, tmp_path, single):
    df = spark.range(500).selectExpr("499 - id AS id").repartition(6)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        sinks.write_json_sorted(df, str(tmp_path / "r"), ["id"], single_file=single)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    parts = sorted((tmp_path / "r").glob("*.json"))
    assert (len(parts) == 1) is single
    lines = [line for part in parts for line in part.read_text().splitlines()]
    assert lines == [f'{{"id":{i}}}' for i in range(500)]


def test_csv_stores_maps_as_json(spark, tmp_path):
    df = spark.sql("SELECT 1 AS id, map('a', 'x,y', 'b', '\"q\"') AS m")
    sinks.write_csv_maps(df, str(tmp_path / "m"))
    back = spark.read.options(header=True, escape='"').csv(str(tmp_path / "m")).first()
    assert back.m == '{"a":"x,y","b":"\\"q\\""}'


@pytest.mark.parametrize(("size_mb", "files_written"), [(None, 1), (384, 3), (10, 1)])
def test_json_to_parquet_file_count(spark, tmp_path, size_mb, files_written):
    spark.range(300).write.json(str(tmp_path / "j"))
    target = tmp_path / "p"
    assert sinks.json_to_parquet(spark, str(tmp_path / "j"), str(target), size_mb=size_mb) == files_written
    assert len(list(target.glob("*.parquet"))) == files_written
    assert spark.read.parquet(str(target)).count() == 300


def test_external_table_is_dropped_and_its_frame_stays_usable(spark, tmp_path):
    spark.range(7).write.parquet(str(tmp_path / "t"))
    with tables.external_table(spark, str(tmp_path / "t")) as name:
        frame = spark.table(name)
    assert frame.count() == 7
    assert not spark.catalog.tableExists(name)
    assert spark.read.parquet(str(tmp_path / "t")).count() == 7


def test_insert_values_with_null(spark, rows, tmp_path):
    tables.create_table(spark, "t_insert", "id STRING, n BIGINT", str(tmp_path / "t"))
    try:
        tables.insert_values(spark, "t_insert", [("a", 1), ("b", None)])
        assert rows(spark.table("t_insert")) == [("a", 1), ("b", None)]
    finally:
        spark.sql("DROP TABLE t_insert")


def test_generated_rows_are_repeatable_and_in_range(spark, rows):
    ids = generate.id_range(spark, 1000, 4)
    first = generate.gen_transactions(ids)
    assert rows(first) == rows(generate.gen_transactions(ids.repartition(7)))
    low, high, values = first.selectExpr("min(amount)", "max(amount)", "count(DISTINCT amount)").first()
    assert 0 <= low < 100 and 9900 < high <= 10000 and values > 950
    stores = generate.gen_stores(generate.id_range(spark, 99))
    assert stores.select("name").distinct().count() == 99


def test_iot_reading_has_the_known_hash(spark):
    iot = generate.gen_iot(generate.id_range(spark, 100))
    row = iot.filter("id = 519220707").first()
    assert row.time == "2023-12-04 12:19:44"
    assert 0 <= row.value < 1


def test_skew_generator_repeats_rows_with_the_hot_value(spark, rows):
    df = spark.createDataFrame([(1, "x"), (2, "y")], "id BIGINT, day STRING")
    skewed = generate.gen_skew(df, "day", "hot", copies=2)
    assert rows(skewed) == [(1, "hot"), (1, "hot"), (1, "x"), (2, "hot"), (2, "hot"), (2, "y")]


def test_workspace_follows_the_session_setting(spark):
    assert workspace(spark, "x").startswith(spark.conf.get(SETTING))
    assert workspace(spark, "x") != workspace(spark, "x")


def test_materialize_cuts_the_lineage(spark, rows, plan):
    df = spark.range(10).groupBy().count()
    written = materialize(df, "test")
    assert rows(written) == [(10,)]
    assert "Aggregate" not in plan(written)
