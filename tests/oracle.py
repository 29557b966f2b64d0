"""Compare every query with its SQL: names, types, row count and values in any order.

Run as a script: ``python -m tests.oracle [sf_dir] [name ..]``.
"""

from __future__ import annotations

import datetime
import decimal
import math
import sys
import time
from collections import Counter

import duckdb
from pyspark.sql import DataFrame

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages"
    " benchmark labels conversations"
).split()

INTEGERS = {"tinyint", "smallint", "int", "bigint", "TINYINT", "SMALLINT", "INTEGER", "BIGINT"}
SAME_TYPE = {
    ("double", "DOUBLE"),
    ("string", "VARCHAR"),
    ("boolean", "BOOLEAN"),
    ("date", "DATE"),
    ("timestamp_ntz", "TIMESTAMP"),
}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return connection


def _plain(value):
    if isinstance(value, bool) or value is None or isinstance(value, (str, int)):
        return value
    if isinstance(value, float):
        return "nan" if math.isnan(value) else float(repr(value))
    if isinstance(value, (decimal.Decimal, datetime.date, datetime.datetime)):
        return str(value)
    return repr(value)


def _rows(names: list[str], rows) -> Counter:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


def differences(df: DataFrame, connection: duckdb.DuckDBPyConnection, sql: str) -> str:
    """An empty string when both sides agree, else what differs."""
    result = connection.sql(sql)
    names, kinds = result.columns, [str(t) for t in result.types]
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} against {sorted(names)}"
    spark_kinds = dict(df.dtypes)
    for name, kind in zip(names, kinds, strict=True):
        mine = spark_kinds[name]
        if not ({mine, kind} <= INTEGERS or (mine, kind) in SAME_TYPE):
            return f"{name}: type {mine} against {kind}"
    mine = _rows(df.columns, df.collect())
    theirs = _rows(names, result.fetchall())
    if mine == theirs:
        return ""
    only_mine, only_theirs = mine - theirs, theirs - mine
    return (
        f"rows {mine.total()} against {theirs.total()};"
        f" only here {list(only_mine)[:2]}, only there {list(only_theirs)[:2]}"
    )


def main(arguments: list[str]) -> int:
    import __spark_entry__ as entry
    from tests.session import new_session

    sf_dir = arguments[0] if arguments else "/root/testdata/sf0.01"
    wanted = arguments[1:]
    spark, connection = new_session(), connect(sf_dir)
    oracles, bad = entry.oracle_sql(), 0
    for name, function in entry.queries().items():
        if wanted and name not in wanted:
            continue
        start = time.perf_counter()
        try:
            df = function(spark, sf_dir)
            if name in oracles:
                problem = differences(df, connection, oracles[name])
                state = problem or "ok"
            else:
                problem, state = "", f"rows only: {df.count()}"
        except Exception as error:  # one broken query must not hide the others
            problem = state = f"{type(error).__name__}: {str(error)[:700]}"
        bad += bool(problem)
        print(f"{name:28s} {time.perf_counter() - start:6.2f}s  {state}", flush=True)
    print(f"{bad} bad")
    return bad


if __name__ == "__main__":
    sys.exit(bool(main(sys.argv[1:])))
