"""Compare a Spark result with DuckDB's, types and values alike."""

from __future__ import annotations

import glob
import os

import duckdb
import pyarrow as pa


def duck(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    connection.execute("SET TimeZone = 'UTC'")
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return connection


def kind(t: pa.DataType) -> str:
    if pa.types.is_string(t) or pa.types.is_large_string(t):
        return "string"
    if pa.types.is_timestamp(t):
        return "timestamp"
    return str(t)


def rows(table: pa.Table) -> list[tuple]:
    names = sorted(table.column_names)
    columns = [table.column(n).to_pylist() for n in names]
    return sorted(zip(*columns), key=repr)


def differences(spark_table: pa.Table, duck_table: pa.Table) -> list[str]:
    found = []
    ours = {f.name: kind(f.type) for f in spark_table.schema}
    theirs = {f.name: kind(f.type) for f in duck_table.schema}
    if ours != theirs:
        found.append(f"schema {sorted(ours.items())} != {sorted(theirs.items())}")
    if set(ours) != set(theirs):
        return found
    left, right = rows(spark_table), rows(duck_table)
    if len(left) != len(right):
        found.append(f"{len(left)} rows != {len(right)} rows")
    wrong = [(a, b) for a, b in zip(left, right) if a != b]
    if wrong:
        found.append(f"{len(wrong)} rows differ, first {wrong[0]}")
    return found
