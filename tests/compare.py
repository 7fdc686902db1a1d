"""Run SQL over the sample tables in DuckDB and compare with a Spark result."""

from __future__ import annotations

import glob
import os
from collections import Counter

import duckdb


def sample_tables(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.splitext(os.path.basename(path))[0]
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return connection


def differences(spark_frame, connection: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    """Empty when columns and rows agree exactly, whatever their order."""
    cursor = connection.execute(sql)
    expected_columns = [column[0] for column in cursor.description]
    columns = spark_frame.columns
    if sorted(columns) != sorted(expected_columns):
        return [f"columns {sorted(set(columns) ^ set(expected_columns))}"]
    order = sorted(columns)
    picks = [expected_columns.index(name) for name in order]
    expected = Counter(tuple(row[i] for i in picks) for row in cursor.fetchall())
    actual = Counter(tuple(row) for row in spark_frame.select(*order).collect())
    if expected == actual:
        return []
    missing = list((expected - actual).items())
    extra = list((actual - expected).items())
    found = [f"rows {sum(actual.values())} against {sum(expected.values())}, {len(missing)} missing, {len(extra)} extra"]
    for (want, _), (got, _) in zip(sorted(missing, key=repr)[:3], sorted(extra, key=repr)[:3], strict=False):
        found.append(str([(name, w, g) for name, w, g in zip(order, want, got, strict=True) if w != g] or (want, got)))
    return found
