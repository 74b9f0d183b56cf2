"""Compare a Spark result with the result of SQL over the same parquet files."""

from __future__ import annotations

import glob
import os
from collections import Counter

import duckdb


def sql_connection(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.splitext(os.path.basename(path))[0]
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return connection


# Spark type -> DuckDB type
TYPES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
    "timestamp_ntz": "TIMESTAMP",
}


def differences(df, connection, sql: str) -> list[str]:
    """Empty if column names, types and the rows as a multiset are equal."""
    found = []
    result = connection.execute(sql)
    theirs = {d[0]: str(d[1]) for d in result.description}
    ours = {name: TYPES[kind] for name, kind in df.dtypes}
    if ours != theirs:
        found.append(f"schema: spark {ours}, sql {theirs}")
        return found
    order = [list(theirs).index(name) for name in df.columns]
    expected = Counter(tuple(row[i] for i in order) for row in result.fetchall())
    actual = Counter(tuple(row) for row in df.collect())
    if expected != actual:
        missing, extra = expected - actual, actual - expected
        found.append(
            f"rows: {sum(actual.values())} spark, {sum(expected.values())} sql; "
            f"missing {list(missing)[:3]}; extra {list(extra)[:3]}"
        )
    return found
