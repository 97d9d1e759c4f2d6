"""Run every registered query next to its DuckDB equivalent.

    python -m tests.compare [folder] [query ...]
"""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb

import __spark_entry__ as contract


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for file in Path(folder).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return connection


def rows(names: list[str], values) -> list[tuple]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(row[i] for i in order) for row in values), key=repr)


def difference(spark, connection, folder: str, name: str) -> str | None:
    """What differs for the query, or nothing."""
    df = contract.queries()[name](spark, folder)
    ours = rows(df.columns, df.collect())
    oracle = contract.oracle_sql().get(name)
    if oracle is None:
        return None if ours else "no rows"
    cursor = connection.execute(oracle)
    names = [column[0] for column in cursor.description]
    theirs = rows(names, cursor.fetchall())
    if sorted(names) != sorted(df.columns):
        return f"columns {df.columns} and {names}"
    if len(ours) != len(theirs):
        return f"{len(ours)} and {len(theirs)} rows"
    for left, right in zip(ours, theirs):
        if left != right:
            return f"{str(left)[:300]} and {str(right)[:300]}"
    return None


if __name__ == "__main__":
    from tests.conftest import session

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark, connection = session(), connect(folder)
    failed = 0
    for name in sys.argv[2:] or contract.queries():
        start = time.time()
        try:
            problem = difference(spark, connection, folder, name)
        except Exception as error:
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        failed += problem is not None
        kind = "oracle" if name in contract.oracle_sql() else "rows only"
        print(f"{name:32} {kind:10} {time.time() - start:6.2f}s {problem or 'ok'}", flush=True)
    sys.exit(1 if failed else 0)
