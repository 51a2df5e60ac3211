"""Compares named queries with their SQL. Run as a script: `python tests/oracle.py FOLDER [NAME…]`."""

from __future__ import annotations

import sys
import time
from collections import Counter
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

TABLES = ("documents", "conversations", "labels", "benchmark", "pages")


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return connection


def differences(frame, connection: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    """What differs: column names, types of numbers and text, rows; empty when all is equal."""
    result = connection.execute(sql)
    names = sorted(column[0] for column in result.description)
    if names != sorted(frame.columns):
        return [f"columns {sorted(frame.columns)} and {names}"]
    order = [[column[0] for column in result.description].index(name) for name in names]
    expected = Counter(tuple(row[i] for i in order) for row in result.fetchall())
    found = Counter(tuple(row) for row in frame.select(*names).collect())
    if found == expected:
        return []
    extra, missing = found - expected, expected - found
    return [f"{extra.total()} rows too many, {missing.total()} missing"] + [
        f"{word} {str(row)[:600]}"
        for word, rows in (("extra", extra), ("missing", missing))
        for row in list(rows)[:2]
    ]


def main(folder: str, only: list[str]) -> int:
    from textflow.plans.oracle import SQL
    from textflow.plans.queries import QUERIES
    from textflow.session import local_session

    spark = local_session(8)
    connection = connect(folder)
    failed = 0
    for name in only or QUERIES:
        start = time.time()
        try:
            frame = QUERIES[name](spark, folder)
            if name in SQL:
                found = differences(frame, connection, SQL[name])
            else:
                found = [] if frame.count() else ["no rows"]
        except Exception as error:  # noqa: BLE001
            found = [str(error)[:1500]]
        failed += bool(found)
        print(f"{'BAD' if found else 'ok '} {name} {time.time() - start:.1f}s", flush=True)
        for line in found:
            print("    ", line, flush=True)
    return failed


if __name__ == "__main__":
    sys.exit(main(sys.argv[1], sys.argv[2:]))
