"""Run registered queries on Spark and their SQL on DuckDB and compare the results.

``python -m tests.oracle FOLDER [NAME ...]`` prints one line per query.
"""

from __future__ import annotations

import sys
import time

import duckdb

from labelloom.catalog import QUERIES, SQL

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{folder}/{table}.parquet')")
    return connection


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted((tuple(row[i] for i in order) for row in rows), key=repr)


def compare(spark, connection, folder: str, name: str) -> tuple[bool, str]:
    start = time.time()
    frame = QUERIES[name](spark, folder)
    ours = rows_of(frame.columns, [tuple(r) for r in frame.collect()])
    spent = time.time() - start
    if name not in SQL:
        return bool(ours[1]), f"{len(ours[1])} rows, no SQL, {spent:.1f} s"
    start = time.time()
    cursor = connection.execute(SQL[name])
    theirs = rows_of([d[0] for d in cursor.description], cursor.fetchall())
    spent_sql = time.time() - start
    if ours == theirs:
        return True, f"{len(ours[1])} rows, {spent:.1f} s, SQL {spent_sql:.1f} s"
    if ours[0] != theirs[0]:
        return False, f"columns {ours[0]} / {theirs[0]}"
    mine, other = set(ours[1]) - set(theirs[1]), set(theirs[1]) - set(ours[1])
    return False, f"{len(ours[1])} / {len(theirs[1])} rows; only here {sorted(mine, key=repr)[:2]}; only there {sorted(other, key=repr)[:2]}"


def main() -> int:
    from labelloom.session import build_session

    folder, names = sys.argv[1], sys.argv[2:] or list(QUERIES)
    spark = build_session(
        master="local[8]",
        **{
            "spark.sql.shuffle.partitions": "8",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "12g",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    connection = connect(folder)
    failed = 0
    for name in names:
        try:
            ok, note = compare(spark, connection, folder, name)
        except Exception as error:  # noqa: BLE001
            ok, note = False, f"{type(error).__name__}: {str(error)[:600]}"
        failed += not ok
        print("ok  " if ok else "FAIL", name, note, flush=True)
    print("failed:", failed)
    return failed


if __name__ == "__main__":
    sys.exit(1 if main() else 0)
