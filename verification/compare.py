"""Runs queries on Spark and their SQL on DuckDB and compares the rows: ``python -m verification.compare [dir] [name...]``."""

from __future__ import annotations

import os
import sys
import time
import traceback

import duckdb

from caremeld.session import local_session
from verification.queries import ORACLE, QUERIES


def normal(rows, columns: list[str]) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(r[i] for i in order) for r in rows), key=lambda r: tuple((v is None, str(v)) for v in r))


def oracle_connection(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for file in os.listdir(sf_dir):
        if file.endswith(".parquet"):
            connection.execute(f"create view {file[:-8]} as select * from '{sf_dir}/{file}'")
    return connection


def compare(spark, connection, sf_dir: str, name: str) -> str:
    """'' when equal, else what differs."""
    result = QUERIES[name](spark, sf_dir)
    ours = normal([tuple(r) for r in result.collect()], result.columns)
    if name not in ORACLE:
        return f"no SQL, {len(ours)} rows"
    cursor = connection.execute(ORACLE[name])
    columns = [d[0] for d in cursor.description]
    theirs = normal(cursor.fetchall(), columns)
    if sorted(columns) != sorted(result.columns):
        return f"columns {sorted(result.columns)} against {sorted(columns)}"
    if len(ours) != len(theirs):
        return f"{len(ours)} rows against {len(theirs)}"
    different = [(a, b) for a, b in zip(ours, theirs) if a != b]
    return f"{len(different)} of {len(ours)} rows differ, first {different[0]}" if different else ""


def main(arguments: list[str]) -> int:
    sf_dir = arguments[0] if arguments else "/root/testdata/sf0.01"
    names = arguments[1:] or list(QUERIES)
    spark = local_session("compare", 8)
    spark.sparkContext.setLogLevel("ERROR")
    connection = oracle_connection(sf_dir)
    failed = 0
    for name in names:
        started = time.time()
        try:
            problem = compare(spark, connection, sf_dir, name)
        except Exception as error:  # noqa: BLE001 - the run goes on with the next query
            problem = f"{type(error).__name__}: {str(error)[:1500]}"
            traceback.print_exc(limit=-3)
        failed += bool(problem)
        print(f"{'DIFF' if problem else 'ok  '} {name} {time.time() - started:.1f}s {problem}", flush=True)
    print(f"{len(names) - failed} of {len(names)} equal")
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
