"""Run every registered query against its oracle; also usable as a script."""

from __future__ import annotations

import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def oracle_connection(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return connection


def _text(value: object) -> str:
    if value is None:
        return "~"
    if isinstance(value, bool):
        return str(value)
    if isinstance(value, float):
        return repr(value + 0.0)
    return str(value)


def rows_of(columns: list[str], rows) -> tuple[list[str], list[tuple[str, ...]]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    values = sorted(tuple(_text(row[i]) for i in order) for row in rows)
    return [columns[i] for i in order], values


def compare(df, sql: str, connection) -> tuple[int, str | None]:
    """The number of rows, and what differs if anything."""
    found = rows_of(df.columns, df.collect())
    result = connection.execute(sql)
    expected = rows_of([c[0] for c in result.description], result.fetchall())
    if found[0] != expected[0]:
        return len(found[1]), f"columns {found[0]} vs {expected[0]}"
    if found[1] != expected[1]:
        extra = [r for r in found[1] if r not in set(expected[1])][:2]
        lacking = [r for r in expected[1] if r not in set(found[1])][:2]
        return len(found[1]), f"{len(found[1])} vs {len(expected[1])} rows; {extra} vs {lacking}"
    return len(found[1]), None


if __name__ == "__main__":
    from pyspark.sql import SparkSession

    from __spark_entry__ import oracle_sql, queries

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    only = sys.argv[2:]
    session = (
        SparkSession.builder.master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    oracle, duck = oracle_sql(), oracle_connection(sf_dir)
    for name, query in queries().items():
        if only and name not in only:
            continue
        began = time.time()
        try:
            n, problem = compare(query(session, sf_dir), oracle[name], duck)
        except Exception as error:
            n, problem = -1, str(error)[:600]
        print(f"{'ok  ' if problem is None else 'DIFF'} {name} {n} {time.time() - began:.2f}s {problem or ''}", flush=True)
