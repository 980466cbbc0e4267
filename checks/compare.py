"""Runs registered queries beside their SQL in DuckDB: ``python -m checks.compare <sf_dir> [name ...]``."""

from __future__ import annotations

import sys
import time
import traceback
from pathlib import Path

import duckdb
from pyspark.sql import DataFrame, SparkSession

from checks.catalogue import QUERIES
from headway.session import build_session

NAMES = (
    "region nation customer supplier part orders lineitem events "
    "documents embeddings pages benchmark labels conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in NAMES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return connection


def _text(value: object) -> str:
    if value is None or value != value:
        return "NULL"
    return repr(value) if isinstance(value, float) else str(value)


def _canonical(columns: list[str], rows: list[tuple]) -> tuple[list[str], list[tuple[str, ...]]]:
    """Column names in order, and the rows as sorted text."""
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(_text(row[i]) for i in order) for row in rows)


def differences(result: DataFrame, connection: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """None when both results hold the same rows, else what differs."""
    expected = connection.execute(sql)
    want_columns, want = _canonical([d[0] for d in expected.description], expected.fetchall())
    have_columns, have = _canonical(result.columns, result.collect())
    if have_columns != want_columns:
        return f"columns {have_columns} != {want_columns}"
    if len(have) != len(want):
        return f"rows {len(have)} != {len(want)}"
    if not have:
        return "both empty"
    unequal = [(h, w) for h, w in zip(have, want) if h != w]
    if unequal:
        return f"{len(unequal)} of {len(have)} rows differ, first {have_columns}\n{unequal[0][0]}\n{unequal[0][1]}"
    return None


def main(sf_dir: str, names: list[str]) -> int:
    spark: SparkSession = build_session(
        "compare",
        "local[8]",
        {"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "8g"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    connection, failed = duck(sf_dir), 0
    for name in names or list(QUERIES):
        started = time.time()
        try:
            result = QUERIES[name].run(spark, sf_dir)
            problem = differences(result, connection, QUERIES[name].sql)
        except Exception as error:  # report and go on with the next query
            problem = f"{type(error).__name__}: {str(error)[:1500]}"
            if "-v" in sys.argv:
                traceback.print_exc()
        failed += problem is not None
        print(f"{'ok  ' if problem is None else 'FAIL'} {name} {time.time() - started:.1f}s {problem or ''}", flush=True)
    return failed


if __name__ == "__main__":
    arguments = [a for a in sys.argv[1:] if not a.startswith("-")]
    sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
    sys.exit(main(arguments[0], arguments[1:]))
