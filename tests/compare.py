"""Run registered queries against their DuckDB oracles.

    python -m tests.compare FOLDER [query ...]
"""

from __future__ import annotations

import decimal
import sys
import time

import duckdb

from turnero.plans import oracle, queries

SOURCES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
           "labels conversations").split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in SOURCES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')")
    return con


def _plain(value):
    if isinstance(value, decimal.Decimal):
        return str(value.normalize())
    return repr(value)


def difference(spark, con, folder: str, name: str) -> str | None:
    """None when Spark and DuckDB agree on columns, rows and values; else what differs."""
    frame = queries.build(name)(spark, folder)
    cursor = con.execute(oracle.STATEMENTS[name])
    names = [d[0] for d in cursor.description]
    columns = sorted(frame.columns)
    if columns != sorted(names):
        return f"columns {columns} != {sorted(names)}"
    order = [names.index(c) for c in columns]
    expected = sorted(tuple(_plain(row[i]) for i in order) for row in cursor.fetchall())
    actual = sorted(tuple(_plain(v) for v in row) for row in frame.select(*columns).collect())
    if len(actual) != len(expected):
        return f"{len(actual)} rows, expected {len(expected)}"
    for got, want in zip(actual, expected):
        if got != want:
            return f"got {got}, expected {want}"
    return None


def main() -> int:
    from turnero.session import build_session

    folder, wanted = sys.argv[1], sys.argv[2:]
    spark = build_session("compare", "local[8]", **{"spark_sql_shuffle_partitions": "8", "spark_ui_enabled": "false",
                                                    "spark_driver_memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    con, failed = connect(folder), 0
    for name in wanted or oracle.STATEMENTS:
        begin = time.time()
        try:
            problem = difference(spark, con, folder, name)
        except Exception as error:  # keep going: report every query
            problem = f"{type(error).__name__}: {str(error)[:400]}"
        failed += problem is not None
        if problem or wanted:
            print(f"{name}: {problem or 'ok'} ({time.time() - begin:.1f}s)", flush=True)
    missing = sorted(set(queries.PLANS) - set(oracle.STATEMENTS))
    print(f"{failed} differ; without oracle: {missing}")
    return failed


if __name__ == "__main__":
    sys.exit(main())
