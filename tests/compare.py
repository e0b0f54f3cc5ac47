"""Compare every query with its SQL on DuckDB: ``python -m tests.compare [sf_dir] [name ...]``."""

from __future__ import annotations

import datetime
import glob
import os
import sys
import time
from collections import Counter

import duckdb


def plain(value):
    if isinstance(value, float):
        return "nan" if value != value else repr(value + 0.0)
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None).isoformat()
    return repr(value)


def bag(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), Counter(tuple(plain(row[i]) for i in order) for row in rows)


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    db = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        db.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return db


def compare(spark, db, query, sql: str, sf_dir: str) -> str | None:
    """None if both give the same columns and bag of rows, else what differs."""
    df = query(spark, sf_dir)
    columns, got = bag(df.columns, df.collect())
    cursor = db.execute(sql)
    names, wanted = bag([d[0] for d in cursor.description], cursor.fetchall())
    if columns != names:
        return f"columns {columns} against {names}"
    if got != wanted:
        extra, missing = got - wanted, wanted - got
        return f"{sum(got.values())} against {sum(wanted.values())} rows; extra {list(extra)[:2]}, missing {list(missing)[:2]}"
    return None


def main() -> int:
    import __spark_entry__ as entry
    from wardloom.session import build_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session(
        "compare", "local[8]", spark__sql__shuffle__partitions=8, spark__driver__memory="8g", spark__ui__showConsoleProgress="false"
    )
    spark.sparkContext.setLogLevel("ERROR")
    db, failed, sql = connect(sf_dir), 0, entry.oracle_sql()
    for name, query in entry.queries().items():
        if len(sys.argv) > 2 and name not in sys.argv[2:]:
            continue
        started = time.time()
        try:
            problem = compare(spark, db, query, sql[name], sf_dir)
        except Exception as error:  # noqa: BLE001
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        failed += problem is not None
        print(f"{'ok  ' if problem is None else 'FAIL'} {name} {time.time() - started:.1f}s {(problem or '')[:900]}", flush=True)
    return failed


if __name__ == "__main__":
    sys.exit(main())
