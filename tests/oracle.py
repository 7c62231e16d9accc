"""Compare every registered query with its SQL: python tests/oracle.py [folder] [name ...]"""

from __future__ import annotations

import datetime
import decimal
import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as entry  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')")
    return con


def plain(value):
    if isinstance(value, decimal.Decimal):
        return ("n", float(value))
    if isinstance(value, bool):
        return ("b", value)
    if isinstance(value, (int, float)):
        return ("n", "nan" if isinstance(value, float) and math.isnan(value) else value)
    if isinstance(value, datetime.datetime):
        return ("t", value.replace(tzinfo=None).isoformat())
    return ("", "") if value is None else ("s", str(value))


def rows_of(columns: list[str], rows: list) -> tuple[list[str], list]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(
        [tuple(plain(row[i]) for i in order) for row in rows], key=repr
    )


def compare(spark, con, name: str, folder: str) -> str:
    """'' when both agree, else what differs. Prints the number of rows."""
    df = entry.queries()[name](spark, folder)
    got_columns, got = rows_of(df.columns, df.collect())
    relation = con.execute(entry.oracle_sql()[name])
    want_columns, want = rows_of([d[0] for d in relation.description], relation.fetchall())
    print(f"{len(got):>8}", end=" ")
    if got_columns != want_columns:
        return f"columns {got_columns} != {want_columns}"
    if len(got) != len(want):
        return f"{len(got)} rows != {len(want)}"
    for a, b in zip(got, want):
        if a != b:
            return f"row\n  {str(a)[:700]}\n  {str(b)[:700]}"
    return ""


def main(folder: str, names: list[str]) -> int:
    from newslens.session import build_session

    spark = build_session(
        master="local[8]",
        spark__ui__enabled="false",
        spark__driver__memory="8g",
        spark__sql__shuffle__partitions="8",
        spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(folder)
    bad = 0
    for name in names or sorted(entry.oracle_sql()):
        begin = time.time()
        try:
            problem = compare(spark, con, name, folder)
        except Exception as error:  # noqa: BLE001
            problem = f"{type(error).__name__}: {str(error)[:1200]}"
        bad += bool(problem)
        print(f"{'FAIL' if problem else 'ok  '} {name} {time.time() - begin:.1f}s {problem}", flush=True)
    print("failed:", bad)
    return bad


if __name__ == "__main__":
    args = sys.argv[1:]
    sys.exit(bool(main(args[0] if args else "/root/testdata/sf0.01", args[1:])))
