"""Run queries beside their SQL in DuckDB and compare the rows.

    python tools/compare.py [--sf DIR] [names...]
"""

from __future__ import annotations

import argparse
import datetime
import decimal
import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from registry import ORACLES, QUERIES  # noqa: E402
from tidemark.session import build_session  # noqa: E402

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
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, decimal.Decimal):
        return int(value) if value == value.to_integral_value() else float(value)
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value
    if isinstance(value, (bytes, bytearray)):
        return bytes(value).hex()
    if isinstance(value, (datetime.date, datetime.datetime)):
        return value.isoformat()
    if isinstance(value, (list, tuple)):
        return tuple(plain(v) for v in value)
    return value


def ordered(columns: list[str], rows) -> tuple[list[str], list[tuple]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    found = [tuple(plain(row[i]) for i in order) for row in rows]
    return [columns[i] for i in order], sorted(found, key=repr)


def compare(spark, con, folder: str, name: str) -> str:
    """Empty text if rows agree, otherwise what differs."""
    df = QUERIES[name](spark, folder)
    got = ordered(df.columns, [tuple(r) for r in df.collect()])
    if name not in ORACLES:
        return "" if got[1] else "no rows"
    result = con.execute(ORACLES[name])
    columns = [d[0] for d in result.description]
    want = ordered(columns, result.fetchall())
    if got[0] != want[0]:
        return f"columns {got[0]} != {want[0]}"
    if len(got[1]) != len(want[1]):
        return f"{len(got[1])} rows != {len(want[1])}"
    if not got[1]:
        return "no rows on either side"
    for a, b in zip(got[1], want[1]):
        if a != b or [type(x) for x in a] != [type(x) for x in b]:
            return f"{a} != {b}"
    return ""


def main() -> int:
    parser = argparse.ArgumentParser()
    parser.add_argument("names", nargs="*")
    parser.add_argument("--sf", default="/root/testdata/sf0.01")
    args = parser.parse_args()
    spark = build_session(
        "compare",
        "local[8]",
        spark__sql__shuffle__partitions="8",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
        spark__driver__memory="8g",
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(args.sf)
    bad = 0
    for name in args.names or QUERIES:
        start = time.time()
        try:
            problem = compare(spark, con, args.sf, name)
        except Exception as error:  # noqa: BLE001
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        bad += bool(problem)
        kind = "sql " if name in ORACLES else "rows"
        print(f"{'FAIL' if problem else 'ok  '} {kind} {time.time() - start:6.2f}s {name} {problem}", flush=True)
    print(f"{bad} failed of {len(args.names or QUERIES)}")
    return bad


if __name__ == "__main__":
    sys.exit(main())
