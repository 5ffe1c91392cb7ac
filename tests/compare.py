"""Run registered queries next to their SQL in DuckDB and report differences.

    python tests/compare.py [sf_dir] [name ...]

Doubles are compared to nine digits, or to the last bit with COMPARE_EXACT=1.
"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

EXACT = os.environ.get("COMPARE_EXACT") == "1"
TABLES = (
    "region nation customer supplier part orders lineitem events "
    "documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def plain(value):
    if isinstance(value, float):
        if math.isnan(value):
            return "nan"
        return repr(value) if EXACT else f"{value:.9g}"
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, int):
        return value
    return str(value)


def table_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    body = sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)
    return [columns[i] for i in order], body


def difference(spark, con, name, sf_dir, queries, oracles) -> tuple[str | None, int, float]:
    start = time.time()
    df = queries[name](spark, sf_dir)
    got = table_of(df.columns, [tuple(r) for r in df.collect()])
    seconds = time.time() - start
    if name not in oracles:
        return None, len(got[1]), seconds
    cursor = con.execute(oracles[name])
    want = table_of([c[0] for c in cursor.description], cursor.fetchall())
    if got[0] != want[0]:
        return f"columns {got[0]} vs {want[0]}", len(got[1]), seconds
    if len(got[1]) != len(want[1]):
        return f"{len(got[1])} rows vs {len(want[1])}", len(got[1]), seconds
    bad = [(a, b) for a, b in zip(*(got[1], want[1])) if a != b]
    if bad:
        return f"{len(bad)} rows differ, first: {bad[0][0]} vs {bad[0][1]} {got[0]}", len(got[1]), seconds
    types = [(type(x).__name__, type(y).__name__) for x, y in zip(got[1][0], want[1][0])] if got[1] else []
    odd = [t for t in types if t[0] != t[1]]
    return (f"types {odd}" if odd else None), len(got[1]), seconds


def main() -> int:
    from ledgerloom.registry import ORACLES, QUERIES
    from ledgerloom.session import build_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(QUERIES)
    spark = build_session("compare", "local[8]", **{
        "spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g", "spark.ui.showConsoleProgress": "false",
    })
    spark.sparkContext.setLogLevel("ERROR")
    con, failures = connect(sf_dir), 0
    for name in names:
        try:
            problem, rows, seconds = difference(spark, con, name, sf_dir, QUERIES, ORACLES)
        except Exception as error:  # report and go on with the next query
            problem, rows, seconds = f"{type(error).__name__}: {str(error)[:600]}", -1, 0.0
        failures += problem is not None
        note = "" if name in ORACLES else " (no SQL)"
        print(f"{'FAIL' if problem else 'ok  '} {name}{note} rows={rows} {seconds:.2f}s {problem or ''}", flush=True)
    print(f"{len(names)} queries, {failures} failures")
    return 1 if failures else 0


if __name__ == "__main__":
    raise SystemExit(main())
