"""Spark against DuckDB: same columns, same rows, whatever the order.

``python tests/compare.py [sf_dir] [name ...]`` prints one line per query.
"""

from __future__ import annotations

import os
import sys
import time
from collections import Counter

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES.split():
        con.sql(f"create view {name} as select * from '{sf_dir}/{name}.parquet'")
    return con


def _rows(rows: list, columns: list[str]) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple((type(r[i]).__name__, r[i]) for i in order) for r in map(tuple, rows))


def difference(spark, con, query, sql: str, sf_dir: str) -> str | None:
    """What differs, or None."""
    ours = query(spark, sf_dir)
    theirs = con.sql(sql)
    if sorted(ours.columns) != sorted(theirs.columns):
        return f"columns {sorted(ours.columns)} <> {sorted(theirs.columns)}"
    a, b = _rows(ours.collect(), ours.columns), _rows(theirs.fetchall(), theirs.columns)
    if a != b:
        return f"rows {sum(a.values())} <> {sum(b.values())}; {list((a - b))[:2]} <> {list((b - a))[:2]}"
    return None


def main() -> None:
    from blockloom.session import build_session
    from workload.queries import ORACLES, QUERIES

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session(
        "compare", "local[8]", spark__sql__shuffle__partitions="8", spark__ui__enabled="false",
        spark__driver__memory="8g", spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(sf_dir)
    failed = 0
    for name in sys.argv[2:] or QUERIES:
        start = time.time()
        try:
            found = difference(spark, con, QUERIES[name], ORACLES[name], sf_dir) if name in ORACLES else "no oracle"
        except Exception as error:  # report and go on with the next query
            found = f"{type(error).__name__}: {str(error)[:600]}"
        failed += found is not None
        print(f"{'FAIL' if found else 'ok  '} {name} {time.time() - start:.2f}s {found or ''}", flush=True)
    print(f"{failed} failed")


if __name__ == "__main__":
    main()
