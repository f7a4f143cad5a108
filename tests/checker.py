"""Spark result against the check SQL on DuckDB, as sorted rows by column name.

Run as a script for a report: ``python -m tests.checker [sf_dir] [key ...]``.
"""

from __future__ import annotations

import os
import sys
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events "
    "documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _plain(v):
    if isinstance(v, float):
        return f"{v + 0.0:.9g}" if v else "0"
    if isinstance(v, int) and not isinstance(v, bool):
        return f"{v:.9g}" if abs(v) < 10**9 else str(v)
    return str(v)


def normal_rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_plain(r[i]) for i in order) for r in rows)


def compare(spark, con, key, fn, sql, sf_dir):
    """(ok, message)."""
    return compare_rows(con, fn(spark, sf_dir), sql)


def compare_rows(con, df, sql):
    mine = normal_rows(df.columns, df.collect())
    if sql is None:
        return True, f"{len(mine)} rows, no SQL"
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    theirs = normal_rows(names, cur.fetchall())
    if sorted(names) != sorted(df.columns):
        return False, f"columns {sorted(df.columns)} against {sorted(names)}"
    if len(mine) != len(theirs):
        return False, f"{len(mine)} rows against {len(theirs)}: {mine[:3]} {theirs[:3]}"
    wrong = [(a, b) for a, b in zip(mine, theirs) if a != b]
    if wrong:
        return False, f"{len(wrong)} of {len(mine)} rows differ, first {wrong[0]}"
    return True, f"{len(mine)} rows equal"


def main() -> None:
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    from tests.conftest import make_session
    from __spark_entry__ import oracle_sql, queries

    args = sys.argv[1:]
    sf_dir = args[0] if args else "/root/testdata/sf0.01"
    spark, con = make_session(), connect(sf_dir)
    chosen = args[1:]
    bad = 0
    for key, fn in queries().items():
        if chosen and key not in chosen:
            continue
        began = time.monotonic()
        try:
            ok, message = compare(spark, con, key, fn, oracle_sql().get(key), sf_dir)
        except Exception as e:  # report and go on
            ok, message = False, f"{type(e).__name__}: {str(e)[:600]}"
        bad += not ok
        print(f"{'ok  ' if ok else 'FAIL'} {key} {time.monotonic() - began:.1f}s {message}"[:1200], flush=True)
    print("failures:", bad)


if __name__ == "__main__":
    main()
