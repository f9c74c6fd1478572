"""Run registered queries against their SQL twins: ``python -m checks.compare [folder] [name ...]``."""

from __future__ import annotations

import datetime
import sys
import time

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()


def duck(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{folder}/{t}.parquet'")
    return con


def kind(value) -> str:
    if isinstance(value, bool):
        return "bool"
    if isinstance(value, datetime.datetime):
        return "timestamp"
    return type(value).__name__


def rows_of(names, rows) -> list[tuple]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(r[i] for i in order) for r in rows), key=repr)


def difference(spark_df, con, sql: str) -> str | None:
    """None when names, types of values and all values agree."""
    got = spark_df.collect()
    cursor = con.execute(sql)
    names = [c[0] for c in cursor.description]
    want = cursor.fetchall()
    if sorted(names) != sorted(spark_df.columns):
        return f"columns {sorted(spark_df.columns)} != {sorted(names)}"
    a, b = rows_of(spark_df.columns, got), rows_of(names, want)
    if len(a) != len(b):
        return f"{len(a)} rows != {len(b)}"
    bad = [(x, y) for x, y in zip(a, b) if x != y or [kind(v) for v in x] != [kind(v) for v in y]]
    return f"{len(bad)} of {len(a)} rows differ, first {bad[0]}" if bad else None


def main() -> int:
    from checks.oracle import ORACLE
    from checks.queries import QUERIES
    from checks.session import local_session

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = sys.argv[2:] or list(QUERIES)
    spark, con, failed = local_session(), duck(folder), 0
    for name in wanted:
        start = time.time()
        try:
            df = QUERIES[name](spark, folder)
            problem = difference(df, con, ORACLE[name]) if name in ORACLE else f"rows only: {df.count()}"
        except Exception as e:  # one broken query must not hide the rest
            problem = f"{type(e).__name__}: {str(e)[:600]}"
        bad = problem is not None and not problem.startswith("rows only")
        failed += bad
        print(f"{'FAIL' if bad else 'ok':4} {time.time() - start:6.2f}s {name} {problem or ''}", flush=True)
    print(f"{len(wanted)} queries, {failed} failed")
    return failed


if __name__ == "__main__":
    sys.exit(main())
