"""Run registered queries in Spark and their SQL in DuckDB, and compare.

python -m tests.compare [folder] [name ...]
"""

from __future__ import annotations

import glob
import math
import os
import sys
import time

import duckdb

from tidewell.session import local_session


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def plain(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return None
    if isinstance(value, bool):
        return value
    if isinstance(value, (int, float)):
        return float(value)
    return str(value)


def rows_of(names: list[str], rows) -> tuple[list[str], list[tuple]]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    key = lambda row: [(v is not None, str(v)) for v in row]
    return [names[i] for i in order], sorted((tuple(plain(row[i]) for i in order) for row in rows), key=key)


def difference(df, con, sql: str) -> tuple[str | None, int]:
    """What differs between a DataFrame and an SQL result, or None."""
    names, left = rows_of(df.columns, [tuple(r) for r in df.collect()])
    result = con.execute(sql)
    other, right = rows_of([d[0] for d in result.description], result.fetchall())
    if names != other:
        return f"columns {names} / {other}", len(left)
    if len(left) != len(right):
        return f"{len(left)} rows / {len(right)}; first {left[:1]} / {right[:1]}", len(left)
    for a, b in zip(left, right):
        if a != b:
            bad = [(n, x, y) for n, x, y in zip(names, a, b) if x != y]
            wrong = sum(x != y for x, y in zip(left, right))
            return f"{wrong} rows differ, first {bad[:4]}", len(left)
    return None, len(left)


def main() -> None:
    from __spark_entry__ import oracle_sql, queries

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = sys.argv[2:]
    spark = local_session("8")
    con = connect(folder)
    known, sql = queries(), oracle_sql()
    failed = 0
    for name, run in known.items():
        if wanted and not any(name.startswith(w) for w in wanted):
            continue
        start = time.time()
        try:
            if name in sql:
                problem, count = difference(run(spark, folder), con, sql[name])
            else:
                problem, count = None, len(run(spark, folder).collect())
            state = "FAIL " + problem if problem else ("ok" if name in sql else "ok (rows)")
            failed += problem is not None
        except Exception as error:
            state, count, failed = "ERROR " + str(error)[:700].replace("\n", " "), 0, failed + 1
        print(f"{name:28s} {time.time() - start:6.1f}s {count:8d} {state}", flush=True)
    print("failed:", failed)


if __name__ == "__main__":
    main()
