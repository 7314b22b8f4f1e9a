"""Run registered queries against their SQL counterpart in DuckDB and compare the values."""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

DRIVER_TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]


def duck(path: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in DRIVER_TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}/{name}.parquet')")
    return con


def _cell(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return "~"
    if isinstance(value, bool):
        return str(value)
    if isinstance(value, (int, float)):
        return repr(float(value) + 0.0)
    return str(value)


def canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_cell(row[i]) for i in order) for row in rows)


def check(df, con, sql) -> str | None:
    """None when equal, else a short description of the first difference."""
    result = con.execute(sql)
    columns = [d[0] for d in result.description]
    theirs = result.fetchall()
    if sorted(columns) != sorted(df.columns):
        return f"columns spark={sorted(df.columns)} sql={sorted(columns)}"
    ours = [tuple(r) for r in df.collect()]
    a, b = canonical(df.columns, ours), canonical(columns, theirs)
    if a == b:
        return None
    if len(a) != len(b):
        return f"rows spark={len(a)} sql={len(b)}"
    bad = [(x, y) for x, y in zip(a, b) if x != y]
    return f"{len(bad)} of {len(a)} rows differ, first: spark={bad[0][0]} sql={bad[0][1]} ({sorted(columns)})"


def main() -> None:
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    import __spark_entry__ as entry
    from spark_revenue.session import build_session

    path = os.environ.get("SF_DIR", "/root/testdata/sf0.01")
    spark = build_session("compare", "local[8]", **{
        "spark.sql.shuffle.partitions": "8", "spark.driver.memory": "12g",
        "spark.driver.extraJavaOptions": "-Dderby.system.home=/tmp",
    })
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(path)
    wanted = sys.argv[1:]
    sqls, bad = entry.oracle_sql(), 0
    for name, fn in entry.queries().items():
        if wanted and not any(name.startswith(w) for w in wanted):
            continue
        start = time.time()
        try:
            df = fn(spark, path)
            note = check(df, con, sqls[name]) if name in sqls else f"rows only: {df.count()}"
        except Exception as err:  # report and go on to the next query
            note = f"ERROR {type(err).__name__}: {str(err)[:600]}"
        status = "ok" if note is None else note
        bad += status != "ok" and not status.startswith("rows only")
        print(f"{name:40s} {time.time() - start:6.2f}s {status}", flush=True)
    print("different:", bad)


if __name__ == "__main__":
    main()
