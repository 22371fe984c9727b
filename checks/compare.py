"""Run registered queries on Spark and their SQL on DuckDB and compare the rows.

    python -m checks.compare [--sf 0.01] [key …]
"""

from __future__ import annotations

import glob
import importlib
import math
import os
import sys
import time

import duckdb

TESTDATA = os.environ.get("TESTDATA", "/root/testdata")


def cell(value):
    if value is None:
        return "∅"
    if isinstance(value, bool):
        return str(value)
    if isinstance(value, float):
        return "∅" if math.isnan(value) else f"{value + 0.0:.6f}"
    if isinstance(value, int):
        return f"{value:.6f}"
    return str(value)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(cell(r[i]) for i in order) for r in rows)


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def compare(spark, sf_dir: str, name: str, query, sql: str | None, con=None) -> tuple[bool, str]:
    start = time.time()
    df = query(spark, sf_dir)
    got_cols, got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    spark_s = time.time() - start
    if sql is None:
        return True, f"{len(got)} rows (no SQL), {spark_s:.1f}s"
    result = (con or duck(sf_dir)).execute(sql)
    want_cols, want = rows_of([d[0] for d in result.description], result.fetchall())
    if got_cols != want_cols:
        return False, f"columns {got_cols} != {want_cols}"
    if got != want:
        missing = [r for r in want if r not in set(got)][:3]
        extra = [r for r in got if r not in set(want)][:3]
        return False, f"{len(got)} != {len(want)} rows; only Spark {extra}; only SQL {missing}"
    return True, f"{len(got)} rows, {spark_s:.1f}s"


def main() -> None:
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    entry = importlib.import_module("__spark_entry__")
    from logwarden.session import session

    args = sys.argv[1:]
    sf = args[args.index("--sf") + 1] if "--sf" in args else "0.01"
    wanted = [a for a in args if not a.startswith("--") and a != sf]
    spark = session("compare", "local[8]", **{
        "spark.sql.shuffle.partitions": "8", "spark.driver.memory": "12g", "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    queries, oracle = entry.queries(), entry.oracle_sql()
    sf_dir = f"{TESTDATA}/sf{sf}"
    con = duck(sf_dir)
    names = [n for n in queries if not wanted or any(w == n or (w.endswith("*") and n.startswith(w[:-1])) for w in wanted)]
    failed = []
    for name in names:
        try:
            ok, text = compare(spark, sf_dir, name, queries[name], oracle.get(name), con)
        except Exception as error:  # report and go on to the next key
            ok, text = False, f"{type(error).__name__}: {str(error)[:1500]}"
        print(("ok  " if ok else "FAIL"), name, text, flush=True)
        if not ok:
            failed.append(name)
    print(f"{len(names) - len(failed)} of {len(names)} agree; failed: {failed}")


if __name__ == "__main__":
    main()
