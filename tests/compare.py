"""Runs registered queries next to their SQL twins and compares whole results."""

from __future__ import annotations

import glob
import math
import os
import sys
import time

import duckdb
from pyspark.sql import SparkSession


def local_session(cpus: str = "8") -> SparkSession:
    return (
        SparkSession.builder.master(f"local[{cpus}]").appName("caseflow-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("caseflow.read.tasks", cpus)
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def views(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _cell(x):
    if x is None or (isinstance(x, float) and math.isnan(x)):
        return None
    if isinstance(x, bool):
        return x
    if isinstance(x, float):
        return round(x, 6) + 0.0
    return x


def _rows(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    cells = [tuple(_cell(r[i]) for i in order) for r in rows]
    return sorted(cells, key=lambda r: tuple((c is not None, str(type(c)), str(c)) for c in r))


def difference(frame, con: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """None when columns, types and values agree; otherwise what differs first."""
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    expected = _rows(names, result.fetchall())
    actual = _rows(frame.columns, frame.collect())
    if sorted(names) != sorted(frame.columns):
        return f"columns {sorted(frame.columns)} != {sorted(names)}"
    if len(expected) != len(actual):
        return f"{len(actual)} rows != {len(expected)}; {actual[:1]} / {expected[:1]}"
    for a, e in zip(actual, expected):
        for x, y in zip(a, e):
            same = type(x) is type(y) and (
                math.isclose(x, y, rel_tol=1e-9, abs_tol=2e-6) if isinstance(x, float) else x == y)
            if not same:
                return f"{x!r} != {y!r} in\n  {a}\n  {e}"
    return None


def main() -> int:
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    import __spark_entry__ as entry

    sf_dir = sys.argv[1]
    wanted = sys.argv[2:]
    spark = local_session()
    spark.sparkContext.setLogLevel("ERROR")
    con = views(sf_dir)
    oracles, bad = entry.oracle_sql(), 0
    for name, build in entry.queries().items():
        if wanted and not any(name.startswith(w) for w in wanted):
            continue
        start = time.time()
        try:
            frame = build(spark, sf_dir)
            if name in oracles:
                problem = difference(frame, con, oracles[name])
            else:
                problem = None if frame.count() else "no rows"
        except Exception as error:  # report and go on with the next query
            problem = f"{type(error).__name__}: {str(error)[:1500]}"
        bad += problem is not None
        kind = "sql " if name in oracles else "rows"
        print(f"{'OK  ' if problem is None else 'FAIL'} {kind} {name} {time.time() - start:.1f}s {problem or ''}", flush=True)
    return bad


if __name__ == "__main__":
    sys.exit(main())
