"""Compare queries with their SQL in DuckDB: rows, column names and values.

Run as a script: ``python tests/oracle.py [folder] [query ...]``.
"""

from __future__ import annotations

import datetime
import math
import sys
import time
from pathlib import Path

ROOT = Path(__file__).resolve().parents[1]
if str(ROOT) not in sys.path:
    sys.path.insert(0, str(ROOT))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def connect(folder: str):
    import duckdb
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    return con


def normal(v):
    if v is None:
        return ("", "")
    if isinstance(v, bool):
        return ("b", v)
    if isinstance(v, float):
        return ("", "") if math.isnan(v) else ("n", v + 0.0)
    if isinstance(v, datetime.datetime):
        return ("t", v.replace(tzinfo=None).isoformat())
    if isinstance(v, int):
        return ("n", float(v))
    if type(v).__name__ == "Decimal":
        return ("n", float(v))
    return ("s", str(v))


def rows_of(names: list[str], rows) -> list[tuple]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(normal(r[i]) for i in order) for r in rows), key=str)


def compare(spark, con, name: str, fn, sql: str | None, folder: str) -> str | None:
    """None when equal, else what differs."""
    df = fn(spark, folder)
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    if sql is None:
        return None if got else "no rows"
    res = con.execute(sql)
    names = [d[0] for d in res.description]
    want = rows_of(names, res.fetchall())
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} vs {sorted(names)}"
    if len(got) != len(want):
        return f"{len(got)} rows vs {len(want)}"
    off = [(a, b) for a, b in zip(got, want) if a != b]
    if off:
        a, b = off[0]
        cols = sorted(names)
        return f"{len(off)} rows differ, first: " + "; ".join(
            f"{c}: {x[1]!r} vs {y[1]!r}" for c, x, y in zip(cols, a, b) if x != y)
    return None


def session():
    from pyspark.sql import SparkSession
    spark = (
        SparkSession.builder.master("local[8]").appName("hearthline-tests")
        .config("spark.sql.shuffle.partitions", "8").config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g").config("spark.sql.session.timeZone", "UTC")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def main() -> int:
    import __spark_entry__ as e
    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    queries, oracles = e.queries(), e.oracle_sql()
    names = sys.argv[2:] or list(queries)
    spark, con, bad = session(), connect(folder), 0
    for n in names:
        start = time.time()
        try:
            problem = compare(spark, con, n, queries[n], oracles.get(n), folder)
        except Exception as ex:  # show and go on
            problem = f"{type(ex).__name__}: {str(ex)[:600]}"
        bad += problem is not None
        kind = "sql " if n in oracles else "rows"
        print(f"{'ok  ' if problem is None else 'FAIL'} {kind} {time.time() - start:6.1f}s {n} {problem or ''}", flush=True)
    print(f"{len(names) - bad} of {len(names)} ok")
    return 1 if bad else 0


if __name__ == "__main__":
    raise SystemExit(main())
