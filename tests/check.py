"""Run registered queries against their DuckDB twins: python tests/check.py [sf] [name ...]."""

from __future__ import annotations

import os
import sys
import time
import traceback

import duckdb
import numpy as np

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
import __spark_entry__ as entry  # noqa: E402
from pyspark.sql import SparkSession  # noqa: E402

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def session() -> SparkSession:
    spark = (SparkSession.builder.master("local[8]").appName("check")
             .config("spark.sql.shuffle.partitions", "8").config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
             .config("spark.driver.memory", "12g").config("spark.sql.session.timeZone", "UTC").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    return con


def canon(v):
    if v is None:
        return "~"
    if isinstance(v, (bool, np.bool_)):
        return str(bool(v))
    if isinstance(v, float):
        return repr(v)
    if isinstance(v, (list, tuple, np.ndarray)):
        return "[" + ",".join(map(canon, v)) + "]"
    if isinstance(v, dict):
        return "{" + ",".join(f"{k}:{canon(x)}" for k, x in sorted(v.items())) + "}"
    return str(v)


def rows_of(cols: list[str], rows) -> list[tuple]:
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(tuple(canon(r[i]) for i in order) for r in rows)


def compare(spark, con, folder: str, name: str) -> str:
    t0 = time.time()
    df = entry.queries()[name](spark, folder)
    got = [tuple(r) for r in df.collect()]
    t1 = time.time()
    sql = entry.oracle_sql().get(name)
    if sql is None:
        return f"rows {len(got)} ({t1 - t0:.1f}s, no twin)"
    cur = con.execute(sql)
    cols = [d[0] for d in cur.description]
    want = cur.fetchall()
    if sorted(cols) != sorted(df.columns):
        return f"FAIL columns {sorted(df.columns)} != {sorted(cols)}"
    a, b = rows_of(df.columns, got), rows_of(cols, want)
    if a == b:
        note = "" if a else " EMPTY"
        return f"ok {len(a)} rows ({t1 - t0:.1f}s spark, {time.time() - t1:.1f}s duckdb){note}"
    sa, sb = set(a), set(b)
    return (f"FAIL rows {len(a)} vs {len(b)}; only spark {len(sa - sb)}: {str(sorted(sa - sb)[:2])[:400]}; "
            f"only duckdb {len(sb - sa)}: {str(sorted(sb - sa)[:2])[:400]}; cols {sorted(cols)}")


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "0.01"
    folder = f"/root/testdata/sf{sf}"
    names = sys.argv[2:] or list(entry.queries())
    spark, con = session(), connect(folder)
    bad = 0
    for n in names:
        try:
            out = compare(spark, con, folder, n)
        except Exception as e:  # noqa: BLE001
            out = f"FAIL {type(e).__name__}: {str(e)[:600]}"
            if os.environ.get("TRACE"):
                traceback.print_exc()
        bad += out.startswith("FAIL")
        print(f"{n}: {out}", flush=True)
    print(f"{len(names)} queries, {bad} failed", flush=True)


if __name__ == "__main__":
    main()
