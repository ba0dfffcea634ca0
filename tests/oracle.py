"""Run a Spark query and its DuckDB oracle on the same tables and compare.

Compared: row count, column names (sorted) and the multiset of rows, with
floats rounded to 9 significant digits.
"""

from __future__ import annotations

import math
import os
import sys

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return float(f"{v:.9g}")
    if hasattr(v, "item"):  # numpy scalar
        return _norm(v.item())
    return v


def _rows(cols, records):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm(r[i]) for i in order) for r in records]
    return sorted(out, key=repr)


def oracle_rows(sf_dir: str, sql: str):
    con = duckdb.connect()
    for t in TABLES:
        p = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    cur = con.execute(sql)
    cols = [d[0] for d in cur.description]
    return cols, cur.fetchall()


def compare(spark, name: str, query, sql: str, sf_dir: str) -> tuple[bool, str]:
    df = query(spark, sf_dir)
    s_cols = df.columns
    s_rows = [tuple(r) for r in df.collect()]
    o_cols, o_rows = oracle_rows(sf_dir, sql)
    if sorted(s_cols) != sorted(o_cols):
        return False, f"columns differ: spark {s_cols} oracle {o_cols}"
    if len(s_rows) != len(o_rows):
        return False, f"row count spark {len(s_rows)} oracle {len(o_rows)}"
    a, b = _rows(s_cols, s_rows), _rows(o_cols, o_rows)
    if a != b:
        diff = [(x, y) for x, y in zip(a, b) if x != y][:3]
        return False, f"values differ, e.g. {diff}"
    return True, f"{len(s_rows)} rows"


if __name__ == "__main__":
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    from pyspark.sql import SparkSession

    import __spark_entry__ as entry

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    only = set(sys.argv[2:])
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    qs, sqls = entry.queries(), entry.oracle_sql()
    bad = 0
    for name, q in qs.items():
        if only and name not in only:
            continue
        if name not in sqls:
            n = q(spark, sf_dir).count()
            print(f"{name:28s} rows-only {n}")
            continue
        try:
            ok, msg = compare(spark, name, q, sqls[name], sf_dir)
        except Exception as e:  # noqa: BLE001
            ok, msg = False, f"error {type(e).__name__}: {str(e)[:400]}"
        bad += not ok
        print(f"{name:28s} {'OK ' if ok else 'BAD'} {msg}", flush=True)
    print("failures:", bad)
