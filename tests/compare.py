"""Compare a query with its SQL twin in DuckDB: column names, row count and all values, in any order."""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from __spark_entry__ import oracle_sql, queries  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def plain(value):
    return "nan" if isinstance(value, float) and math.isnan(value) else repr(value)


def rows_of(names, rows):
    at = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(plain(r[i]) for i in at) for r in rows)


def differences(spark, con, name, sf_dir):
    df = queries()[name](spark, sf_dir)
    got = df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    for word in ("CartesianProduct", "NestedLoopJoin"):
        if word in plan:
            return len(got), f"plan has {word}"
    if name not in oracle_sql():
        return len(got), None if got else "no rows"
    rel = con.sql(oracle_sql()[name])
    want = rel.fetchall()
    if sorted(df.columns) != sorted(rel.columns):
        return len(got), f"columns {sorted(df.columns)} vs {sorted(rel.columns)}"
    a, b = rows_of(df.columns, got), rows_of(rel.columns, want)
    if a != b:
        only_a, only_b = sorted(set(a) - set(b))[:3], sorted(set(b) - set(a))[:3]
        return len(got), f"{len(a)} vs {len(b)} rows; spark {only_a}; sql {only_b}"
    types = [(f.name, f.dataType.simpleString()) for f in df.schema]
    sql_types = dict(zip(rel.columns, map(str, rel.types)))
    odd = [(n, t, sql_types[n]) for n, t in types if "HUGEINT" in sql_types[n] or "DECIMAL" in sql_types[n]]
    return len(got), f"types {odd}" if odd else None


if __name__ == "__main__":
    from loomtext.session import local_session

    sf_dir = sys.argv[1]
    names = sys.argv[2:] or list(queries())
    spark, con = local_session(), connect(sf_dir)
    bad = 0
    for name in names:
        start = time.time()
        try:
            n, problem = differences(spark, con, name, sf_dir)
        except Exception as e:  # noqa: BLE001 - the table of results goes on
            n, problem = -1, f"{type(e).__name__}: {str(e)[:700]}"
        bad += problem is not None
        print(f"{'ok  ' if problem is None else 'FAIL'} {name:32s} {n:8d} rows {time.time() - start:6.1f} s  {problem or ''}", flush=True)
    print("failed:", bad)
