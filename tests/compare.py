"""Run registered queries in Spark and DuckDB and compare them row by row.

    python tests/compare.py /root/testdata/sf0.01 [name-part ...]
"""

from __future__ import annotations

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _cell(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return (0, "")
    if isinstance(v, bool):
        return (1, str(v))
    if isinstance(v, (int, float)) or type(v).__name__ == "Decimal":
        return (2, f"{float(v):.9g}")
    return (3, str(v))


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], sorted(tuple(_cell(r[i]) for i in order) for r in rows)


def compare(spark, con, sf_dir, query, sql):
    df = query(spark, sf_dir)
    got_names, got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    plan = df._jdf.queryExecution().executedPlan().toString()
    if "NestedLoop" in plan or "Cartesian" in plan:
        return "the plan has a nested-loop join", len(got)
    cur = con.execute(sql)
    want_names, want = rows_of([c[0] for c in cur.description], cur.fetchall())
    if got_names != want_names:
        return f"columns {got_names} != {want_names}", len(got)
    if len(got) != len(want):
        return f"row count {len(got)} != {len(want)}", len(got)
    bad = [(a, b) for a, b in zip(got, want) if a != b]
    if bad:
        return f"{len(bad)} rows differ, first:\n  spark {bad[0][0]}\n  sql   {bad[0][1]}", len(got)
    return None, len(got)


def main() -> int:
    sf_dir, parts = sys.argv[1], sys.argv[2:]
    from vintagelake import session
    from vintagelake.checks import registry

    spark = session.build("local[8]")
    con = connect(sf_dir)
    queries, oracles = registry.queries(), registry.oracle_sql()
    failed = 0
    for name, query in queries.items():
        if parts and not any(p in name for p in parts):
            continue
        t = time.time()
        try:
            if name in oracles:
                problem, n = compare(spark, con, sf_dir, query, oracles[name])
            else:
                problem, n = None, query(spark, sf_dir).count()
        except Exception as e:  # noqa: BLE001
            problem, n = f"{type(e).__name__}: {str(e)[:700]}", 0
        failed += problem is not None
        state = "FAIL" if problem else ("ok" if name in oracles else "ran")
        if problem or not parts or True:
            print(f"{state:4} {name} rows={n} {time.time() - t:.1f}s {problem or ''}", flush=True)
    print(f"{failed} failed")
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main())
