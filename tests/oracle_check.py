"""Compare registered queries with their DuckDB oracles.

    python tests/oracle_check.py [--sf 0.001] [name ...]
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def plain(v):
    if isinstance(v, bool) or v is None:
        return v
    if isinstance(v, decimal.Decimal):
        return float(v)
    if isinstance(v, float):
        return None if math.isnan(v) else float(f"{v:.9g}")
    if isinstance(v, dt.datetime):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(plain(x) for x in v)
    return v


def rows_of(names: list[str], rows) -> tuple[list[str], list[tuple]]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    out = [tuple(plain(r[i]) for i in order) for r in rows]
    return [names[i] for i in order], sorted(out, key=lambda r: tuple((x is not None, str(type(x)), x) for x in r))


def compare(spark, con, sf_dir: str, query, sql: str) -> str | None:
    """None when equal, else what differs."""
    df = query(spark, sf_dir)
    cols, mine = rows_of(df.columns, df.collect())
    rel = con.execute(sql)
    theirs_cols, theirs = rows_of([d[0] for d in rel.description], rel.fetchall())
    if cols != theirs_cols:
        return f"columns {cols} != {theirs_cols}"
    if len(mine) != len(theirs):
        return f"{len(mine)} rows, oracle {len(theirs)}"
    for a, b in zip(mine, theirs):
        if a != b:
            diff = [(c, x, y) for c, x, y in zip(cols, a, b) if x != y]
            return f"values differ: {str(diff)[:600]}"
    return None


def main(argv: list[str]) -> int:
    import __spark_entry__ as entry
    from tests.conftest import make_session

    sf = "0.001"
    if "--sf" in argv:
        i = argv.index("--sf")
        sf = argv[i + 1]
        del argv[i : i + 2]
    sf_dir = f"/root/testdata/sf{sf}"
    queries, oracles = entry.queries(), entry.oracle_sql()
    spark, con = make_session(), connect(sf_dir)
    bad = 0
    for name in [n for n in queries if not argv or any(a in n for a in argv)]:
        start = time.time()
        try:
            if name in oracles:
                problem = compare(spark, con, sf_dir, queries[name], oracles[name])
                n = con.execute(f"SELECT count(*) FROM ({oracles[name]})").fetchone()[0]
            else:
                n, problem = queries[name](spark, sf_dir).count(), None
        except Exception as e:  # reported, and the run goes on
            n, problem = -1, f"{type(e).__name__}: {str(e)[:700]}"
        bad += problem is not None
        print(f"{'ok ' if problem is None else 'BAD'} {name:45s} {n:8d} rows {time.time() - start:6.2f}s {problem or ''}", flush=True)
    print("failures:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1:]) else 0)
