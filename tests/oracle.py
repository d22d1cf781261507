"""Runs named queries beside their SQL and compares columns and rows."""

from __future__ import annotations

import sys
import time
from collections import Counter
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES.split():
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def plain(value):
    if value is None or isinstance(value, (bool, str)):
        return value
    if isinstance(value, (int, float)) or type(value).__name__ == "Decimal":
        return round(float(value), 9) + 0.0
    return str(value)


def rows(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(plain(r[i]) for i in order) for r in data)


def compare(spark, con, name: str, fn, sql: str | None, sf_dir: str) -> str | None:
    """None if equal, else what differs."""
    df = fn(spark, sf_dir)
    got = rows(df.columns, [tuple(r) for r in df.collect()])
    if sql is None:
        return None if got else "no rows"
    cur = con.execute(sql)
    columns = [d[0] for d in cur.description]
    if sorted(columns) != sorted(df.columns):
        return f"columns {sorted(df.columns)} against {sorted(columns)}"
    want = rows(columns, cur.fetchall())
    if got == want:
        return None if got else "no rows"
    extra, lacking = got - want, want - got
    return f"{sum(got.values())} against {sum(want.values())} rows; only spark {list(extra)[:2]}; only sql {list(lacking)[:2]}"


if __name__ == "__main__":
    import __spark_entry__ as entry
    from caseloom.session import local_session

    sf_dir = sys.argv[1]
    wanted = sys.argv[2:]
    spark = local_session(8, partitions=8)
    con = connect(sf_dir)
    sqls = entry.oracle_sql()
    bad = 0
    for name, fn in entry.queries().items():
        if wanted and not any(name.startswith(w) for w in wanted):
            continue
        start = time.time()
        try:
            problem = compare(spark, con, name, fn, sqls.get(name), sf_dir)
        except Exception as e:
            problem = f"{type(e).__name__}: {str(e)[:900]}"
        bad += problem is not None
        kind = "sql" if name in sqls else "rows"
        print(f"{'ok ' if problem is None else 'BAD'} {kind:4} {time.time() - start:6.2f}s {name} {problem or ''}", flush=True)
    print("failed:", bad)
