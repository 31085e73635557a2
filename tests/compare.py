"""Run registered queries next to their SQL and compare columns, types and rows."""

from __future__ import annotations

import math
import sys
import time
from decimal import Decimal

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()
KINDS = {
    "BIGINT": "bigint", "INTEGER": "int", "VARCHAR": "string", "DOUBLE": "double", "BOOLEAN": "boolean",
    "DATE": "date", "TIMESTAMP": "timestamp_ntz", "FLOAT": "float",
}


def connect(folder: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from read_parquet('{folder}/{name}.parquet')")
    return con


def plain(v):
    if isinstance(v, (list, tuple)):
        return tuple(plain(x) for x in v)
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 9) + 0.0
    if isinstance(v, Decimal):
        return round(float(v), 9)
    return v


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


def difference(df, con, sql) -> str | None:
    """None if equal, else what differs."""
    rel = con.sql(sql)
    kinds = {c: KINDS.get(str(t), str(t)) for c, t in zip(rel.columns, rel.types)}
    mine = dict(df.dtypes)
    if kinds != mine:
        return f"columns: spark {sorted(mine.items())} sql {sorted(kinds.items())}"
    a = rows_of(df.columns, [tuple(r) for r in df.collect()])
    b = rows_of(rel.columns, rel.fetchall())
    if len(a) != len(b):
        return f"rows: spark {len(a)} sql {len(b)}"
    wrong = [(x, y) for x, y in zip(a, b) if x != y]
    if wrong:
        x, y = wrong[0]
        return f"{len(wrong)} of {len(a)} rows differ, first:\n   spark {str(x)[:600]}\n   sql   {str(y)[:600]}"
    return None if a else "no rows"


if __name__ == "__main__":
    import __spark_entry__ as entry
    from tests.conftest import make_session

    folder, *wanted = sys.argv[1:]
    spark = make_session()
    con = connect(folder)
    queries, oracles = entry.queries(), entry.oracle_sql()
    bad = 0
    for name, fn in queries.items():
        if wanted and not any(w in name for w in wanted):
            continue
        start = time.time()
        try:
            if name in oracles:
                found = difference(fn(spark, folder), con, oracles[name])
            else:
                n = fn(spark, folder).count()
                found = f"rows only: {n}" if n else "no rows"
        except Exception as e:
            found = f"{type(e).__name__}: {str(e)[:700]}"
        if found and not found.startswith("rows only"):
            bad += 1
        print(f"{name:40s} {time.time() - start:5.1f}s {found or 'ok'}", flush=True)
    print("bad:", bad)
