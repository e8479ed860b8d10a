"""Run a query and its SQL on the same tables and compare the rows, order aside."""

from __future__ import annotations

import math
import os

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def connect(sf_dir: str):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{os.path.join(sf_dir, t)}.parquet')")
    return con


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(round(v, 6) + 0.0)
    if isinstance(v, bool):
        return str(v)
    return repr(v)


def table(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    names = [columns[i] for i in order]
    return names, sorted(tuple(_norm(r[i]) for i in order) for r in rows)


def compare(spark, con, name, query, sql, sf_dir):
    df = query(spark, sf_dir)
    flat = [t for _, t in df.dtypes if t.startswith(("array", "map", "struct"))]
    assert not flat, f"{name}: nested result types {flat}"
    got = table(df.columns, [tuple(r) for r in df.collect()])
    if sql is None:
        return len(got[1]), None
    cur = con.execute(sql)
    want = table([d[0] for d in cur.description], cur.fetchall())
    if got == want:
        return len(got[1]), None
    if got[0] != want[0]:
        return len(got[1]), f"columns {got[0]} != {want[0]}"
    only_got = sorted(set(got[1]) - set(want[1]))[:3]
    only_want = sorted(set(want[1]) - set(got[1]))[:3]
    return len(got[1]), (f"{len(got[1])} rows vs {len(want[1])}\n  spark only: {only_got}\n"
                         f"  sql only: {only_want}")
