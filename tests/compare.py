"""Run registered queries and their SQL twins side by side."""

import math

import duckdb

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
          "embeddings", "pages", "benchmark", "labels", "conversations"]


def connect(folder):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    return con


def _value(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    return v


def normal(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(
        (tuple(_value(r[i]) for i in order) for r in rows), key=lambda r: tuple(map(repr, r)))


def difference(spark, con, folder, query, sql):
    """None when both sides agree, else a short account."""
    df = query(spark, folder)
    mine = normal(df.columns, [tuple(r) for r in df.collect()])
    cur = con.execute(sql)
    theirs = normal([c[0] for c in cur.description], cur.fetchall())
    if mine[0] != theirs[0]:
        return f"columns {mine[0]} / {theirs[0]}"
    if mine[1] != theirs[1]:
        a, b = set(mine[1]), set(theirs[1])
        return f"rows {len(mine[1])} / {len(theirs[1])}; only ours {sorted(a - b, key=repr)[:2]}; " \
               f"only theirs {sorted(b - a, key=repr)[:2]}"
    return None if mine[1] else "empty"
