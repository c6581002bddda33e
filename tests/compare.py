"""Comparison of a Spark result with a DuckDB result, order-insensitive, columns by name."""

import datetime
import math

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def duck(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{sf_dir}/{t}.parquet')")
    return con


def plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None).isoformat()
    return v


def rows(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(([plain(r[i]) for i in order] for r in data), key=repr)


def differences(con, df, sql, limit=3):
    """Empty when both agree; else a short account."""
    result = con.execute(sql)
    duck_columns = [d[0] for d in result.description]
    expected = rows(duck_columns, result.fetchall())
    got = rows(df.columns, df.collect())
    if sorted(df.columns) != sorted(duck_columns):
        return f"columns {sorted(df.columns)} != {sorted(duck_columns)}"
    if got == expected:
        return ""
    a, b = {repr(r) for r in got}, {repr(r) for r in expected}
    return (f"rows {len(got)} vs {len(expected)}\ncolumns {sorted(df.columns)}\n"
            f"only spark {sorted(a - b)[:limit]}\nonly sql {sorted(b - a)[:limit]}")
