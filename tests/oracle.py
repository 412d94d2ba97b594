"""A query and its oracle text over the same tables, compared as multisets of rows."""

import datetime
import decimal

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(sf):
    con = duckdb.connect()
    con.execute("set timezone='UTC'")
    for name in TABLES:
        con.execute(f"create view {name} as select * from '{sf}/{name}.parquet'")
    return con


def plain(v):
    if v is None:
        return "NULL"
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, (float, decimal.Decimal)):
        return f"{float(v):.6g}"
    if isinstance(v, int):
        return f"{v}" if abs(v) > 10**6 else f"{float(v):.6g}"
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(map(plain, v)) + "]"
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None).isoformat()
    return str(v)


def rows_of(df, columns):
    return sorted(tuple(plain(r[c]) for c in columns) for r in df.collect())


def oracle_rows(con, sql, columns):
    found = con.execute(sql)
    names = [d[0] for d in found.description]
    assert sorted(names) == list(columns), (sorted(names), columns)
    order = [names.index(c) for c in columns]
    return sorted(tuple(plain(r[i]) for i in order) for r in found.fetchall())
