"""Compares a query with its SQL in DuckDB, column by column, without regard to row order."""

from __future__ import annotations

import datetime
import decimal
import os

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def plain(v):
    if isinstance(v, (float, decimal.Decimal)):
        return None if v != v else round(float(v), 6) + 0.0
    if isinstance(v, (list, tuple)):
        return tuple(map(plain, v))
    if isinstance(v, (datetime.date, datetime.datetime)):
        return str(v)
    return v


def table(rows, columns):
    order = sorted(range(len(columns)), key=lambda k: columns[k])
    return sorted((tuple(plain(r[k]) for k in order) for r in rows), key=lambda r: tuple((x is not None, str(x)) for x in r))


def connect(sf_dir):
    import duckdb

    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p + '/*.parquet' if os.path.isdir(p) else p}')")
    return con


def compare(df, con, sql):
    cur = con.execute(sql)
    names = [c[0] for c in cur.description]
    assert sorted(df.columns) == sorted(names)
    assert table(map(tuple, df.collect()), df.columns) == table(cur.fetchall(), names)
