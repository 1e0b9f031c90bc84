"""Rows of a query and of its SQL, made comparable."""

import math

import duckdb
import pyarrow as pa
import pyarrow.dataset as ds

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def plain(x):
    if x is None or isinstance(x, float) and math.isnan(x):
        return None
    if isinstance(x, float):
        return round(x, 6)
    if isinstance(x, (list, tuple)):
        return tuple(plain(v) for v in x)
    if hasattr(x, "to_pydatetime"):
        x = x.to_pydatetime()
    if hasattr(x, "tzinfo") and x.tzinfo is not None:
        x = x.replace(tzinfo=None)
    return x


def rows(table: pa.Table):
    names = sorted(table.column_names)
    return names, sorted((tuple(plain(v) for v in r) for r in zip(*[table.column(n).to_pylist() for n in names])), key=repr)


def by_sql(sql: str, sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{sf_dir}/{t}.parquet')")
    got = con.execute(sql)
    names = [d[0] for d in got.description]
    data = got.fetchall()
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], sorted((tuple(plain(r[i]) for i in order) for r in data), key=repr)


def by_spark(df):
    return rows(df.toArrow())
