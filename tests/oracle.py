"""Compare a registered query with its SQL counterpart in DuckDB."""

import math
import os

import duckdb


def norm(v):
    if isinstance(v, bool) or v is None:
        return v
    if isinstance(v, float):
        return "nan" if math.isnan(v) else float(f"{v:.9g}")
    if isinstance(v, (list, tuple)):
        return tuple(norm(x) for x in v)
    return v


def rows_of(df):
    names = sorted(df.columns)
    return names, sorted((tuple(norm(r[c]) for c in names) for r in df.collect()), key=repr)


def duck(sql, sf_dir):
    con = duckdb.connect()
    for f in os.listdir(sf_dir):
        con.execute(f"CREATE VIEW {f.removesuffix('.parquet')} AS SELECT * FROM '{sf_dir}/{f}'")
    r = con.execute(sql)
    names = [c[0] for c in r.description]
    order = sorted(names)
    return order, sorted((tuple(norm(x[names.index(c)]) for c in order) for x in r.fetchall()), key=repr)
