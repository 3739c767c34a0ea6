"""Compare a Spark result with DuckDB's, in any order."""

import decimal
import math

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def plain(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    if isinstance(v, bool):
        return v
    if isinstance(v, decimal.Decimal):
        return float(v)
    if isinstance(v, int):
        return float(v) if abs(v) < 2**53 else v
    return round(v, 9) if isinstance(v, float) else v


def rows_of(names, rows):
    order = sorted(range(len(names)), key=names.__getitem__)
    return sorted(([plain(r[i]) for i in order] for r in rows), key=str)


def duck(sf_dir, sql):
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    out = con.sql(sql)
    return out.columns, out.fetchall()


def same(df, sf_dir, sql):
    names, rows = duck(sf_dir, sql)
    assert sorted(names) == sorted(df.columns)
    assert rows_of(df.columns, [tuple(r) for r in df.collect()]) == rows_of(names, rows)
