"""Comparison of a query with its SQL twin in DuckDB."""

import decimal
import math

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _key(row):
    return tuple((x is None, str(x) if not isinstance(x, int | float) else "", float(x) if isinstance(x, int | float) and x is not None else 0.0) for x in row)


def _plain(row):
    return tuple(float(x) if isinstance(x, decimal.Decimal) else x for x in row)


def same(a, b):
    if isinstance(a, float) and isinstance(b, float | int):
        return math.isclose(a, b, rel_tol=1e-6, abs_tol=1e-5)
    return a == b


def assert_same(df, con, sql):
    cols = sorted(df.columns)
    rel = con.sql(sql)
    assert sorted(rel.columns) == cols
    got = sorted(map(_plain, map(tuple, df.select(*cols).collect())), key=_key)
    want = sorted(map(_plain, rel.select(*[f'"{c}"' for c in cols]).fetchall()), key=_key)
    assert len(got) == len(want)
    for g, w in zip(got, want, strict=True):
        assert all(same(x, y) for x, y in zip(g, w, strict=True)), (cols, g, w)
