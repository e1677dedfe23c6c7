"""Comparison of a query's rows with those of its SQL in DuckDB."""

import decimal
import math
import os

import duckdb


def connect(folder):
    con = duckdb.connect()
    for entry in os.listdir(folder):
        con.execute(f"CREATE VIEW {entry.split('.')[0]} AS SELECT * FROM read_parquet('{folder}/{entry}')")
    return con


def plain(value):
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, decimal.Decimal):
        value = float(value)
    if isinstance(value, (float, int)):
        return "nan" if math.isnan(value) else float(f"{float(value):.6g}") + 0.0
    return str(value)


def table(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    key = lambda row: [(v is None, str(type(v)), v if v is not None else 0) for v in row]
    return [columns[i] for i in order], sorted((tuple(plain(r[i]) for i in order) for r in rows), key=key)


def near(a, b):
    if isinstance(a, float) and isinstance(b, float):
        return math.isclose(a, b, rel_tol=2e-5, abs_tol=2e-6)
    return a == b


def compare(df, con, sql):
    found = table(df.columns, df.collect())
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    wanted = table(names, cursor.fetchall())
    assert found[0] == wanted[0]
    assert len(found[1]) == len(wanted[1])
    for a, b in zip(found[1], wanted[1]):
        assert all(map(near, a, b)), (a, b)
