"""Spark's rows and DuckDB's, made comparable."""

import os

import duckdb

DATA = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


def tables(folder=DATA):
    con = duckdb.connect()
    for name in sorted(os.listdir(folder)):
        path = f"{folder}/{name}"
        con.execute(f"CREATE VIEW {name.split('.')[0]} AS SELECT * FROM '{path}{'/*.parquet' if os.path.isdir(path) else ''}'")
    return con


def plain(value):
    if isinstance(value, float):
        return None if value != value else float(f"{value:.9g}")
    if isinstance(value, (list, tuple)):
        return tuple(plain(v) for v in value)
    return bytes(value) if isinstance(value, bytearray) else value


def canonical(names, rows):
    order = sorted(range(len(names)), key=lambda k: names[k])
    return sorted((tuple(plain(r[k]) for k in order) for r in rows), key=repr)


def same(spark, query, sql, folder=DATA):
    df = query(spark, folder)
    cursor = tables(folder).execute(sql)
    names = [d[0] for d in cursor.description]
    assert sorted(df.columns) == sorted(names)
    assert canonical(df.columns, df.collect()) == canonical(names, cursor.fetchall())
