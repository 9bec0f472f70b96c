"""Compares a query with its SQL, as multisets of rows with columns by name."""

from pathlib import Path

import duckdb


def views(sf_dir: str):
    c = duckdb.connect()
    c.execute("set timezone = 'UTC'")
    for p in Path(sf_dir).iterdir():
        c.execute(f"create view {p.stem} as select * from '{p}{'/*.parquet' if p.is_dir() else ''}'")
    return c


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(repr(r[i]) if isinstance(r[i], float) else str(r[i]) for i in order) for r in rows)


def assert_equal(df, connection, sql):
    got = connection.execute(sql)
    names = [d[0] for d in got.description]
    assert sorted(df.columns) == sorted(names)
    assert rows_of(df.columns, df.collect()) == rows_of(names, got.fetchall())
