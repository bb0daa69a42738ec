"""Runs a query's SQL in DuckDB and holds both results against each other."""

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def _plain(v):
    if v is None or v != v:
        return None
    return float(v) if isinstance(v, float) else v


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda k: columns[k])
    return sorted((tuple(_plain(r[k]) for k in order) for r in rows), key=repr)


def same(df, sql, sf):
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    want = con.sql(sql)
    assert sorted(df.columns) == sorted(want.columns)
    got, expected = _rows(df.columns, [tuple(r) for r in df.collect()]), _rows(want.columns, want.fetchall())
    assert len(got) == len(expected)
    assert got == expected
