"""A query's rows against its SQL in DuckDB."""

import math

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else float(f"{value:.9g}")
    if isinstance(value, dict):
        return tuple(plain(v) for v in value.values())
    return tuple(plain(v) for v in value) if isinstance(value, list | tuple) else value


def compare(query, sql, spark, sf_dir):
    """Fails unless both have the same columns and rows, in any order."""
    got = query(spark, sf_dir)
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    found = con.execute(sql)
    names = [d[0] for d in found.description]
    assert sorted(names) == sorted(got.columns)
    order = [names.index(c) for c in got.columns]
    want = sorted((tuple(plain(row[k]) for k in order) for row in found.fetchall()), key=repr)
    assert sorted((tuple(plain(v) for v in row) for row in got.collect()), key=repr) == want
