"""Comparison of a Spark result with the same query in DuckDB."""

import glob
import os

import duckdb


def connect(sf_dir):
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _sorted_rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(r[i] for i in order) for r in rows), key=repr)


def spark_rows(df):
    return sorted(df.columns), _sorted_rows(df.columns, [tuple(r) for r in df.collect()])


def sql_rows(con, sql):
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    return sorted(names), _sorted_rows(names, result.fetchall())


def difference(df, con, sql):
    """None if both give the same rows, else a short description."""
    names, rows = spark_rows(df)
    expected_names, expected = sql_rows(con, sql)
    if names != expected_names:
        return f"columns {names} != {expected_names}"
    if rows != expected:
        here, there = set(rows) - set(expected), set(expected) - set(rows)
        return f"{names}\n{len(rows)} rows against {len(expected)}; only Spark {sorted(here, key=repr)[:3]}; only SQL {sorted(there, key=repr)[:3]}"
    return None if rows else "no rows"
