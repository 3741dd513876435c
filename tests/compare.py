"""Order-free comparison of a Spark result with DuckDB's."""

import math

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{sf_dir}/{t}.parquet')")
    return con


def cell(x) -> str:
    if x is None or (isinstance(x, float) and math.isnan(x)):
        return "NULL"
    if isinstance(x, float):
        return f"{x:.9g}"
    return str(x)


def rows(names: list[str], values) -> list[tuple]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(cell(v[i]) for i in order) for v in values)


def assert_same(df, con, sql: str) -> None:
    got = con.execute(sql)
    names = [d[0] for d in got.description]
    assert sorted(df.columns) == sorted(names)
    assert rows(df.columns, df.collect()) == rows(names, got.fetchall())
