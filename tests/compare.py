"""Compare a Spark result with a DuckDB result, whatever the row and column order."""

import datetime
import math
import os

import duckdb


def duck(sf_dir):
    con = duckdb.connect()
    for name in sorted(os.listdir(sf_dir)):
        con.execute(f"CREATE VIEW {name.removesuffix('.parquet')} AS SELECT * FROM '{sf_dir}/{name}'")
    return con


def normal(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else f"f{value:.9g}"
    if isinstance(value, (datetime.date, datetime.datetime)):
        return value.isoformat()
    if isinstance(value, (list, tuple)):
        return str([normal(v) for v in value])
    return type(value).__name__ + str(value)


def spark_rows(df):
    columns = sorted(df.columns)
    return columns, sorted(tuple(normal(v) for v in r) for r in df.select(*columns).collect())


def duck_rows(con, sql):
    found = con.execute(sql)
    names = [d[0] for d in found.description]
    order = sorted(range(len(names)), key=names.__getitem__)
    return sorted(names), sorted(tuple(normal(r[i]) for i in order) for r in found.fetchall())
