"""Run a query on Spark and its check SQL on DuckDB, and compare the rows."""

from __future__ import annotations

import glob
import os

import duckdb


def check_connection(sf_dir):
    con = duckdb.connect()
    con.sql("SET TimeZone = 'UTC'")
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.sql(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def sorted_rows(rows):
    return sorted(rows, key=lambda row: [(value is not None, str(value)) for value in row])


def spark_rows(df):
    names = sorted(df.columns)
    return names, sorted_rows([tuple(row) for row in df.select(*[f"`{n}`" for n in names]).collect()])


def check_rows(con, sql):
    result = con.sql(sql)
    names = sorted(result.columns)
    order = [result.columns.index(name) for name in names]
    return names, sorted_rows([tuple(row[i] for i in order) for row in result.fetchall()])
