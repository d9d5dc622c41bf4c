"""Runs registered queries against their SQL twins in DuckDB."""

from __future__ import annotations

import glob
import math
import os

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("set TimeZone='UTC'")
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.splitext(os.path.basename(path))[0]
        con.execute(f"create view {name} as select * from read_parquet('{path}')")
    return con


def _sort_key(row: tuple) -> tuple:
    return tuple((value is None, str(value)) for value in row)


def sorted_rows(columns: list[str], rows: list[tuple]) -> tuple[list[str], list[tuple]]:
    """Rows with columns in name order, themselves sorted."""
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    picked = [tuple(row[i] for i in order) for row in rows]
    return [columns[i] for i in order], sorted(picked, key=_sort_key)


SAME_TYPE = {
    "string": "VARCHAR",
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "date": "DATE",
}


def spark_result(df):
    columns, rows = sorted_rows(df.columns, [tuple(r) for r in df.collect()])
    types = {f.name: SAME_TYPE[f.dataType.simpleString()] for f in df.schema.fields}
    return columns, rows, types


def duck_result(con: duckdb.DuckDBPyConnection, sql: str):
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    types = {d[0]: str(d[1]) for d in result.description}
    columns, rows = sorted_rows(names, result.fetchall())
    return columns, rows, types


def has_nan(rows: list[tuple]) -> bool:
    return any(isinstance(v, float) and math.isnan(v) for row in rows for v in row)
