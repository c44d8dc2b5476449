"""Compare a report with its SQL, run in-process by DuckDB."""

from __future__ import annotations

import glob
import math
import os

import duckdb

DATA = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


def oracle_connection(folder: str = DATA):
    con = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def _cell(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return (0, "")
    if isinstance(value, bool):
        return (1, int(value))
    if isinstance(value, (int, float)):
        return (1, float(value))
    return (2, str(value))


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted(tuple(_cell(row[i]) for i in order) for row in rows)


def spark_rows(df):
    return rows_of(df.columns, [tuple(r) for r in df.collect()])


def sql_rows(con, text):
    cursor = con.execute(text)
    return rows_of([d[0] for d in cursor.description], cursor.fetchall())
