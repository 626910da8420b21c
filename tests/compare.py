"""Compares registered queries with their SQL in DuckDB."""

from __future__ import annotations

from collections import Counter
from pathlib import Path

import duckdb


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for file in sorted(Path(folder).glob("*.parquet")):
        con.execute(f"create view {file.stem} as select * from read_parquet('{file}')")
    return con


def _cell(value):
    return round(value, 6) + 0.0 if isinstance(value, float) else value


def spark_rows(df) -> tuple[list[str], Counter]:
    names = sorted(df.columns)
    return names, Counter(tuple(_cell(row[n]) for n in names) for row in df.collect())


def sql_rows(con, sql: str) -> tuple[list[str], Counter]:
    cursor = con.execute(sql)
    columns = [d[0] for d in cursor.description]
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    rows = cursor.fetchall()
    return [columns[i] for i in order], Counter(
        tuple(_cell(row[i]) for i in order) for row in rows
    )
