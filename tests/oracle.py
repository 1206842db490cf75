"""Compare a Spark result with DuckDB's on the same Parquet tables."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for file in sorted(Path(sf_dir).glob("*.parquet")):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM read_parquet('{file}')")
    return con


def _key(row: tuple) -> tuple:
    return tuple((v is None, str(type(v)), v if v is not None else "") for v in row)


def normalized(columns: list[str], rows: list[tuple]) -> tuple[list[str], list[tuple]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    assert not any(isinstance(v, float) and math.isnan(v) for row in rows for v in row)
    return [columns[i] for i in order], sorted(
        (tuple(row[i] for i in order) for row in rows), key=_key
    )


def spark_result(df) -> tuple[list[str], list[tuple]]:
    return normalized(df.columns, [tuple(row) for row in df.collect()])


def duckdb_result(con, sql: str) -> tuple[list[str], list[tuple]]:
    cursor = con.execute(sql)
    return normalized([d[0] for d in cursor.description], cursor.fetchall())
