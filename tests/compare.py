"""Run a query on Spark and its SQL on DuckDB, and compare the rows as a bag."""

from __future__ import annotations

import math
from collections import Counter
from pathlib import Path
from typing import Any

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        path = Path(sf_dir) / f"{name}.parquet"
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def plain(value: Any) -> Any:
    """The value with its type, so that 1 and 1.0 or a date and a timestamp differ."""
    if isinstance(value, float) and math.isnan(value):
        return ("float", "NaN")
    return (type(value).__name__, value)


def bag(rows: list[tuple], columns: list[str]) -> Counter:
    order = sorted(range(len(columns)), key=columns.__getitem__)
    return Counter(tuple(plain(row[i]) for i in order) for row in rows)


def spark_bag(df) -> tuple[list[str], Counter]:
    return sorted(df.columns), bag([tuple(r) for r in df.collect()], df.columns)


def oracle_bag(con: duckdb.DuckDBPyConnection, sql: str) -> tuple[list[str], Counter]:
    done = con.execute(sql)
    columns = [c[0] for c in done.description]
    return sorted(columns), bag(done.fetchall(), columns)
