"""Rows of a query and of its DuckDB statement, in one comparable form."""

from __future__ import annotations

from collections import Counter
from pathlib import Path

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
DATA = Path("/root/testdata/sf0.001")


def plain(value):
    if isinstance(value, float):
        return round(value, 6)
    if isinstance(value, list | tuple):
        return tuple(map(plain, value))
    return bytes(value) if isinstance(value, bytearray) else value


def rows_of_sql(statement: str) -> tuple[list[str], Counter]:
    import duckdb

    con = duckdb.connect()
    con.sql("set timezone = 'UTC'")
    for name in TABLES:
        if (DATA / f"{name}.parquet").exists():
            con.sql(f"create view {name} as select * from '{DATA}/{name}.parquet'")
    found = con.sql(statement)
    names = list(found.columns)
    order = sorted(range(len(names)), key=names.__getitem__)
    return sorted(names), Counter(tuple(plain(row[k]) for k in order) for row in found.fetchall())


def rows_of_query(df) -> tuple[list[str], Counter]:
    names = sorted(df.columns)
    return names, Counter(tuple(plain(row[n]) for n in names) for row in df.collect())
