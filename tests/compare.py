"""Comparison of a Spark result with the rows of a SQL engine."""

from __future__ import annotations

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages"
    " benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return con


def _text(value) -> str:
    if value is None:
        return "null"
    if isinstance(value, float):
        return repr(0.0 if value == 0 else value)
    return str(value)


def canonical(columns: list[str], rows) -> list[tuple[str, ...]]:
    order = sorted(range(len(columns)), key=lambda n: columns[n])
    return sorted(tuple(_text(row[n]) for n in order) for row in rows)


def differences(df, con: duckdb.DuckDBPyConnection, sql: str) -> str:
    """Empty if both sides hold the same rows, else a short description."""
    result = con.execute(sql)
    columns = [part[0] for part in result.description]
    wanted = canonical(columns, result.fetchall())
    if sorted(columns) != sorted(df.columns):
        return f"columns {sorted(df.columns)} and {sorted(columns)}"
    found = canonical(df.columns, df.collect())
    if found == wanted:
        return ""
    missing = sorted(set(wanted) - set(found))[:3]
    extra = sorted(set(found) - set(wanted))[:3]
    return f"{len(found)} rows for {len(wanted)}; missing {missing}; extra {extra}"
