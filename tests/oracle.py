"""Comparison of a query with its SQL counterpart in DuckDB."""

from __future__ import annotations

import math
from collections import Counter

import duckdb

TABLES = """
    region nation customer supplier part orders lineitem events documents embeddings
    pages benchmark labels conversations
""".split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(
            f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')"
        )
    return connection


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else float(f"{value:.12g}") + 0.0
    return value


def rows_of(names: list[str], rows) -> Counter:
    order = sorted(range(len(names)), key=names.__getitem__)
    return Counter(tuple((type(r[i]).__name__, plain(r[i])) for i in order) for r in rows)


def differences(df, connection, sql: str) -> str | None:
    """None when both give the same columns and the same rows, else a description."""
    result = connection.execute(sql)
    names = [d[0] for d in result.description]
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} against {sorted(names)}"
    expected = rows_of(names, result.fetchall())
    found = rows_of(df.columns, df.collect())
    if expected == found:
        return None
    return (
        f"{sum(found.values())} rows against {sum(expected.values())}; "
        f"only here {list((found - expected).items())[:3]}; "
        f"only there {list((expected - found).items())[:3]}"
    )
