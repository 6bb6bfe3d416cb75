"""Run a query on Spark and its SQL on DuckDB and compare columns and rows."""

from __future__ import annotations

import math
from collections import Counter
from pathlib import Path

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
    "labels conversations"
).split()


def connect(folder: str):
    import duckdb

    connection = duckdb.connect()
    for name in TABLES:
        path = Path(folder) / f"{name}.parquet"
        if path.exists():
            connection.execute(f"CREATE VIEW {name} AS FROM read_parquet('{path}')")
    return connection


def _cell(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else float(f"{value:.10g}")
    return value


def _bag(columns: list[str], rows) -> tuple[list[str], Counter]:
    order = sorted(range(len(columns)), key=columns.__getitem__)
    return [columns[i] for i in order], Counter(tuple(_cell(row[i]) for i in order) for row in rows)


def difference(spark_df, connection, sql: str) -> str:
    """Empty if both agree, else what differs."""
    cursor = connection.execute(sql)
    expected = _bag([d[0] for d in cursor.description], cursor.fetchall())
    actual = _bag(spark_df.columns, spark_df.collect())
    if expected[0] != actual[0]:
        return f"columns {actual[0]} instead of {expected[0]}"
    if expected[1] != actual[1]:
        extra, missing = actual[1] - expected[1], expected[1] - actual[1]
        return (
            f"{extra.total()} unexpected, {missing.total()} missing of {expected[1].total()}: "
            f"{list(extra)[:2]} / {list(missing)[:2]}"
        )
    return ""
