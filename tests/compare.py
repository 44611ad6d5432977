"""Runs a query and its SQL on the same tables and compares the rows."""

from __future__ import annotations

import math
from collections import Counter

import duckdb

TABLES = ("documents", "pages", "conversations", "events", "labels")


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    db = duckdb.connect()
    for name in TABLES:
        db.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return db


def _value(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 6) + 0.0
    return value


def _rows(names, rows) -> tuple[list[str], Counter]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], Counter(tuple(_value(row[i]) for i in order) for row in rows)


def differences(df, db, sql: str) -> list[str]:
    """What differs, in words; empty if the results are equal."""
    result = db.sql(sql)
    spark_names, spark_rows = _rows(df.columns, df.collect())
    sql_names, sql_rows = _rows(result.columns, result.fetchall())
    if spark_names != sql_names:
        return [f"columns {spark_names} and {sql_names}"]
    found = []
    if spark_rows.total() != sql_rows.total():
        found.append(f"{spark_rows.total()} and {sql_rows.total()} rows")
    found += [f"only Spark: {row}" for row in list((spark_rows - sql_rows).elements())[:3]]
    found += [f"only SQL: {row}" for row in list((sql_rows - spark_rows).elements())[:3]]
    return found
