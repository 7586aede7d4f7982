"""Run a query and its SQL on the same files and compare the rows as bags."""

from __future__ import annotations

import datetime
import decimal
import math
from collections import Counter

import duckdb

from checks.tables import TABLES


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return connection


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 9)
    if isinstance(value, decimal.Decimal):
        return str(value.normalize())
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, (list, tuple)):
        return tuple(plain(v) for v in value)
    return value


def bag(columns, rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(plain(row[i]) for i in order) for row in rows)


def differences(spark, name, build, sql, sf_dir, connection) -> str | None:
    """What differs, or None."""
    result = build(spark, sf_dir)
    rows = [tuple(r) for r in result.collect()]
    cursor = connection.execute(sql)
    columns = [d[0] for d in cursor.description]
    expected = cursor.fetchall()
    if sorted(result.columns) != sorted(columns):
        return f"{name}: columns {sorted(result.columns)} instead of {sorted(columns)}"
    ours, theirs = bag(result.columns, rows), bag(columns, expected)
    if ours != theirs:
        surplus, lacking = ours - theirs, theirs - ours
        return (
            f"{name}: {len(rows)} rows instead of {len(expected)}; "
            f"surplus {list(surplus.items())[:3]}; lacking {list(lacking.items())[:3]}"
        )
    return None
