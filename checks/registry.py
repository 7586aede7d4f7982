"""Collects each query together with its SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from checks.tables import Tables

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None) -> Callable:
    """Register a function of the tables under its name, with the SQL that must give the same rows."""

    def register(build: Callable[[Tables], DataFrame]) -> Callable:
        QUERIES[build.__name__] = lambda spark, sf_dir: build(Tables(spark, sf_dir))
        if sql is not None:
            ORACLES[build.__name__] = sql
        return build

    return register
