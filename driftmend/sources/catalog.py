"""The catalog of namespaces as four DataFrames: tables, columns, primary keys, foreign keys.

One catalog can cover any number of namespaces, so the metadata checks are joins that compare
all their tables in one job.
"""

from __future__ import annotations

from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from driftmend.functions.types import family
from driftmend.sources.contract import Namespace

# The columns of the catalog DataFrames.
_TABLES = pa.schema([("schema", pa.string()), ("table", pa.string())])
_COLUMNS = pa.schema(
    [
        ("schema", pa.string()),
        ("table", pa.string()),
        ("ordinal", pa.int32()),
        ("column", pa.string()),
        ("data_type", pa.string()),
        ("exact_type", pa.string()),
        ("source_type", pa.string()),
        ("nullable", pa.bool_()),
        ("default", pa.string()),
    ]
)
_PRIMARY_KEYS = pa.schema(
    [("schema", pa.string()), ("table", pa.string()), ("position", pa.int32()), ("column", pa.string())]
)
_FOREIGN_KEYS = pa.schema(
    [
        ("schema", pa.string()),
        ("table", pa.string()),
        ("constraint", pa.string()),
        ("position", pa.int32()),
        ("column", pa.string()),
        ("ref_schema", pa.string()),
        ("ref_table", pa.string()),
        ("ref_column", pa.string()),
    ]
)


@dataclass(frozen=True)
class Catalog:
    tables: DataFrame
    columns: DataFrame
    primary_keys: DataFrame
    foreign_keys: DataFrame


def load_catalog(spark: SparkSession, *namespaces: Namespace) -> Catalog:
    """Catalog rows of all namespaces. Only schemas and contracts are read, never a table's rows."""
    tables, columns, primary, foreign = [], [], [], []
    for space in namespaces:
        for name in space.names():
            contract = space.contract(name)
            tables.append((space.schema, name))
            required = {c.lower() for c in (*contract.keys, *contract.required)}
            defaults = {c.lower(): text for c, text in contract.defaults.items()}
            for ordinal, f in enumerate(space.tables[name].schema.fields, start=1):
                columns.append(
                    (
                        space.schema,
                        name,
                        ordinal,
                        f.name,
                        family(f.dataType),
                        f.dataType.simpleString(),
                        f.dataType.simpleString(),
                        f.nullable and f.name.lower() not in required,
                        defaults.get(f.name.lower()),
                    )
                )
            primary += [(space.schema, name, i, key) for i, key in enumerate(contract.keys, start=1)]
            for number, ref in enumerate(contract.references, start=1):
                foreign += [
                    (space.schema, name, f"{name}_fk_{number}", i, column, ref.schema or space.schema, ref.table, ref_column)
                    for i, (column, ref_column) in enumerate(zip(ref.columns, ref.ref_columns, strict=True), start=1)
                ]
    return Catalog(
        _frame(spark, tables, _TABLES),
        _frame(spark, columns, _COLUMNS),
        _frame(spark, primary, _PRIMARY_KEYS),
        _frame(spark, foreign, _FOREIGN_KEYS),
    )


def list_tables(catalog: Catalog, schema: str) -> DataFrame:
    return catalog.tables.where(F.col("schema") == schema).select("table").orderBy("table")


def list_columns(catalog: Catalog, schema: str, table: str | None = None) -> DataFrame:
    """Columns in ordinal order, of one table or of all."""
    found = _of(catalog.columns, schema, table)
    return found.select("table", "ordinal", "column", "data_type", "nullable", "default").orderBy("table", "ordinal")


def list_primary_keys(catalog: Catalog, schema: str, table: str | None = None) -> DataFrame:
    return _of(catalog.primary_keys, schema, table).select("table", "position", "column").orderBy("table", "position")


def list_foreign_keys(catalog: Catalog, schema: str, table: str | None = None) -> DataFrame:
    """One row per reference and position; composite references pair their columns by position."""
    return (
        _of(catalog.foreign_keys, schema, table)
        .select("table", "constraint", "position", "column", "ref_schema", "ref_table", "ref_column")
        .orderBy("table", "constraint", "position")
    )


def table_exists(catalog: Catalog, schema: str, names: DataFrame) -> DataFrame:
    """Those rows of ``names(table)`` that name a table of the schema, exact case."""
    return names.join(catalog.tables.where(F.col("schema") == schema).select("table"), on="table", how="left_semi")


def _of(rows: DataFrame, schema: str, table: str | None) -> DataFrame:
    rows = rows.where(F.col("schema") == schema)
    return rows if table is None else rows.where(F.col("table") == table)


def _frame(spark: SparkSession, rows: list[tuple], schema: pa.Schema) -> DataFrame:
    columns = list(zip(*rows, strict=True)) if rows else [[] for _ in schema]
    arrays = [pa.array(list(c), type=f.type) for c, f in zip(columns, schema, strict=True)]
    return spark.createDataFrame(pa.Table.from_arrays(arrays, schema=schema))
