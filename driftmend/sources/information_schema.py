"""A catalog from the ``information_schema`` relations of a database."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from driftmend.sources.catalog import Catalog
from driftmend.sources.contract import Reference, TableContract

# Database type name -> type family.
SOURCE_FAMILIES: dict[str, str] = {
    "smallint": "smallint",
    "integer": "int",
    "bigint": "bigint",
    "real": "float",
    "double precision": "double",
    "numeric": "decimal",
    "boolean": "boolean",
    "date": "date",
    "text": "string",
    "character varying": "string",
    "character": "string",
    "timestamp without time zone": "timestamp_ntz",
    "timestamp with time zone": "timestamp",
    "bytea": "binary",
    "uuid": "string",
    "json": "string",
    "jsonb": "string",
    "interval": "string",
    "USER-DEFINED": "string",
    "ARRAY": "array",
}

# Short type names, as elements of arrays are named, and their full names.
SHORT_NAMES: dict[str, str] = {
    "int2": "smallint",
    "int4": "integer",
    "int8": "bigint",
    "float4": "real",
    "float8": "double precision",
    "bool": "boolean",
    "varchar": "character varying",
    "bpchar": "character",
    "timestamp": "timestamp without time zone",
    "timestamptz": "timestamp with time zone",
}

# The relations a catalog is built from.
RELATIONS = ("tables", "columns", "table_constraints", "key_column_usage", "referential_constraints")


def exact_type(columns: DataFrame) -> Column:
    """A column's type spelt as Spark spells it, with length, precision, scale and element type where they are told.

    A number without a declared precision is read by Spark as decimal(38,18).
    """
    told = {c.lower() for c in columns.columns}
    number = lambda name: F.col(name).cast("string") if name in told else F.lit(None).cast("string")
    known = F.create_map(*[F.lit(x) for pair in SOURCE_FAMILIES.items() for x in pair])
    long = F.create_map(*[F.lit(x) for pair in SHORT_NAMES.items() for x in pair])
    kind = F.col("data_type")
    length = number("character_maximum_length")
    plain = F.coalesce(known[kind], kind)
    exact = (
        F.when(kind == "numeric", F.concat(F.lit("decimal("), F.coalesce(number("numeric_precision"), F.lit("38")), F.lit(","),
                                           F.coalesce(number("numeric_scale"), F.lit("18")), F.lit(")")))
        .when((kind == "character varying") & length.isNotNull(), F.concat(F.lit("varchar("), length, F.lit(")")))
        .when((kind == "character") & length.isNotNull(), F.concat(F.lit("char("), length, F.lit(")")))
    )
    if "udt_name" in told:
        element = F.ltrim(F.col("udt_name"), F.lit("_"))
        element = F.coalesce(long[element], element)
        element = F.when(element == "numeric", "decimal(38,18)").otherwise(F.coalesce(known[element], element))
        exact = exact.when(kind == "ARRAY", F.concat(F.lit("array<"), element, F.lit(">")))
    return F.coalesce(exact, plain)


def catalog_from_information_schema(
    tables: DataFrame,
    columns: DataFrame,
    table_constraints: DataFrame,
    key_column_usage: DataFrame,
    referential_constraints: DataFrame,
) -> Catalog:
    """Tables and views, columns, keys and references.

    A reference is followed to the unique constraint it points at, in that constraint's own schema,
    and its columns are paired with the referenced ones by position.
    """
    known = F.create_map(*[F.lit(x) for pair in SOURCE_FAMILIES.items() for x in pair])
    usage = key_column_usage.select(
        F.col("constraint_schema").alias("constraint_schema"),
        F.col("constraint_name").alias("constraint_name"),
        F.col("table_schema").alias("schema"),
        F.col("table_name").alias("table"),
        F.col("column_name").alias("column"),
        F.col("ordinal_position").cast("int").alias("position"),
        F.col("position_in_unique_constraint").cast("int").alias("ref_position"),
    )
    kinds = table_constraints.select("constraint_schema", "constraint_name", "constraint_type", "table_schema", "table_name")
    of_kind = usage.join(
        kinds.select(
            "constraint_schema",
            "constraint_name",
            "constraint_type",
            F.col("table_schema").alias("schema"),
            F.col("table_name").alias("table"),
        ),
        on=["constraint_schema", "constraint_name", "schema", "table"],
    )
    parents = usage.select(
        F.col("constraint_schema").alias("unique_constraint_schema"),
        F.col("constraint_name").alias("unique_constraint_name"),
        F.col("position").alias("ref_position"),
        F.col("schema").alias("ref_schema"),
        F.col("table").alias("ref_table"),
        F.col("column").alias("ref_column"),
    )
    links = referential_constraints.select(
        "constraint_schema", "constraint_name", "unique_constraint_schema", "unique_constraint_name"
    )
    foreign = (
        of_kind.where(F.col("constraint_type") == "FOREIGN KEY")
        .join(links, on=["constraint_schema", "constraint_name"])
        .join(parents, on=["unique_constraint_schema", "unique_constraint_name", "ref_position"])
    )
    return Catalog(
        tables=tables.select(F.col("table_schema").alias("schema"), F.col("table_name").alias("table")),
        columns=columns.select(
            F.col("table_schema").alias("schema"),
            F.col("table_name").alias("table"),
            F.col("ordinal_position").cast("int").alias("ordinal"),
            F.col("column_name").alias("column"),
            F.coalesce(known[F.col("data_type")], F.col("data_type")).alias("data_type"),
            exact_type(columns).alias("exact_type"),
            F.col("data_type").alias("source_type"),
            (F.col("is_nullable") == "YES").alias("nullable"),
            F.col("column_default").alias("default"),
        ),
        primary_keys=of_kind.where(F.col("constraint_type") == "PRIMARY KEY").select(
            "schema", "table", "position", "column"
        ),
        foreign_keys=foreign.select(
            "schema",
            "table",
            F.col("constraint_name").alias("constraint"),
            "position",
            "column",
            "ref_schema",
            "ref_table",
            "ref_column",
        ),
    )


def contracts_of(catalog: Catalog, schema: str) -> list[TableContract]:
    """Contracts of one schema. Fetches constraint rows to the driver: metadata, as many as there are key columns."""
    keys: dict[str, list] = {}
    for row in catalog.primary_keys.where(F.col("schema") == schema).toLocalIterator():
        keys.setdefault(row["table"], []).append((row["position"], row["column"]))
    references: dict[tuple[str, str], list] = {}
    for row in catalog.foreign_keys.where(F.col("schema") == schema).toLocalIterator():
        references.setdefault((row["table"], row["constraint"]), []).append(row)
    required: dict[str, list[str]] = {}
    not_null = catalog.columns.where((F.col("schema") == schema) & ~F.col("nullable"))
    for row in not_null.select("table", "column").toLocalIterator():
        required.setdefault(row["table"], []).append(row["column"])
    by_table: dict[str, list[Reference]] = {}
    for (table, _), rows in sorted(references.items()):
        rows.sort(key=lambda r: r["position"])
        by_table.setdefault(table, []).append(
            Reference(
                tuple(r["column"] for r in rows),
                rows[0]["ref_table"],
                tuple(r["ref_column"] for r in rows),
                rows[0]["ref_schema"],
            )
        )
    return [
        TableContract(
            name,
            keys=tuple(c for _, c in sorted(keys.get(name, []))),
            references=tuple(by_table.get(name, [])),
            required=tuple(required.get(name, [])),
        )
        for name in sorted({*keys, *by_table, *required})
    ]
