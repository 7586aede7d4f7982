"""Catalog and schema queries. Each joins what the catalog says to counts on the whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

import driftmend as dm
from checks.registry import query
from checks.sql import GIVEN_ORDERS, counted_columns, union_all
from checks.tables import KEYS, REFERENCES, TABLES, Tables
from driftmend.functions.display import key_text
from driftmend.functions.frames import stacked
from driftmend.operators import schema_audit

_N_ROWS = union_all([f"SELECT '{t}' AS table_name, count(*) AS n_rows FROM {t}" for t in TABLES])


@query(_N_ROWS)
def list_tables(t: Tables) -> DataFrame:
    space = t.namespace()
    counts = dm.column_facts(space, {name: [] for name in space.names()})
    found = dm.list_tables(dm.load_catalog(t.spark, space), "main")
    return found.join(counts, on="table").select(F.col("table").alias("table_name"), "n_rows")


@query(f"SELECT table_name, position, column_name, data_type, TRUE AS nullable, n_rows, null_count FROM ({counted_columns()})")
def list_columns(t: Tables) -> DataFrame:
    space = t.namespace(contracts=())
    found = dm.list_columns(dm.load_catalog(t.spark, space), "main")
    return found.join(dm.column_facts(space), on=["table", "column"]).select(
        F.col("table").alias("table_name"),
        F.col("ordinal").cast("bigint").alias("position"),
        F.col("column").alias("column_name"),
        "data_type",
        "nullable",
        "n_rows",
        "null_count",
    )


@query(
    union_all(
        [
            f"SELECT '{table}' AS table_name, CAST({i} AS BIGINT) AS position, '{key}' AS column_name, n_rows, n_keys "
            f"FROM (SELECT count(*) AS n_rows, (SELECT count(*) FROM (SELECT DISTINCT {', '.join(keys)} FROM {table})) AS n_keys "
            f"FROM {table})"
            for table, keys in KEYS.items()
            for i, key in enumerate(keys, start=1)
        ]
    )
)
def list_primary_keys(t: Tables) -> DataFrame:
    """The declared keys, each with the number of rows and of distinct keys it has."""
    space = t.namespace()
    profiles = [
        dm.key_profile(space.tables[name], keys).select(F.lit(name).alias("table"), "rows", "distinct_keys")
        for name, keys in KEYS.items()
    ]
    found = dm.list_primary_keys(dm.load_catalog(t.spark, space), "main")
    return found.join(stacked(profiles), on="table").select(
        F.col("table").alias("table_name"),
        F.col("position").cast("bigint").alias("position"),
        F.col("column").alias("column_name"),
        F.col("rows").alias("n_rows"),
        F.col("distinct_keys").alias("n_keys"),
    )


@query(
    union_all(
        [
            f"SELECT '{c}' AS table_name, '{col}' AS column_name, 'main' AS ref_schema, '{p}' AS ref_table, '{pcol}' AS ref_column, "
            f"count({col}) AS n_references, count(*) FILTER (WHERE {c}.{col} IS NOT NULL AND NOT EXISTS "
            f"(SELECT 1 FROM {p} WHERE {p}.{pcol} = {c}.{col})) AS n_orphans FROM {c}"
            for c, col, p, pcol in REFERENCES
        ]
    )
)
def list_foreign_keys(t: Tables) -> DataFrame:
    """The declared references, each with its non-NULL values and those that have no parent."""
    space = t.namespace()
    counted = []
    for child, column, parent, parent_column in REFERENCES:
        orphans = dm.orphan_keys(space.tables[child], space.tables[parent], [column], [parent_column])
        total = orphans.agg(F.coalesce(F.sum("n_rows"), F.lit(0)).alias("n_orphans"))
        counted.append(total.select(F.lit(child).alias("table"), F.lit(column).alias("column"), "n_orphans"))
    referring: dict[str, list[str]] = {}
    for child, column, _, _ in REFERENCES:
        referring.setdefault(child, []).append(column)
    facts = dm.column_facts(space, referring)
    found = dm.list_foreign_keys(dm.load_catalog(t.spark, space), "main")
    return (
        found.join(stacked(counted), on=["table", "column"])
        .join(facts, on=["table", "column"])
        .select(
            F.col("table").alias("table_name"),
            F.col("column").alias("column_name"),
            "ref_schema",
            "ref_table",
            "ref_column",
            (F.col("n_rows") - F.col("null_count")).alias("n_references"),
            "n_orphans",
        )
    )


@query(
    union_all(
        [
            f"SELECT '{name}' AS table_name, CAST({len(columns)} AS BIGINT) AS n_columns, "
            f"CAST({len(KEYS.get(name, ()))} AS BIGINT) AS n_key_columns, "
            f"CAST({sum(r[0] == name for r in REFERENCES)} AS BIGINT) AS n_references, count(*) AS n_rows FROM {name}"
            for name, columns in TABLES.items()
        ]
    )
)
def load_schema(t: Tables) -> DataFrame:
    """The whole catalog, counted per table."""
    space = t.namespace()
    catalog = dm.load_catalog(t.spark, space)
    counted = dm.column_facts(space, {name: [] for name in space.names()}).select("table", "n_rows")
    for rows, name in (
        (catalog.columns, "n_columns"),
        (catalog.primary_keys, "n_key_columns"),
        (catalog.foreign_keys, "n_references"),
    ):
        counted = counted.join(rows.groupBy("table").agg(F.count(F.lit(1)).alias(name)), on="table", how="left")
    return counted.select(
        F.col("table").alias("table_name"),
        *[F.coalesce(n, F.lit(0)).alias(n) for n in ("n_columns", "n_key_columns", "n_references")],
        "n_rows",
    )


@query(
    "SELECT table_name, n_rows FROM (" + _N_ROWS + ") WHERE table_name IN ('orders', 'pages') "
)
def table_exists(t: Tables) -> DataFrame:
    """Names looked up with their exact case, with the rows of those that exist."""
    space = t.namespace()
    counts = dm.column_facts(space, {name: [] for name in space.names()}).select("table", "n_rows")
    asked = t.spark.createDataFrame([("orders",), ("Orders",), ("pages",), ("invoices",)], "`table` string")
    found = dm.table_exists(dm.load_catalog(t.spark, space), "main", asked)
    return found.join(counts, on="table").select(F.col("table").alias("table_name"), "n_rows")


def _named(findings: DataFrame) -> DataFrame:
    return findings.select(
        F.col("table").alias("table_name"), F.col("column").alias("column_name"), "kind", "n", "message"
    )


def _row(table: str, column: str | None, kind: str, n: str, message: str, source: str) -> str:
    shown = "CAST(NULL AS VARCHAR)" if column is None else f"'{column}'"
    return (
        f"SELECT '{table}' AS table_name, {shown} AS column_name, '{kind}' AS kind, CAST({n} AS BIGINT) AS n, "
        f"'{message}' AS message FROM {source}"
    )


MISSING_TABLES = [
    _row(name, None, "missing_table", "count(*)", f"MISSING TABLE: table {name} is missing in main schema", name)
    for name in ("part", "region")
]
MISSING_COLUMNS = [
    _row(
        "orders",
        "o_orderpriority",
        "missing_column",
        "count(o_orderpriority)",
        "MISSING COLUMN: table orders: missing column o_orderpriority",
        "orders",
    )
]
TYPE_MISMATCHES = [
    _row(
        "orders",
        column,
        "type_mismatch",
        f"count({column})",
        f"MISMATCH TABLE orders: column {column} of type {ours} mismatches with column {column} of type {theirs}",
        "orders",
    )
    for column, ours, theirs in (("o_custkey", "bigint", "int"), ("o_totalprice", "double", "decimal"))
]
NULLABILITY_MISMATCHES = [
    _row(
        table,
        column,
        "nullability_mismatch",
        f"count(*) - count({column})",
        f"MISMATCH TABLE {table}: column {column} nullable mismatch",
        table,
    )
    for table, column in (("orders", "o_orderkey"), ("nation", "n_nationkey"))
]


def _schema_check(t: Tables, check) -> DataFrame:
    target, given = t.audited(), t.drifted()
    ours, theirs = (dm.load_catalog(t.spark, space) for space in (target, given))
    return _named(dm.with_affected(check(ours, theirs, "main"), target, given))


@query(union_all(MISSING_TABLES))
def missing_tables(t: Tables) -> DataFrame:
    return _schema_check(t, schema_audit.missing_tables)


@query(MISSING_TABLES[0])
def missing_tables_but_excluded(t: Tables) -> DataFrame:
    """A table may be absent if it is excluded, whatever the case of its name."""
    return _schema_check(t, lambda ours, theirs, schema: schema_audit.missing_tables(ours, theirs, schema, ["REGION"]))


@query(union_all(MISSING_COLUMNS))
def missing_columns(t: Tables) -> DataFrame:
    return _schema_check(t, schema_audit.missing_columns)


@query(union_all(TYPE_MISMATCHES))
def type_mismatches(t: Tables) -> DataFrame:
    return _schema_check(t, schema_audit.type_mismatches)


@query(union_all(TYPE_MISMATCHES).replace("of type decimal", "of type decimal(15,2)"))
def type_mismatches_exact(t: Tables) -> DataFrame:
    return _schema_check(t, lambda ours, theirs, schema: schema_audit.type_mismatches(ours, theirs, schema, "exact"))


@query(union_all(NULLABILITY_MISMATCHES))
def nullability_mismatches(t: Tables) -> DataFrame:
    return _schema_check(t, schema_audit.nullability_mismatches)


MISSING_DEPENDENCIES = [
    _row(
        "events",
        "user_id",
        "missing_dependency_schema",
        "count(user_id)",
        "MISSING DEPENDENCY SCHEMA: table events depends on schema hr which is missing",
        "events",
    ),
    *[
        _row(
            table,
            column,
            "missing_dependency_table",
            f"count({column})",
            f"MISSING DEPENDENCY TABLE: table {table} depends on table {parent} in schema crm which is missing",
            table,
        )
        for table, column, parent in (
            ("nation", "n_regionkey", "region"),
            ("lineitem", "l_partkey", "partsupp"),
            ("lineitem", "l_suppkey", "partsupp"),
        )
    ],
    _row(
        "labels",
        "doc_id",
        "missing_dependency_column",
        "count(doc_id)",
        "MISSING DEPENDENCY COLUMN: table labels depends on column c_docid in table Customer in schema crm which is missing",
        "labels",
    ),
]
_SAME_SCHEMA = _row(
    "supplier",
    "s_nationkey",
    "missing_dependency_column",
    "count(s_nationkey)",
    "MISSING DEPENDENCY COLUMN: table supplier depends on column n_key in table nation in schema main which is missing",
    "supplier",
)


def _dependencies(t: Tables, include_same_schema: bool) -> DataFrame:
    target, given, further = t.referring()
    found = schema_audit.missing_dependencies(
        dm.load_catalog(t.spark, target), dm.load_catalog(t.spark, given, further), "main", include_same_schema
    )
    return _named(dm.with_affected(found, target, given))


@query(union_all(MISSING_DEPENDENCIES))
def missing_dependencies(t: Tables) -> DataFrame:
    return _dependencies(t, include_same_schema=False)


@query(union_all([*MISSING_DEPENDENCIES, _SAME_SCHEMA]))
def missing_dependencies_same_schema(t: Tables) -> DataFrame:
    return _dependencies(t, include_same_schema=True)


@query("SELECT o_orderkey FROM orders")
def scan_keys(t: Tables) -> DataFrame:
    return dm.scan_keys(t.orders, ["o_orderkey"])


@query("SELECT conv_id, turn, concat_ws('::', CAST(conv_id AS VARCHAR), CAST(turn AS VARCHAR)) AS key_text FROM conversations")
def scan_keys_composite(t: Tables) -> DataFrame:
    """A composite key with the text it is shown as."""
    keys = dm.scan_keys(t.conversations, ["conv_id", "turn"])
    return keys.withColumn("key_text", key_text(keys, ["conv_id", "turn"]))


@query(f"""WITH {GIVEN_ORDERS}
SELECT 'o_orderstatus' AS column_name, count(*) AS n_rows, count(*) - count(o_orderstatus) AS null_count FROM given_orders
UNION ALL SELECT 'o_custkey', count(*), count(*) - count(o_custkey) FROM given_orders
UNION ALL SELECT 'o_totalprice', count(*), count(*) - count(o_totalprice) FROM given_orders
UNION ALL SELECT 'o_orderdate', count(*), count(*) - count(o_orderdate) FROM given_orders
UNION ALL SELECT 'o_orderpriority', count(*), count(*) - count(o_orderpriority) FROM given_orders
UNION ALL SELECT 'o_orderkey', count(*), count(*) - count(o_orderkey) FROM given_orders""")
def observed_nullability(t: Tables) -> DataFrame:
    return dm.observed_nullability(t.given_orders()).withColumnRenamed("column", "column_name")
