"""Namespaces from files, from a Spark database, and from a database over JDBC."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from driftmend.functions.names import quote
from driftmend.sources.catalog import Catalog
from driftmend.sources.contract import Namespace, TableContract
from driftmend.sources.information_schema import RELATIONS, catalog_from_information_schema, contracts_of


def read_files(
    spark: SparkSession,
    schema: str,
    paths: Mapping[str, str],
    contracts: Iterable[TableContract] = (),
    format: str = "parquet",
    options: Mapping[str, str] | None = None,
) -> Namespace:
    """A namespace of file tables. One that cannot be opened is kept as an error and the rest go on."""
    tables: dict[str, DataFrame] = {}
    errors: dict[str, str] = {}
    for name, path in paths.items():
        try:
            tables[name] = spark.read.format(format).options(**dict(options or {})).load(path)
        except PySparkException as error:
            errors[name] = error.getCondition() or str(error)
    return Namespace(schema, tables, tuple(contracts), errors)


def read_database(spark: SparkSession, database: str, contracts: Iterable[TableContract] = ()) -> Namespace:
    """All tables and views of a Spark database."""
    tables: dict[str, DataFrame] = {}
    errors: dict[str, str] = {}
    for entry in spark.catalog.listTables(database):
        if entry.isTemporary:
            continue
        try:
            tables[entry.name] = spark.table(f"{quote(database)}.{quote(entry.name)}")
        except PySparkException as error:
            errors[entry.name] = error.getCondition() or str(error)
    return Namespace(database, tables, tuple(contracts), errors)


def quoted(name: str) -> str:
    """A database identifier in double quotes."""
    return '"' + name.replace('"', '""') + '"'


@dataclass(frozen=True)
class Split:
    """How a JDBC read of one table is split over tasks: ranges of a numeric, date or timestamp column."""

    column: str
    lower: object
    upper: object
    partitions: int

    def options(self) -> dict[str, str]:
        return {
            "partitionColumn": self.column,
            "lowerBound": str(self.lower),
            "upperBound": str(self.upper),
            "numPartitions": str(self.partitions),
        }


def jdbc_options(schema: str, table: str, split: Split | None = None, fetch_size: int = 10_000) -> dict[str, str]:
    """Read options of one table. Without a split a table is one task, which only suits small ones."""
    options = {"dbtable": f"{quoted(schema)}.{quoted(table)}", "fetchsize": str(fetch_size)}
    return options if split is None else {**options, **split.options()}


# Fixed value: bytes of a page of the databases whose tables can be read by page numbers.
PAGE_BYTES = 8192


def pages_query(schema: str) -> str:
    """Pages of each table and materialised view of a schema, as a relation a JDBC read can take.

    ``pages`` are all of them and ``longest`` those of its longest part: the table itself, or, as a partitioned table has
    none of its own, a partition. They are what the files hold now, so a table that was never analysed has them too.
    """
    name = schema.replace("'", "''")
    leaves = "(SELECT {}(pg_relation_size(p.relid)) FROM pg_partition_tree(c.oid) p WHERE p.isleaf)"
    sizes = [f"CASE WHEN c.relkind = 'p' THEN coalesce({leaves.format(f)}, 0) ELSE pg_relation_size(c.oid) END" for f in ("sum", "max")]
    return (
        f"(SELECT c.relname AS table_name, (({sizes[0]}) / {PAGE_BYTES})::bigint AS pages, (({sizes[1]}) / {PAGE_BYTES})::bigint AS longest "
        "FROM pg_catalog.pg_class c JOIN pg_catalog.pg_namespace n ON n.oid = c.relnamespace "
        f"WHERE n.nspname = '{name}' AND c.relkind IN ('r', 'p', 'm')) AS pages"
    )


def page_predicates(pages: int, task_bytes: int, longest: int | None = None) -> list[str]:
    """Conditions that cut a table into tasks of about ``task_bytes`` by page numbers, whatever its key.

    Page numbers count in each partition by itself, so of a partitioned table a task has the same numbers of all
    partitions; they reach to the ``longest`` one. The last run is open, so rows added since are read as well.
    """
    longest = pages if longest is None else longest
    tasks = max(1, -(-pages * PAGE_BYTES // task_bytes))
    step = max(1, -(-longest // tasks))
    starts = list(range(0, max(1, longest), step))
    ends = [*starts[1:], None]
    return [
        f"ctid >= '({low},0)'::tid" + (f" AND ctid < '({high},0)'::tid" if high is not None else "") for low, high in zip(starts, ends, strict=True)
    ]


def hash_predicates(columns: Iterable[str], parts: int) -> list[str]:
    """Conditions that cut a table by a hash of its key's text, for what has no pages of its own, such as a large view."""
    key = ", ".join(f"{quoted(c)}::text" for c in columns)
    return [f"mod(abs(hashtext(concat_ws('|', {key}))::bigint), {parts}) = {i}" for i in range(parts)]


def jdbc_catalog(spark: SparkSession, connection: Mapping[str, str]) -> Catalog:
    """Catalog of a database; its driver jar must be on Spark's class path."""
    reader = spark.read.format("jdbc").options(**dict(connection))
    return catalog_from_information_schema(
        **{name: reader.option("dbtable", f"information_schema.{name}").load() for name in RELATIONS}
    )


def bounds_query(schema: str, table: str, column: str) -> str:
    """The least and greatest value of a column, as a relation a JDBC read can take."""
    name, of = quoted(column), f"{quoted(schema)}.{quoted(table)}"
    return f"(SELECT min({name}) AS lower, max({name}) AS upper FROM {of}) AS bounds"


def splits_by_key(
    spark: SparkSession, connection: Mapping[str, str], catalog: Catalog, schema: str, partitions: int
) -> dict[str, Split]:
    """A split for every table with an integer key column, over the range its values have now."""
    integers = catalog.columns.where(F.col("data_type").isin("smallint", "int", "bigint"))
    first = catalog.primary_keys.where((F.col("schema") == schema) & (F.col("position") == 1))
    splits = {}
    for row in first.join(integers, on=["schema", "table", "column"]).select("table", "column").toLocalIterator():
        query = bounds_query(schema, row["table"], row["column"])
        found = spark.read.format("jdbc").options(**dict(connection), dbtable=query).load().first()
        if found["lower"] is not None:
            splits[row["table"]] = Split(row["column"], found["lower"], found["upper"], partitions)
    return splits


def read_jdbc(
    spark: SparkSession,
    schema: str,
    connection: Mapping[str, str],
    task_bytes: int = 128 << 20,
    splits: Mapping[str, Split | list[str]] | None = None,
    by_pages: bool = True,
    partitions: int = 64,
) -> tuple[Namespace, Catalog]:
    """All tables and views of a database schema, with the keys and references declared there.

    A table is read in tasks of about ``task_bytes``, by its pages, whatever its key is. Where the database has no such
    pages (``by_pages=False``) each table with an integer key is read in ``partitions`` tasks by ranges of it. ``splits``
    gives ranges or conditions (see :func:`hash_predicates`) for others that are large, such as views.
    """
    catalog = jdbc_catalog(spark, connection)
    chosen: dict[str, Split | list[str]] = {}
    if by_pages:
        counted = spark.read.format("jdbc").options(**dict(connection), dbtable=pages_query(schema)).load()
        for row in counted.toLocalIterator():
            if row["pages"] * PAGE_BYTES > task_bytes:
                chosen[row["table_name"]] = page_predicates(row["pages"], task_bytes, row["longest"])
    else:
        chosen.update(splits_by_key(spark, connection, catalog, schema, partitions))
    chosen.update(splits or {})
    tables: dict[str, DataFrame] = {}
    errors: dict[str, str] = {}
    for row in catalog.tables.where(F.col("schema") == schema).orderBy("table").toLocalIterator():
        name = row["table"]
        try:
            tables[name] = _load(spark, connection, schema, name, chosen.get(name))
        except PySparkException as error:
            errors[name] = error.getCondition() or str(error)
    return Namespace(schema, tables, tuple(contracts_of(catalog, schema)), errors), catalog


def _load(spark: SparkSession, connection: Mapping[str, str], schema: str, table: str, split: Split | list[str] | None) -> DataFrame:
    if isinstance(split, list):
        options = {**dict(connection), **jdbc_options(schema, table)}
        url, dbtable = options.pop("url"), options.pop("dbtable")
        return spark.read.jdbc(url, dbtable, predicates=split, properties=options)
    return spark.read.format("jdbc").options(**{**dict(connection), **jdbc_options(schema, table, split)}).load()
