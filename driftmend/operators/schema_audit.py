"""Schema differences between two catalogs, as joins on lower-cased names.

Every function reports what the given side lacks or has differently; swap the arguments for
the reverse. All return the findings columns (table, column, kind, n, message) with n left NULL:
a catalog does not know how many rows a deviation concerns.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from driftmend.functions.findings import finding
from driftmend.functions.frames import stacked
from driftmend.sources.catalog import Catalog

# Which catalog column holds the type at each strictness of comparison.
TYPE_COLUMNS = {"family": "data_type", "exact": "exact_type", "source": "source_type"}


def missing_tables(
    target: Catalog, given: Catalog, schema: str, exclude: Sequence[str] = (), given_schema: str | None = None
) -> DataFrame:
    """Tables of target that given lacks. ``exclude`` names tables that may be absent."""
    named = target.tables.where(F.col("schema") == schema).select("table", F.lower("table").alias("_table"))
    absent = named.join(_tables(given, given_schema or schema), on="_table", how="left_anti")
    if exclude:
        absent = absent.where(~F.col("_table").isin([name.lower() for name in exclude]))
    return absent.select(
        *finding("missing_table", F.col("table"), None, None, F.col("table"), F.lit(given_schema or schema))
    )


def missing_columns(target: Catalog, given: Catalog, schema: str, given_schema: str | None = None) -> DataFrame:
    """Columns of target that given lacks, for tables on both sides."""
    return column_deviations(target, given, schema, None, given_schema, ("missing_column",))


def type_mismatches(
    target: Catalog, given: Catalog, schema: str, compare_types: str = "family", given_schema: str | None = None
) -> DataFrame:
    """Columns on both sides whose types differ: by family, by exact type, or by the source's own type name."""
    return column_deviations(target, given, schema, compare_types, given_schema, ("type_mismatch",))


def nullability_mismatches(target: Catalog, given: Catalog, schema: str, given_schema: str | None = None) -> DataFrame:
    """Columns on both sides of which one admits NULL and the other does not."""
    return column_deviations(target, given, schema, None, given_schema, ("nullability_mismatch",))


def column_deviations(
    target: Catalog,
    given: Catalog,
    schema: str,
    compare_types: str | None = "family",
    given_schema: str | None = None,
    kinds: Sequence[str] = ("missing_column", "type_mismatch", "nullability_mismatch"),
) -> DataFrame:
    """All kinds of finding about columns of tables on both sides, from one join of the two sides' columns.

    A table of target is compared with the table of its very name in given, or else with the last whose name differs in
    case only; so every one of target's tables is, also where their own names collide.
    """
    if "type_mismatch" in kinds and compare_types not in TYPE_COLUMNS:
        raise ValueError(f"compare_types is one of {sorted(TYPE_COLUMNS)}, not {compare_types!r}")
    here = given_schema or schema
    ours, theirs = (catalog.tables.where(F.col("schema") == of) for catalog, of in ((target, schema), (given, here)))
    names = theirs.select(F.lower("table").alias("_table"), F.col("table").alias("_other"))
    pairs = ours.select("table", F.lower("table").alias("_table")).join(names, on="_table")
    pairs = pairs.groupBy("table").agg(F.max_by("_other", F.struct(F.col("_other") == F.col("table"), "_other")).alias("_other"))
    left = _columns(target, schema).join(pairs, on="table").alias("t")
    right = _columns(given, here).select(*[F.col(c).alias(f"_g_{c}") for c in ("table", "_column", "column", "nullable", *TYPE_COLUMNS.values())])
    both = left.join(right, on=(F.col("_other") == F.col("_g_table")) & (F.col("_column") == F.col("_g__column")), how="left")

    table, column, there = F.col("table"), F.col("column"), F.col("_g_column").isNotNull()
    cases = []
    if "missing_column" in kinds:
        cases.append((~there, finding("missing_column", table, column, None, table, column)))
    if "type_mismatch" in kinds:
        mine, other = (F.col(f"{side}{TYPE_COLUMNS[compare_types]}") for side in ("", "_g_"))
        cases.append((there & (mine != other), finding("type_mismatch", table, column, None, table, column, mine, F.col("_g_column"), other)))
    if "nullability_mismatch" in kinds:
        cases.append((there & (F.col("nullable") != F.col("_g_nullable")), finding("nullability_mismatch", table, column, None, table, column)))
    return both.select(F.inline(F.array_compact(F.array(*[F.when(holds, F.struct(*facts)) for holds, facts in cases]))))


def missing_dependencies(
    target: Catalog,
    given: Catalog,
    schema: str,
    include_same_schema: bool = False,
    given_schema: str | None = None,
) -> DataFrame:
    """References of target's tables that lead nowhere in given: no such schema, table or column.

    References inside the audited schema are only looked at with ``include_same_schema``.
    """
    here = given_schema or schema
    references = target.foreign_keys.where(F.col("schema") == schema).select(
        F.lower("table").alias("_table"),
        "table",
        "column",
        # The audited schema may go by another name on the given side.
        F.when(F.col("ref_schema") == schema, F.lit(here)).otherwise(F.col("ref_schema")).alias("ref_schema"),
        "ref_table",
        "ref_column",
        F.lower("ref_table").alias("_ref_table"),
        F.lower("ref_column").alias("_ref_column"),
    )
    references = references.join(_tables(given, here), on="_table", how="left_semi")
    if not include_same_schema:
        references = references.where(F.col("ref_schema") != here)
    schemas = given.tables.select(F.col("schema").alias("ref_schema")).distinct()
    tables = given.tables.select(F.col("schema").alias("ref_schema"), F.lower("table").alias("_ref_table")).distinct()
    columns = given.columns.select(
        F.col("schema").alias("ref_schema"), F.lower("table").alias("_ref_table"), F.lower("column").alias("_ref_column")
    ).distinct()

    in_schema = references.join(schemas, on="ref_schema", how="left_semi")
    in_table = in_schema.join(tables, on=["ref_schema", "_ref_table"], how="left_semi")
    table, column = F.col("table"), F.col("column")
    to_schema, to_table, to_column = F.col("ref_schema"), F.col("ref_table"), F.col("ref_column")
    no_schema = references.join(schemas, on="ref_schema", how="left_anti").select(
        *finding("missing_dependency_schema", table, column, None, table, to_schema)
    )
    no_table = in_schema.join(tables, on=["ref_schema", "_ref_table"], how="left_anti").select(
        *finding("missing_dependency_table", table, column, None, table, to_table, to_schema)
    )
    no_column = in_table.join(columns, on=["ref_schema", "_ref_table", "_ref_column"], how="left_anti").select(
        *finding("missing_dependency_column", table, column, None, table, to_column, to_table, to_schema)
    )
    return stacked([no_schema, no_table, no_column])


def name_collisions(catalog: Catalog, schema: str) -> DataFrame:
    """Tables, or columns of a table, whose names differ only in case. Of such columns comparisons use the last."""
    tables = (
        catalog.tables.where(F.col("schema") == schema)
        .groupBy(F.lower("table").alias("_table"))
        .agg(F.array_sort(F.collect_set("table")).alias("names"), F.max("table").alias("table"))
    )
    columns = (
        catalog.columns.where(F.col("schema") == schema)
        .groupBy("table", F.lower("column").alias("_column"))
        .agg(F.array_sort(F.collect_list("column")).alias("names"), F.max_by("column", "ordinal").alias("column"))
    )
    shown = F.array_join("names", ", ")
    table = F.col("table")
    return (
        tables.where(F.size("names") > 1)
        .select(*finding("name_collision", table, None, F.size("names"), table, shown))
        .unionByName(
            columns.where(F.size("names") > 1).select(
                *finding("name_collision", table, F.col("column"), F.size("names"), table, shown)
            )
        )
    )


def _tables(catalog: Catalog, schema: str) -> DataFrame:
    found = catalog.tables.where(F.col("schema") == schema)
    return found.groupBy(F.lower("table").alias("_table")).agg(F.max("table").alias("table"))


def _columns(catalog: Catalog, schema: str) -> DataFrame:
    """One row per table and lower-cased column name, the last one where names of columns collide."""
    found = catalog.columns.where(F.col("schema") == schema)
    return found.groupBy("table", F.lower("column").alias("_column")).agg(
        *[F.max_by(c, "ordinal").alias(c) for c in ("column", "nullable", *TYPE_COLUMNS.values())]
    )
