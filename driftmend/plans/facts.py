"""How many rows a schema finding concerns, counted on the tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from driftmend.functions.frames import stacked
from driftmend.operators.rows import observed_nullability
from driftmend.sources.contract import Namespace


def column_facts(space: Namespace, wanted: Mapping[str, Sequence[str]] | None = None) -> DataFrame:
    """``table``, ``column``, ``n_rows``, ``null_count``: one pass over each table, reading the wanted columns only.

    A table of which no column is wanted has one row without a column, for its number of rows.
    """
    wanted = {name: space.tables[name].columns for name in space.names()} if wanted is None else wanted
    frames = []
    for name, columns in wanted.items():
        table = space.tables[name]
        if columns:
            counted = observed_nullability(table, columns)
        else:
            counted = table.agg(F.count(F.lit(1)).alias("n_rows")).select(
                F.lit(None).cast("string").alias("column"), "n_rows", F.lit(0).cast("bigint").alias("null_count")
            )
        frames.append(counted.select(F.lit(name).alias("table"), "column", "n_rows", "null_count"))
    if not frames:
        raise ValueError("there is no table to count")
    return stacked(frames)


def columns_in_question(target: Namespace, given: Namespace) -> dict[str, list[str]]:
    """Per table of target, the columns a schema finding can name. Decides what is read, not what is found."""
    found: dict[str, list[str]] = {}
    for name in target.names():
        other = given.find(name)
        if other is None:
            found[name] = []
            continue
        theirs = {f.name.lower(): f for f in given.tables[other].schema.fields}
        ours, their_contract = target.contract(name), given.contract(other)
        required = {c.lower() for c in (*ours.keys, *ours.required)}
        their_required = {c.lower() for c in (*their_contract.keys, *their_contract.required)}
        pointing = {c.lower() for reference in ours.references for c in reference.columns}
        columns = []
        for field in target.tables[name].schema.fields:
            key = field.name.lower()
            match = theirs.get(key)
            differs = match is None or match.dataType != field.dataType
            differs = differs or (field.nullable and key not in required) != (match.nullable and key not in their_required)
            if differs or key in pointing:
                columns.append(field.name)
        if columns:
            found[name] = columns
    return found


def with_affected(findings: DataFrame, target: Namespace, given: Namespace) -> DataFrame:
    """Fill ``n`` of schema findings from target's data.

    The rows of a missing table, the NULLs of a column whose nullability differs, and otherwise the
    non-NULL values of the column.
    """
    wanted = columns_in_question(target, given)
    if not wanted:
        return findings
    facts = column_facts(target, wanted).select(
        F.col("table").alias("_table"), F.coalesce("column", F.lit("")).alias("_column"), "n_rows", "null_count"
    )
    here = (F.col("table") == F.col("_table")) & (F.coalesce("column", F.lit("")) == F.col("_column"))
    counted = (
        F.when(F.col("kind") == "nullability_mismatch", F.col("null_count"))
        .when(F.col("kind") == "name_collision", F.col("n"))
        .otherwise(F.col("n_rows") - F.col("null_count"))
    )
    # One row per column in question: the facts are as few as the columns, whatever the size of the tables.
    return findings.join(facts, on=here, how="left").select(
        "table", "column", "kind", F.coalesce(counted, "n").alias("n"), "message"
    )
