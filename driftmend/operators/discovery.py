"""Keys and references found in the data, for tables that declare none."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from driftmend.functions.frames import stacked
from driftmend.functions.names import col, resolve
from driftmend.functions.types import family
from driftmend.plans.facts import column_facts
from driftmend.sources.contract import Namespace
from driftmend.sources.sinks import staged

_WHOLE = ("tinyint", "smallint", "int", "bigint")


def key_columns(space: Namespace, wanted: Mapping[str, Sequence[str]] | None = None) -> DataFrame:
    """``table``, ``column`` and ``n_rows`` of every column of whole numbers or text that is never NULL and never repeats.

    Counted exactly, over all tables in one pass and one shuffle; ``wanted`` names the columns to look at, per table.
    """
    places, sets = _shared_values(space, wanted)
    return _unique(space, places, sets).select("table", "column", "n_rows")


def propose_references(space: Namespace, wanted: Mapping[str, Sequence[str]] | None = None) -> DataFrame:
    """References that hold in the data: ``table``, ``column``, ``ref_table``, ``ref_column`` and ``n_values``, the number of
    distinct values, all of which the referenced column has; that column is never NULL and never repeats.

    Each distinct value is shuffled once, with the columns that have it; a value in any number of rows is one row per
    task. What is compared then are sets of columns, with the number of values that occur in just these: few, however
    large the tables. Whole numbers of all widths meet; text meets text. Proposals say what holds now, not what is meant.
    """
    places, sets = _shared_values(space, wanted)
    own = sets.select(F.explode("ids").alias("id"), "n").groupBy("id").agg(F.sum("n").alias("n_values"))
    each = sets.select("ids", F.explode("ids").alias("id"), "n")
    both = each.select("id", F.explode("ids").alias("ref"), "n").where("id <> ref").groupBy("id", "ref").agg(F.sum("n").alias("n_both"))
    held = both.join(own, "id").where("n_both = n_values")
    named = places.select("id", "table", "column")
    keys = _unique(space, places, sets).select(F.col("id").alias("ref"), F.col("table").alias("ref_table"), F.col("column").alias("ref_column"))
    return held.join(named, "id").join(keys, "ref").select("table", "column", "ref_table", "ref_column", "n_values")


def _shared_values(space: Namespace, wanted: Mapping[str, Sequence[str]] | None) -> tuple[DataFrame, DataFrame]:
    """(the columns by number, ``ids`` and ``n``: how many values occur in just these columns)"""
    places: list[tuple[int, str, str]] = []
    frames: list[DataFrame] = []
    spark = None
    for name in space.names():
        table = space.tables[name]
        spark = table.sparkSession
        names = table.columns if wanted is None else resolve(table, wanted.get(name, ()))
        cells = []
        for column in names:
            kind = table.schema[column].dataType
            if family(kind) not in (*_WHOLE, "string"):
                continue
            whole = family(kind) != "string"
            number, text = (col(column).cast("bigint"), F.lit(None).cast("string")) if whole else (F.lit(None).cast("bigint"), col(column).cast("string"))
            cells.append(F.struct(F.lit(len(places)).alias("id"), number.alias("number"), text.alias("text")))
            places.append((len(places), name, column))
        if cells:
            frames.append(table.select(F.inline(F.array(*cells))).where("number IS NOT NULL OR text IS NOT NULL"))
    if not frames:
        raise ValueError("there is no column of whole numbers or text")
    values = stacked(frames).groupBy("number", "text").agg(F.array_sort(F.collect_set("id")).alias("ids"))
    sets = staged(values.groupBy("ids").agg(F.count(F.lit(1)).alias("n")), "columns")
    return spark.createDataFrame(places, T.StructType.fromDDL("id int, table string, column string")), sets


def _unique(space: Namespace, places: DataFrame, sets: DataFrame) -> DataFrame:
    wanted: dict[str, list[str]] = {}
    for row in places.collect():  # as many as the columns looked at
        wanted.setdefault(row.table, []).append(row.column)
    own = sets.select(F.explode("ids").alias("id"), "n").groupBy("id").agg(F.sum("n").alias("n_values"))
    facts = column_facts(space, wanted)
    return places.join(own, "id").join(facts, ["table", "column"]).where("n_values = n_rows")
