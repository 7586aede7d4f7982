"""Operators that read key columns only."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from driftmend.functions.names import col, cols, reserve, resolve
from driftmend.functions.sides import align, keep_by_key
from driftmend.functions.types import common_key_type


def scan_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The key columns, all rows. Only these columns are read."""
    return df.select(*cols(resolve(df, keys, "key column")))


def key_presence(target: DataFrame, given: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per key of either side with the number of rows it has in each: ``n_target``, ``n_given``.

    Both sides go through one aggregation on the key. That is one shuffle of key columns, counted
    per task first, so a key with any number of rows is one row per task; NULL is a key value like
    any other; and nothing is sorted or joined.
    """
    sides = align(target, given, keys, values=[])
    reserve(sides.keys, "n_target", "n_given")
    both = sides.target.select("*", F.lit(1).alias("n_target"), F.lit(0).alias("n_given")).unionByName(
        sides.given.select("*", F.lit(0).alias("n_target"), F.lit(1).alias("n_given"))
    )
    return both.groupBy(*cols(sides.keys)).agg(F.sum("n_target").alias("n_target"), F.sum("n_given").alias("n_given"))


def missing_keys(target: DataFrame, given: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Distinct keys of target that given does not have."""
    presence = key_presence(target, given, keys)
    return presence.where((F.col("n_target") > 0) & (F.col("n_given") == 0)).drop("n_target", "n_given")


def unsynced_count(target: DataFrame, given: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row: ``unsynced``, the number of distinct keys given does not have."""
    return missing_keys(target, given, keys).agg(F.count(F.lit(1)).alias("unsynced"))


def key_profile(df: DataFrame, keys: Sequence[str], approximate: bool = False) -> DataFrame:
    """One row saying whether ``keys`` can serve as a primary key.

    ``rows``, ``distinct_keys``, ``duplicate_keys`` (keys with several rows), ``duplicate_rows``
    (rows under them) and ``null_key_rows``. With ``approximate`` only rows, an estimate of the
    distinct keys and the NULL rows, without shuffling keys.
    """
    keys = resolve(df, keys, "key column")
    has_null = reduce(Column.__or__, [col(k).isNull() for k in keys])
    if approximate:
        return df.agg(
            F.count(F.lit(1)).alias("rows"),
            F.approx_count_distinct(F.struct(*cols(keys))).alias("distinct_keys"),
            F.count_if(has_null).alias("null_key_rows"),
        )
    counted = df.groupBy(*cols(keys)).agg(F.count(F.lit(1)).alias("_rows"))
    repeated = F.col("_rows") > 1
    return counted.agg(
        F.coalesce(F.sum("_rows"), F.lit(0)).alias("rows"),
        F.count(F.lit(1)).alias("distinct_keys"),
        F.count_if(repeated).alias("duplicate_keys"),
        F.coalesce(F.sum(F.when(repeated, F.col("_rows"))), F.lit(0)).alias("duplicate_rows"),
        F.coalesce(F.sum(F.when(has_null, F.col("_rows"))), F.lit(0)).alias("null_key_rows"),
    )


def primary_key_holds(target: DataFrame, given: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row, ``holds``: whether the key is unique and never NULL on both sides, so that
    ``primary_key=True`` may be passed to other operators."""
    presence = key_presence(target, given, keys)
    broken = (F.greatest("n_target", "n_given") > 1) | reduce(
        Column.__or__, [c.isNull() for c in cols(presence.columns[:-2])]
    )
    return presence.agg((F.count_if(broken) == 0).alias("holds"))


def orphan_rows(
    child: DataFrame, parent: DataFrame, columns: Sequence[str], parent_columns: Sequence[str]
) -> DataFrame:
    """Rows of ``child`` whose reference has no parent. A reference with a NULL part points at nothing and is no orphan.

    The parents are reduced to distinct keys first; child rows under one hot reference are split
    by adaptive execution, as the join only ever drops or keeps them.
    """
    complete, pointed_at, names = _reference(child, parent, columns, parent_columns)
    return keep_by_key(complete, pointed_at, names, "left_anti").select(*cols(child.columns))


def orphan_keys(
    child: DataFrame, parent: DataFrame, columns: Sequence[str], parent_columns: Sequence[str]
) -> DataFrame:
    """Reference values that have no parent, each with ``n_rows``, the child rows under it.

    Reads reference columns only and counts before it shuffles, so it is the cheap form of
    :func:`orphan_rows` where the rows themselves are not needed.
    """
    columns = resolve(child, columns)
    reserve(columns, "n_rows")
    complete, pointed_at, names = _reference(child.select(*cols(columns)), parent, columns, parent_columns)
    counted = complete.groupBy(*names).agg(
        F.count(F.lit(1)).alias("n_rows"), *[F.any_value(col(c)).alias(c) for c in columns]
    )
    return counted.join(pointed_at.distinct(), on=names, how="left_anti").select(*cols(columns), "n_rows")


def _reference(
    child: DataFrame, parent: DataFrame, columns: Sequence[str], parent_columns: Sequence[str]
) -> tuple[DataFrame, DataFrame, list[str]]:
    """Complete references of child and the keys they can point at, in columns of the same names and types."""
    columns, parent_columns = resolve(child, columns), resolve(parent, parent_columns)
    names = [f"_ref_{i}" for i in range(len(columns))]
    ours, theirs = [], []
    for name, c, p in zip(names, columns, parent_columns, strict=True):
        dtype = common_key_type(child.schema[c].dataType, parent.schema[p].dataType)
        ours.append(col(c).cast(dtype).alias(name))
        theirs.append(col(p).cast(dtype).alias(name))
    complete = child.where(reduce(Column.__and__, [col(c).isNotNull() for c in columns]))
    return complete.select("*", *ours), parent.select(*theirs), names


__all__ = [
    "key_presence",
    "key_profile",
    "missing_keys",
    "orphan_keys",
    "orphan_rows",
    "primary_key_holds",
    "scan_keys",
    "unsynced_count",
]
