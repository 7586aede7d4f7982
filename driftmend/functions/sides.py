"""Bringing two versions of a table to the same column names and types."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from driftmend.functions.names import col, cols, resolve
from driftmend.functions.types import as_common, common_key_type, common_type


@dataclass(frozen=True)
class Sides:
    """Both sides with target's spelling and common types: first the keys, then the shared other columns."""

    target: DataFrame
    given: DataFrame
    keys: list[str]
    values: list[str]
    types: dict[str, T.DataType]


def align(target: DataFrame, given: DataFrame, keys: Sequence[str], values: Sequence[str] | None = None) -> Sides:
    """Match columns by name ignoring case. Columns on one side only are left out: a schema audit reports them."""
    keys = resolve(target, keys, "key column")
    theirs = resolve(given, keys, "key column")
    if values is None:
        known = {c.lower() for c in given.columns}
        taken = {k.lower() for k in keys}
        values = [c for c in target.columns if c.lower() in known and c.lower() not in taken]
    else:
        values = resolve(target, values)
    theirs = theirs + resolve(given, values)
    left, right, types = [], [], {}
    for i, (ours, their) in enumerate(zip([*keys, *values], theirs, strict=True)):
        a, b = target.schema[ours].dataType, given.schema[their].dataType
        dtype = common_key_type(a, b) if i < len(keys) else common_type(a, b)
        types[ours] = dtype
        left.append(col(ours) if a == dtype else as_common(col(ours), a, dtype).alias(ours))
        right.append(as_common(col(their), b, dtype).alias(ours))
    return Sides(target.select(*left), given.select(*right), list(keys), list(values), types)


def distinct_keys(df: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, Column]:
    """The distinct keys of ``df`` under other names, and the null-safe condition that a row's ``keys`` match them.

    A null-safe join hashes its keys in another way than the aggregation before it, so the distinct keys
    are shuffled once more. That is wanted: adaptive execution splits the rows of a hot key only where
    both inputs of the join come straight from a shuffle.
    """
    renamed = df.select(*[col(k).alias(f"_key_{i}") for i, k in enumerate(keys)])
    same = [col(k).eqNullSafe(F.col(f"_key_{i}")) for i, k in enumerate(keys)]
    return renamed.distinct(), reduce(Column.__and__, same)


def keep_by_key(
    rows: DataFrame, others: DataFrame, keys: Sequence[str], how: str, primary_key: bool = False
) -> DataFrame:
    """Rows whose key is (``left_semi``) or is not (``left_anti``) among the keys of ``others``.

    ``others`` is reduced to distinct keys before its shuffle, so a key repeated there without end
    costs one row per task. Rows of a hot key stay on the left, where adaptive execution splits them.
    With ``primary_key`` both sides are known unique and free of NULL keys: plain equality, which
    also lets tables bucketed on the key join in place.
    """
    if primary_key:
        kept = rows.join(others.select(*cols(keys)), on=list(keys), how=how)
        return kept.select(*cols(rows.columns))
    theirs, same = distinct_keys(others, keys)
    return rows.join(theirs, on=same, how=how)
