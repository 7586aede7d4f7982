"""Mapping a table to another schema."""

from __future__ import annotations

from collections.abc import Mapping
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from driftmend.functions.names import col, resolve


def map_schema(
    df: DataFrame,
    target_schema: T.StructType,
    renames: Mapping[str, str] | None = None,
    defaults: Mapping[str, Any] | None = None,
) -> tuple[DataFrame, DataFrame]:
    """``df`` in the columns and types of ``target_schema``, and what the casts lost.

    Columns match by name ignoring case, after ``renames`` (old name to new). A column ``df`` lacks is
    its default or NULL; further columns are dropped. Values that cannot be cast become NULL, and the
    second result counts these per column: ``column``, ``n_values``, ``n_lost``, and in ``n_changed`` the values
    that the cast kept but that differ when cast back, such as a fraction cut off.
    """
    new_names = {resolve(df, [old])[0]: new for old, new in (renames or {}).items()}
    by_name: dict[str, str] = {}
    for c in df.columns:
        name = new_names.get(c, c).lower()
        if name in by_name:
            raise ValueError(f"columns {by_name[name]!r} and {c!r} would both become {name!r}")
        by_name[name] = c
    given_defaults = {name.lower(): value for name, value in (defaults or {}).items()}

    mapped: list[Column] = []
    casts: list[tuple[str, Column, Column, Column]] = []
    for field in target_schema.fields:
        source = by_name.get(field.name.lower())
        if source is None:
            mapped.append(F.lit(given_defaults.get(field.name.lower())).cast(field.dataType).alias(field.name))
            continue
        same = df.schema[source].dataType == field.dataType
        value = col(source) if same else col(source).try_cast(field.dataType)
        mapped.append(value.alias(field.name))
        back = value if same else value.try_cast(df.schema[source].dataType)
        nested = isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType))
        changed = F.lit(False) if same or nested else value.isNotNull() & ~back.eqNullSafe(col(source))
        casts.append((field.name, col(source), value, changed))
    return df.select(*mapped), _loss(df, casts)


def _loss(df: DataFrame, casts: list[tuple[str, Column, Column, Column]]) -> DataFrame:
    if not casts:
        return df.select(
            F.lit("").alias("column"), *[F.lit(0).cast("bigint").alias(n) for n in ("n_values", "n_lost", "n_changed")]
        ).where(F.lit(False))
    counted = df.agg(
        *[F.count(source).alias(f"_n{i}") for i, (_, source, _, _) in enumerate(casts)],
        *[F.count(value).alias(f"_k{i}") for i, (_, _, value, _) in enumerate(casts)],
        *[F.count_if(changed).alias(f"_c{i}") for i, (_, _, _, changed) in enumerate(casts)],
    )
    facts = [
        F.struct(
            F.lit(name).alias("column"),
            F.col(f"_n{i}").alias("n_values"),
            (F.col(f"_n{i}") - F.col(f"_k{i}")).alias("n_lost"),
            F.col(f"_c{i}").alias("n_changed"),
        )
        for i, (name, _, _, _) in enumerate(casts)
    ]
    return counted.select(F.inline(F.array(*facts)))
