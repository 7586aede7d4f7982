"""Text forms of keys and cells, for reading only: nothing is ever matched on them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from driftmend.functions.names import col, resolve


def cell_text(value: Column, dtype: T.DataType) -> Column:
    """A cell as text; nested values as JSON."""
    if isinstance(dtype, (T.ArrayType, T.MapType, T.StructType)):
        return F.to_json(value)
    return value.cast("string")


def key_text(df: DataFrame, keys: Sequence[str], separator: str = "::") -> Column:
    """Key parts joined by ``separator``, a NULL part shown as ``NULL``."""
    parts = [
        F.coalesce(cell_text(col(k), df.schema[k].dataType), F.lit("NULL")) for k in resolve(df, keys, "key column")
    ]
    return F.concat_ws(separator, *parts)
