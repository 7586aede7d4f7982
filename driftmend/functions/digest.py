"""Row digests for comparing buckets of rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from driftmend.functions.names import col
from driftmend.functions.types import canonical

_NESTED = (T.ArrayType, T.MapType, T.StructType)
_JSON = {
    "ignoreNullFields": "false",
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}


def _hash_parts(df: DataFrame, names: Sequence[str]) -> list[Column]:
    """What to hash of a row. A NULL leaves a running hash unchanged, so where NULLs are is hashed as well."""
    parts: list[Column] = []
    for name in names:
        dtype, value = df.schema[name].dataType, col(name)
        parts.append(value.isNull())
        if isinstance(dtype, T.ArrayType) and not isinstance(dtype.elementType, _NESTED):
            parts += [F.size(value), value, F.transform(value, lambda e: e.isNull())]
        elif isinstance(dtype, _NESTED):
            parts.append(F.to_json(F.struct(canonical(value, dtype).alias("v")), _JSON))
        else:
            parts.append(value)
    return parts


def row_digest(df: DataFrame, names: Sequence[str], seed: int = 0) -> Column:
    """64-bit digest of a row. Two seeds give two digests to be used together."""
    return F.xxhash64(F.lit(seed), *_hash_parts(df, names))


def key_bucket(df: DataFrame, keys: Sequence[str], n: int) -> Column:
    return F.pmod(F.xxhash64(*_hash_parts(df, keys)), F.lit(n)).cast("int")
