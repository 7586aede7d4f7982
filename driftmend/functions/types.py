"""Type families, common types for comparing two sides, and comparable forms of values."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The family each Spark type belongs to when types are compared.
FAMILIES: dict[type, str] = {
    T.ByteType: "tinyint",
    T.ShortType: "smallint",
    T.IntegerType: "int",
    T.LongType: "bigint",
    T.FloatType: "float",
    T.DoubleType: "double",
    T.DecimalType: "decimal",
    T.BooleanType: "boolean",
    T.DateType: "date",
    T.StringType: "string",
    T.VarcharType: "string",
    T.CharType: "string",
    T.TimestampNTZType: "timestamp_ntz",
    T.TimestampType: "timestamp",
    T.BinaryType: "binary",
    T.ArrayType: "array",
    T.StructType: "struct",
    T.MapType: "map",
}

_INTEGRAL = [T.ByteType, T.ShortType, T.IntegerType, T.LongType]
_FLOATING = (T.FloatType, T.DoubleType)
# Types whose cells an aggregation can hold in place.
FIXED_WIDTH = (*_INTEGRAL, *_FLOATING, T.DecimalType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType)
_TIMES = (T.DateType, T.TimestampType, T.TimestampNTZType)


def family(dtype: T.DataType) -> str:
    """Type name without length, precision, scale or element type."""
    return FAMILIES.get(type(dtype), dtype.simpleString())


def common_type(left: T.DataType, right: T.DataType) -> T.DataType:
    """The type two cells are compared in: one that holds every value of both, or else text.

    Numbers without such a type meet as plain digits (see :func:`as_common`), so that equal ones are equal;
    a date is compared with a timestamp as its first instant.
    """
    if left == right:
        return left
    if type(left) in _INTEGRAL and type(right) in _INTEGRAL:
        return max(left, right, key=lambda t: _INTEGRAL.index(type(t)))
    numeric = (*_INTEGRAL, *_FLOATING, T.DecimalType)
    if isinstance(left, numeric) and isinstance(right, numeric):
        if isinstance(left, _FLOATING) or isinstance(right, _FLOATING):
            # A double holds every value but those of bigint and decimal: with these it meets as plain digits.
            exact = T.LongType() in (left, right) or isinstance(left, T.DecimalType) or isinstance(right, T.DecimalType)
            return T.StringType() if exact else T.DoubleType()
        wide = [_as_decimal(t) for t in (left, right)]
        scale = max(t.scale for t in wide)
        whole = max(t.precision - t.scale for t in wide)
        return T.DecimalType(whole + scale, scale) if whole + scale <= 38 else T.StringType()
    if isinstance(left, _TIMES) and isinstance(right, _TIMES):
        return T.TimestampType() if T.TimestampType() in (left, right) else T.TimestampNTZType()
    if family(left) == family(right) and family(left) in ("array", "struct", "map"):
        raise ValueError(f"cannot compare {left.simpleString()} with {right.simpleString()}; map the schema first")
    return T.StringType()


def _as_decimal(dtype: T.DataType) -> T.DecimalType:
    # Digits of the largest value of each integral type.
    return dtype if isinstance(dtype, T.DecimalType) else T.DecimalType((3, 5, 10, 19)[_INTEGRAL.index(type(dtype))], 0)


def as_common(value: Column, dtype: T.DataType, common: T.DataType) -> Column:
    """``value`` in the type found by :func:`common_type`; numbers that become text in one spelling each."""
    if dtype == common:
        return value
    if isinstance(common, T.StringType):
        if isinstance(dtype, T.DecimalType):
            return _digits(value, dtype.scale)
        if isinstance(dtype, _FLOATING):
            return _plain(value)
    return value.cast(common)


def _digits(value: Column, scale: int) -> Column:
    """A decimal without the zeros that end its fraction."""
    text = value.cast("string")
    return F.regexp_replace(text, "\\.?0+$", "") if scale > 0 else text


def _plain(value: Column) -> Column:
    """The shortest digits that make out a floating-point number, without an exponent.

    So it equals the decimal with these digits, and of two decimals that round to it the other one differs. What has no
    such spelling in 38 digits (next to zero, beyond 10^38, not a number) keeps its own, which no decimal has.
    """
    size, shortest = F.abs(value.cast("double")), value.cast("string")

    def spelt(scale: int) -> Column:
        return _digits(shortest.try_cast(T.DecimalType(38, scale)), scale)

    whole = F.rint(value.cast("double")) == value.cast("double")
    text = F.when(whole & (size < 1e38), spelt(0)).when(~whole & (size >= 1e-5), spelt(22)).when(~whole & (size >= 1e-21), spelt(38))
    return F.coalesce(text, shortest)


def common_key_type(left: T.DataType, right: T.DataType) -> T.DataType:
    """As :func:`common_type`, but keys must widen without loss."""
    dtype = common_type(left, right)
    exact = left == right or (type(left) in _INTEGRAL and type(right) in _INTEGRAL) or (
        family(left) == family(right) == "decimal" and isinstance(dtype, T.DecimalType)
    ) or (isinstance(left, _FLOATING) and isinstance(right, _FLOATING)) or family(left) == family(right) == "string"
    if not exact:
        raise ValueError(
            f"key types {left.simpleString()} and {right.simpleString()} have no lossless common type; "
            "map the schema first"
        )
    return dtype


def has_map(dtype: T.DataType) -> bool:
    if isinstance(dtype, T.MapType):
        return True
    if isinstance(dtype, T.ArrayType):
        return has_map(dtype.elementType)
    if isinstance(dtype, T.StructType):
        return any(has_map(f.dataType) for f in dtype.fields)
    return False


def comparable(value: Column, dtype: T.DataType) -> Column:
    """``value`` with every map turned into its sorted entries: maps can be neither compared nor hashed."""
    return canonical(value, dtype) if has_map(dtype) else value


def canonical(value: Column, dtype: T.DataType) -> Column:
    """A nested value rebuilt so that equal values look equal: maps as sorted entries, no negative zeros."""
    if isinstance(dtype, T.MapType):
        return F.array_sort(
            F.transform(
                F.map_entries(value),
                lambda e: F.struct(
                    canonical(e["key"], dtype.keyType).alias("key"),
                    canonical(e["value"], dtype.valueType).alias("value"),
                ),
            )
        )
    if isinstance(dtype, T.ArrayType):
        return F.transform(value, lambda e: canonical(e, dtype.elementType))
    if isinstance(dtype, T.StructType):
        fields = [canonical(value.getField(f.name), f.dataType).alias(f.name) for f in dtype.fields]
        return F.when(value.isNotNull(), F.struct(*fields))
    if isinstance(dtype, _FLOATING):
        return value + F.lit(0.0).cast(dtype)
    return value

