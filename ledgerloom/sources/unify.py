"""One schema for frames whose types clash.

Files of different ages may hold one field under different types: an id
as number and as text, a quantity as integer and as decimal, also inside
arrays of structs. ``common_type`` is the least type that holds the
values of both, ``conform`` turns a column into it. Both follow the
types only, so the work stays a projection of the scan.

* integers: the wider; numbers that are exact: a decimal with the digits
  of both, a double where those are more than 38 or a side is one;
* date and timestamp: timestamp; an untyped null: the other side;
* structs, arrays and maps: by their parts, struct fields by name without
  case, absent ones null; a null struct stays null;
* anything else: text (nested values as JSON).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# digits of the integer types
_DIGITS = {T.ByteType: 3, T.ShortType: 5, T.IntegerType: 10, T.LongType: 19}


def _numbers(a: T.DataType, b: T.DataType) -> T.DataType:
    if type(a) in _DIGITS and type(b) in _DIGITS:
        return max(a, b, key=lambda t: _DIGITS[type(t)])
    split = []
    for t in (a, b):
        if isinstance(t, T.DecimalType):
            split.append((t.precision - t.scale, t.scale))
        elif type(t) in _DIGITS:
            split.append((_DIGITS[type(t)], 0))
    if len(split) == 2:
        whole, scale = (max(pair) for pair in zip(*split))
        if whole + scale <= 38:
            return T.DecimalType(whole + scale, scale)
    return T.DoubleType()


def common_type(a: T.DataType, b: T.DataType) -> T.DataType:
    """The least type that holds the values of both."""
    if a == b or isinstance(b, T.NullType):
        return a
    if isinstance(a, T.NullType):
        return b
    if isinstance(a, T.StructType) and isinstance(b, T.StructType):
        return common_schema(a, b)
    if isinstance(a, T.ArrayType) and isinstance(b, T.ArrayType):
        return T.ArrayType(common_type(a.elementType, b.elementType))
    if isinstance(a, T.MapType) and isinstance(b, T.MapType):
        return T.MapType(common_type(a.keyType, b.keyType), common_type(a.valueType, b.valueType))
    if isinstance(a, T.NumericType) and isinstance(b, T.NumericType):
        return _numbers(a, b)
    if {type(a), type(b)} == {T.DateType, T.TimestampType}:
        return T.TimestampType()
    return T.StringType()


def common_schema(a: T.StructType, b: T.StructType) -> T.StructType:
    """The fields of both by name without case, named as first met."""
    found = {f.name.lower(): f for f in a.fields}
    for f in b.fields:
        own = found.get(f.name.lower())
        found[f.name.lower()] = T.StructField(own.name, common_type(own.dataType, f.dataType)) if own else f
    return T.StructType([T.StructField(f.name, f.dataType) for f in found.values()])


def _fields(have: T.StructType, want: T.StructType, get) -> list[Column]:
    own = {f.name.lower(): f for f in have.fields}
    out = []
    for f in want.fields:
        source = own.get(f.name.lower())
        value = conform(get(source.name), source.dataType, f.dataType) if source else F.lit(None).cast(f.dataType)
        out.append(value.alias(f.name))
    return out


def conform(column: Column, have: T.DataType, want: T.DataType) -> Column:
    """``column`` of type ``have`` as the common type ``want``."""
    if have == want:
        return column
    if isinstance(have, T.NullType):
        return F.lit(None).cast(want)
    if isinstance(want, T.StructType):
        return F.when(column.isNotNull(), F.struct(*_fields(have, want, column.getField)))
    if isinstance(want, T.ArrayType):
        return F.transform(column, lambda e: conform(e, have.elementType, want.elementType))
    if isinstance(want, T.MapType):
        column = F.transform_values(column, lambda _, v: conform(v, have.valueType, want.valueType))
        return F.transform_keys(column, lambda k, _: conform(k, have.keyType, want.keyType))
    if isinstance(have, (T.StructType, T.ArrayType, T.MapType)):
        return F.to_json(column)
    return column.cast(want)


def clash(*frames: DataFrame) -> bool:
    """Whether two frames hold one column under different types."""
    seen: dict[str, str] = {}
    pairs = [(f.name.lower(), f.dataType.simpleString()) for df in frames for f in df.schema.fields]
    return any(seen.setdefault(name, kind) != kind for name, kind in pairs)


def aligned(*frames: DataFrame) -> list[DataFrame]:
    """The frames with the columns and types of their common schema."""
    want = reduce(common_schema, [df.schema for df in frames])
    return [df.select(*_fields(df.schema, want, lambda n, df=df: df[f"`{n}`"])) for df in frames]
