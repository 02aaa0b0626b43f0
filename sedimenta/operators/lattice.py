"""The least schema that holds two others, and rows brought into it.

Types form a lattice: of two that hold the same kind of thing there is a narrowest one
that holds both without loss (an INT and a BIGINT are a BIGINT, two decimals are one with
the larger number of places on either side). Structs are joined field by field, arrays and
maps by their elements. Types without such a bound (a number and a text) are refused, as
turning one into the other would be a guess.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    ByteType,
    DataType,
    DateType,
    DecimalType,
    DoubleType,
    FloatType,
    IntegerType,
    LongType,
    MapType,
    NullType,
    ShortType,
    StructField,
    StructType,
    TimestampNTZType,
)

_WHOLE = (ByteType, ShortType, IntegerType, LongType)
_DIGITS = dict(zip(_WHOLE, (3, 5, 10, 19), strict=True))
#: Digits that a float or a double holds exactly.
_EXACT = {FloatType: 7, DoubleType: 15}
MOST_DIGITS = 38


class NoCommonType(ValueError):
    """Two types that no type holds without loss."""


def common_type(a: DataType, b: DataType, at: str = "value") -> DataType:
    """The narrowest type that holds all values of both."""
    if a == b or isinstance(b, NullType):
        return a
    if isinstance(a, NullType):
        return b
    if isinstance(a, StructType) and isinstance(b, StructType):
        return common_schema(a, b, at)
    if isinstance(a, ArrayType) and isinstance(b, ArrayType):
        inner = common_type(a.elementType, b.elementType, f"{at}.element")
        return ArrayType(inner, a.containsNull or b.containsNull)
    if isinstance(a, MapType) and isinstance(b, MapType):
        return MapType(
            common_type(a.keyType, b.keyType, f"{at}.key"),
            common_type(a.valueType, b.valueType, f"{at}.value"),
            a.valueContainsNull or b.valueContainsNull,
        )
    number = _common_number(a, b)
    if number is not None:
        return number
    if {type(a), type(b)} == {DateType, TimestampNTZType}:
        return TimestampNTZType()
    raise NoCommonType(f"{at}: no type holds both {a.simpleString()} and {b.simpleString()}")


def _common_number(a: DataType, b: DataType) -> DataType | None:
    if type(a) in _WHOLE and type(b) in _WHOLE:
        return max(a, b, key=lambda t: _WHOLE.index(type(t)))
    if {type(a), type(b)} <= {*_EXACT}:
        return DoubleType()
    sizes = [_decimal_size(t) for t in (a, b)]
    if all(sizes):
        places = max(scale for _, scale in sizes)
        digits = max(whole for whole, _ in sizes) + places
        return DecimalType(digits, places) if digits <= MOST_DIGITS else None
    for number, other in ((a, b), (b, a)):
        if type(number) in _EXACT and type(other) in _DIGITS and _DIGITS[type(other)] <= 10:
            wide = _DIGITS[type(other)] > _EXACT[type(number)]
            return DoubleType() if wide else number
    return None


def _decimal_size(t: DataType) -> tuple[int, int] | None:
    """Digits before and after the point."""
    if isinstance(t, DecimalType):
        return t.precision - t.scale, t.scale
    return (_DIGITS[type(t)], 0) if type(t) in _DIGITS else None


def common_schema(a: StructType, b: StructType, at: str = "") -> StructType:
    """The fields of ``a``, then those that only ``b`` has; a field that one lacks may be NULL."""
    for side in (a, b):
        if len({n.lower() for n in side.names}) < len(side.names):
            raise ValueError(f"{at or 'rows'}: two fields differ in case only")
    other = {f.name.lower(): f for f in b.fields}
    fields = []
    for field in a.fields:
        met = other.pop(field.name.lower(), None)
        if met is None:
            fields.append(StructField(field.name, field.dataType, True, field.metadata))
            continue
        kind = common_type(field.dataType, met.dataType, f"{at}.{field.name}".lstrip("."))
        fields.append(StructField(field.name, kind, field.nullable or met.nullable, field.metadata))
    fields += [StructField(f.name, f.dataType, True, f.metadata) for f in b.fields if f.name.lower() in other]
    return StructType(fields)


def widened(old: DataType, new: DataType) -> bool:
    """Has a value of ``old`` another type in ``new``? A field that was added is none."""
    if isinstance(old, StructType) and isinstance(new, StructType):
        held = {f.name.lower(): f.dataType for f in new.fields}
        return any(widened(f.dataType, held[f.name.lower()]) for f in old.fields)
    if isinstance(old, ArrayType) and isinstance(new, ArrayType):
        return widened(old.elementType, new.elementType)
    if isinstance(old, MapType) and isinstance(new, MapType):
        return widened(old.keyType, new.keyType) or widened(old.valueType, new.valueType)
    return old != new


def to_schema(df: DataFrame, schema: StructType) -> DataFrame:
    """``df`` under a schema that :func:`common_schema` made from its own and another."""
    held = {f.name.lower(): f for f in df.schema.fields}
    columns = []
    for field in schema.fields:
        given = held.get(field.name.lower())
        value = (
            F.lit(None).cast(field.dataType)
            if given is None
            else _lifted(F.col(f"`{given.name}`"), given.dataType, field.dataType)
        )
        columns.append(value.alias(field.name))
    return df.select(*columns)


def _lifted(value: Column, old: DataType, new: DataType) -> Column:
    if old == new:
        return value
    if isinstance(old, StructType) and isinstance(new, StructType):
        held = {f.name.lower(): f for f in old.fields}
        fields = []
        for field in new.fields:
            given = held.get(field.name.lower())
            inner = (
                F.lit(None).cast(field.dataType)
                if given is None
                else _lifted(value.getField(given.name), given.dataType, field.dataType)
            )
            fields.append(inner.alias(field.name))
        return F.when(value.isNotNull(), F.struct(*fields))
    if isinstance(old, ArrayType) and isinstance(new, ArrayType):
        return F.transform(value, lambda x: _lifted(x, old.elementType, new.elementType))
    if isinstance(old, MapType) and isinstance(new, MapType):
        keyed = F.transform_keys(value, lambda k, v: _lifted(k, old.keyType, new.keyType))
        return F.transform_values(keyed, lambda k, v: _lifted(v, old.valueType, new.valueType))
    return value.cast(new)


def union_of(*frames: DataFrame) -> DataFrame:
    """All rows under the least schema that holds them all; columns are matched by name."""
    schema = frames[0].schema
    for df in frames[1:]:
        schema = common_schema(schema, df.schema)
    out = to_schema(frames[0], schema)
    for df in frames[1:]:
        out = out.unionAll(to_schema(df, schema))
    return out
