"""Which types hold the values of others: a lattice of widening types, and rows brought up to it."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

_WHOLE = [T.ByteType, T.ShortType, T.IntegerType, T.LongType]
_DIGITS = dict(zip(_WHOLE, (3, 5, 10, 19)))
# Whole numbers that a type of floating point holds exactly.
_EXACT = {T.FloatType: _WHOLE[:2], T.DoubleType: _WHOLE[:3]}


def join_types(a: T.DataType, b: T.DataType) -> T.DataType | None:
    """The narrowest type that holds all values of both, without loss; None if there is none."""
    if a == b:
        return a
    for one, other in ((a, b), (b, a)):
        if isinstance(one, T.NullType):
            return other
        if isinstance(one, T.DecimalType) and type(other) in _DIGITS:
            return _decimals(one, T.DecimalType(_DIGITS[type(other)], 0))
        if type(one) in _EXACT and type(other) in _EXACT[type(one)]:
            return one
        if isinstance(one, T.FloatType) and isinstance(other, (T.DoubleType, T.IntegerType)):
            return T.DoubleType()
    if type(a) in _WHOLE and type(b) in _WHOLE:
        return max(a, b, key=lambda kind: _WHOLE.index(type(kind)))
    if isinstance(a, T.DecimalType) and isinstance(b, T.DecimalType):
        return _decimals(a, b)
    if isinstance(a, T.ArrayType) and isinstance(b, T.ArrayType):
        element = join_types(a.elementType, b.elementType)
        return element and T.ArrayType(element, a.containsNull or b.containsNull)
    if isinstance(a, T.MapType) and isinstance(b, T.MapType):
        value = join_types(a.valueType, b.valueType)
        return T.MapType(a.keyType, value, True) if value and a.keyType == b.keyType else None
    if isinstance(a, T.StructType) and isinstance(b, T.StructType):
        try:
            return join_schemas(a, b)
        except ValueError:
            return None
    return None


def _decimals(a: T.DecimalType, b: T.DecimalType) -> T.DecimalType | None:
    scale = max(a.scale, b.scale)
    precision = max(a.precision - a.scale, b.precision - b.scale) + scale
    return T.DecimalType(precision, scale) if precision <= 38 else None


def join_schemas(a: T.StructType, b: T.StructType, rule=str) -> T.StructType:
    """The columns of both, by name (names are compared through ``rule``), each in the narrowest type that holds both.

    Columns of ``a`` come first. ``ValueError`` names the columns that have no common type.
    """
    others = {rule(field.name): field for field in b}
    fields, misfits = [], []
    for field in a:
        other = others.pop(rule(field.name), None)
        kind = field.dataType if other is None else join_types(field.dataType, other.dataType)
        if kind is None:
            misfits.append(field.name)
        fields.append(T.StructField(field.name, kind or field.dataType, field.nullable and (other is None or other.nullable)))
    if misfits:
        raise ValueError(f"no type holds both values of {misfits}")
    return T.StructType([*fields, *(T.StructField(f.name, f.dataType) for f in b if rule(f.name) in others)])


def holds(stored: T.DataType, given: T.DataType) -> bool:
    """Whether every value of one type can be stored as another, but for nullability inside."""
    joined = join_types(given, stored)
    return joined is not None and joined.simpleString() == stored.simpleString()


def widened(value: Column, given: T.DataType, stored: T.DataType) -> Column:
    """A column in a type that holds it: fields of structs go by name, absent ones are null."""
    if given == stored:
        return value
    if isinstance(given, T.StructType) and isinstance(stored, T.StructType):
        own = {field.name: field.dataType for field in given}
        fields = [
            (widened(value[f.name], own[f.name], f.dataType) if f.name in own else F.lit(None).cast(f.dataType)).alias(f.name)
            for f in stored
        ]
        return F.when(value.isNotNull(), F.struct(*fields))
    if isinstance(given, T.ArrayType) and isinstance(stored, T.ArrayType):
        return F.transform(value, lambda one: widened(one, given.elementType, stored.elementType))
    if isinstance(given, T.MapType) and isinstance(stored, T.MapType):
        return F.transform_values(value, lambda _, one: widened(one, given.valueType, stored.valueType))
    return value.cast(stored)
