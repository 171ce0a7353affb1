"""A form of any value by which rows can be hashed, grouped and ordered without losing what tells them apart.

Maps have no hash and no order, and entries in any order; variants cannot be grouped; strings with a collation and the two
zeros of floating point are equal to values that are not the same. In canonical form maps are sorted arrays of
entries, variants are their JSON and schema, strings with a collation are bytes, and a zero has its sign beside it.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def is_plain(kind: T.DataType) -> bool:
    """Whether values of a type already are in canonical form."""
    if isinstance(kind, T.StructType):
        return all(is_plain(field.dataType) for field in kind)
    if isinstance(kind, T.ArrayType):
        return is_plain(kind.elementType)
    if isinstance(kind, T.StringType):
        return kind == T.StringType()
    return not isinstance(kind, (T.MapType, T.VariantType, T.FloatType, T.DoubleType))


def canonical(value: Column, kind: T.DataType) -> Column:
    """The canonical form of a column of a type; null stays null."""
    if is_plain(kind):
        return value
    if isinstance(kind, T.StructType):
        fields = [canonical(value[field.name], field.dataType).alias(f"f{n}") for n, field in enumerate(kind)]
        return F.when(value.isNotNull(), F.struct(*fields))
    if isinstance(kind, T.ArrayType):
        return F.transform(value, lambda one: canonical(one, kind.elementType))
    if isinstance(kind, T.MapType):
        entry = T.StructType([T.StructField("key", kind.keyType), T.StructField("value", kind.valueType)])
        plain = F.map_entries(value) if is_plain(entry) else F.transform(F.map_entries(value), lambda one: canonical(one, entry))
        return F.array_sort(plain)
    if isinstance(kind, T.VariantType):
        return F.when(value.isNotNull(), F.struct(F.to_json(value).alias("json"), F.schema_of_variant(value).alias("schema")))
    if isinstance(kind, T.StringType):
        return value.cast("binary")
    return F.when(value.isNotNull(), F.struct(value.alias("number"), F.when(value == 0, value.cast("string")).alias("zero")))
