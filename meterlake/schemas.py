"""Schemas written as ``name type`` text. ``StructType.fromDDL`` needs a running session; table contracts
are constants and must not."""

from __future__ import annotations

from pyspark.sql import types as T

_TYPES = {
    "string": T.StringType(),
    "double": T.DoubleType(),
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "boolean": T.BooleanType(),
    "date": T.DateType(),
    "timestamp": T.TimestampType(),
    "strings": T.ArrayType(T.StringType()),
}


def columns(text: str) -> T.StructType:
    """``"id string not null, paid double"`` as a schema."""
    fields = []
    for part in text.split(","):
        name, kind, *rest = part.split()
        fields.append(T.StructField(name, _TYPES[kind], nullable=rest != ["not", "null"]))
    return T.StructType(fields)
