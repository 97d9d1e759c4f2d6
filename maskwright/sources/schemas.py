"""Record schemas: from Avro JSON, and the member example."""

from __future__ import annotations

import json
from collections.abc import Mapping
from typing import Any

from pyspark.sql import types as T

# Avro type names and the Spark types that hold them.
_PRIMITIVES = {
    "null": T.NullType(),
    "boolean": T.BooleanType(),
    "int": T.IntegerType(),
    "long": T.LongType(),
    "float": T.FloatType(),
    "double": T.DoubleType(),
    "bytes": T.BinaryType(),
    "string": T.StringType(),
}

MEMBER_FIELDS = ("member_id", "first_name", "last_name", "phone_number", "parent_name")
HASHED_MEMBER_FIELDS = ("hashed_first_name", "hashed_last_name")


def strings(*names: str) -> T.StructType:
    """A schema of nullable strings."""
    return T.StructType([T.StructField(name, T.StringType()) for name in names])


MEMBER_INPUT = strings(*MEMBER_FIELDS)
MEMBER = strings(*MEMBER_FIELDS, *HASHED_MEMBER_FIELDS)


def schema_from_avro(record: str | Mapping[str, Any]) -> T.StructType:
    """The Spark schema of an Avro record: primitives, nullable unions, records,
    arrays and maps."""
    if isinstance(record, str):
        record = json.loads(record)
    schema, _ = _type(record)
    if not isinstance(schema, T.StructType):
        raise ValueError("the schema must be an Avro record")
    return schema


def _type(avro: Any) -> tuple[T.DataType, bool]:
    """The Spark type and whether it may be null."""
    if isinstance(avro, list):
        others = [option for option in avro if option != "null"]
        if len(others) != 1:
            raise ValueError(f"only unions of null and one other type are supported: {avro}")
        return _type(others[0])[0], "null" in avro
    if isinstance(avro, str):
        if avro not in _PRIMITIVES:
            raise ValueError(f"unsupported Avro type {avro!r}")
        return _PRIMITIVES[avro], avro == "null"
    kind = avro["type"]
    if kind == "record":
        fields = []
        for field in avro["fields"]:
            type, nullable = _type(field["type"])
            fields.append(T.StructField(field["name"], type, nullable))
        return T.StructType(fields), False
    if kind == "array":
        return T.ArrayType(*_type(avro["items"])), False
    if kind == "map":
        return T.MapType(T.StringType(), *_type(avro["values"])), False
    return _type(kind)
