"""The schema of each unit, found in one pass, and units grouped by it.

A folder may hold files with different fields. The schema of a JSON file is the least one that
all of its lines fit, merged task by task and then file by file; that of a CSV file is its
header. Files of one schema are then one table, so a job has a plan for each schema and not
for each file.
"""

from __future__ import annotations

import csv
import re
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from maskwright.sources.records import UNIT
from maskwright.sources.routing import (
    BROADCAST_UNITS,
    HEADER,
    LINE,
    SALTS,
    is_record,
    salted,
)
from maskwright.sources.scratch import new_folder, shared_folder

#: Different schemas that one job takes at most: each has a plan and files of its own.
MOST_SCHEMAS = 1_000
KIND = "kind"
_NUMBER = "schema_number"
_ID = "__id"
_SALT = "__salt"

# What stands for another type where it is no field's name.
_TYPE = re.compile(r"`(?:[^`]|``)*`|\b(?:OBJECT(?=<)|(?:VOID|VARIANT|DECIMAL\((\d+),(\d+)\))(?!:))")


@dataclass(frozen=True)
class SchemaGroup:
    """The lines of all units of one schema; None if these are no records at all."""

    schema: T.StructType | None
    lines: DataFrame


def kinds_of_units(
    lines: DataFrame, fmt: str, *, options: Mapping[str, str] | None = None
) -> DataFrame:
    """(unit, kind) of all units with records, by one aggregation. ``schema_of_kind`` reads kinds."""
    if fmt == "json":
        values = lines.where(is_record(fmt, options)).select(
            UNIT, F.try_parse_json(LINE).alias("value")
        )
        return values.groupBy(UNIT).agg(F.schema_of_variant_agg("value").alias(KIND))
    if fmt == "csv" and HEADER in lines.columns:
        return lines.where(HEADER).groupBy(UNIT).agg(F.first(LINE).alias(KIND))
    raise ValueError("schemas are found in JSON lines, and in CSV with a header")


def schema_of_kind(
    kind: str, fmt: str, *, options: Mapping[str, str] | None = None
) -> T.StructType | None:
    """The schema to read units of a kind by; None if their lines are no records.

    JSON numbers are ``bigint``, ``decimal(38,0)`` beyond it, or ``double``; values of several types are
    strings. Fields are in the order of their names. CSV values are strings, in the order
    of the header; of names that differ in case only, or not at all, there is no schema.
    """
    if fmt == "json":
        if not kind.startswith("OBJECT<") or kind == "OBJECT<>":
            return None
        found = T.StructType.fromDDL(_TYPE.sub(_readable, kind)[len("STRUCT<") : -1])
    else:
        given = {k.lower(): v for k, v in (options or {}).items()}
        quote, escape = given.get("quote", '"'), given.get("escape", "\\")
        names = next(
            csv.reader(
                [kind],
                delimiter=given.get("sep", given.get("delimiter", ",")),
                quotechar=quote,
                doublequote=escape == quote,
                escapechar=None if escape == quote else escape,
            )
        )
        found = T.StructType([T.StructField(name, T.StringType()) for name in names])
    folded = {name.lower() for name in found.names}
    return found if len(folded) == len(found.names) and "" not in folded else None


def _readable(match: re.Match) -> str:
    word = match.group()
    if word.startswith("`"):
        return word
    if word == "OBJECT":
        return "STRUCT"
    if match.group(2):
        return "DECIMAL(38,0)" if match.group(2) == "0" else "DOUBLE"
    return "STRING"


def groups_by_schema(
    lines: DataFrame,
    fmt: str,
    *,
    options: Mapping[str, str] | None = None,
    most: int = MOST_SCHEMAS,
) -> list[SchemaGroup]:
    """The lines of ``read_lines`` or ``read_quoted_lines``, parted by the schema of their unit.

    With several schemas the lines are written once below the shared folder, parted by schema,
    so that each group reads its own part and not the whole input.
    """
    shared_folder(lines.sparkSession)
    units = kinds_of_units(lines, fmt, options=options).checkpoint()
    kinds = [row[KIND] for row in units.select(KIND).distinct().limit(10 * most).collect()]
    schemas: dict[str, T.StructType | None] = {}
    numbers: dict[str, int] = {}
    for kind in sorted(kinds):
        schema = schema_of_kind(kind, fmt, options=options)
        name = schema.json() if schema else ""
        schemas[name] = schema
        numbers[kind] = list(schemas).index(name)
    if len(schemas) > most or len(kinds) == 10 * most:
        raise ValueError(f"more than {most} schemas among the files of one job")
    if len(schemas) < 2:
        return [SchemaGroup(schema, lines) for schema in schemas.values()]
    spark = lines.sparkSession
    table = spark.createDataFrame(list(numbers.items()), f"{KIND} string, {_NUMBER} int")
    numbered = units.join(F.broadcast(table), KIND).select(UNIT, _NUMBER)
    path = new_folder(spark, "schemas")
    _with_numbers(lines, numbered).write.partitionBy(_NUMBER).parquet(path)
    return [
        SchemaGroup(schema, spark.read.schema(lines.schema).parquet(f"{path}/{_NUMBER}={i}"))
        for i, schema in enumerate(schemas.values())
    ]


def _with_numbers(lines: DataFrame, units: DataFrame) -> DataFrame:
    """Lines with the number of their unit: units are broadcast as hashes, as far as these tell
    them apart, or joined by a shuffle that spreads the lines of each unit."""
    named = F.xxhash64(UNIT)
    every, names = units.agg(F.count(UNIT), F.count_distinct(named)).first()
    if every <= BROADCAST_UNITS and names == every:
        ids = F.broadcast(units.select(named.alias(_ID), _NUMBER))
        return lines.join(ids, named == F.col(_ID)).drop(_ID)
    each = units.withColumn(_SALT, F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return salted(lines).join(each, [UNIT, _SALT]).drop(_SALT)
