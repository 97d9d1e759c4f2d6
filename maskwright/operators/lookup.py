"""Lookup: names and values in, the same names and hashed values out.

Always SHA-256, and a built-in expression, so a lookup is part of whatever
projection it is used in.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from maskwright.functions.keyed import algorithm_named, as_column, checked_key, token
from maskwright.functions.message import text_form
from maskwright.plans.paths import quoted
from maskwright.plans.settings import require_name, require_text_type


def hash_lookup(
    df: DataFrame,
    coordinates: Sequence[str] | Mapping[str, Column | str],
    *,
    key: str,
    into: str = "lookup",
) -> DataFrame:
    """Add a struct column with the hashed value of each coordinate.

    ``coordinates`` are column names, or names with the columns they stand for.
    The struct itself is never null; without coordinates it has no fields. Values
    have the same text form as in ``hash_fields``, and the same types are refused.
    """
    checked_key(key)
    require_name(into, "into")
    if not isinstance(coordinates, Mapping):
        coordinates = {name: F.col(quoted(name)) for name in coordinates}
    values = {name: as_column(value) for name, value in coordinates.items()}
    kinds = [field.dataType for field in df.select(*values.values()).schema.fields]
    hashed = []
    for (name, value), kind in zip(values.items(), kinds):
        require_text_type(kind, f"{name!r} is")
        hashed.append(token(text_form(value, kind), key, algorithm_named(None)).alias(name))
    return df.withColumn(into, F.struct(*hashed))


def hash_lookup_map(coordinates: Column | str, key: str) -> Column:
    """The map with each value hashed; names may differ from row to row.

    The result is named ``hash_lookup``. Values are hashed by Spark's text form.
    """
    checked_key(key)
    algorithm = algorithm_named(None)
    return F.transform_values(
        as_column(coordinates), lambda _, value: token(value.cast("string"), key, algorithm)
    ).alias("hash_lookup")
