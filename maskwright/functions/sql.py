"""The keyed hash for Spark SQL, and keeping keys out of sight."""

from __future__ import annotations

from pyspark.sql import SparkSession

from maskwright.functions.keyed import ALGORITHMS, checked_key
from maskwright.functions.token_udf import token_udf

_REDACTION = "spark.sql.redaction.string.regex"
_BINARY_CONSTANT = "0x[0-9A-F]+"


def register_sql_functions(spark: SparkSession, key: str) -> list[str]:
    """Temporary SQL functions ``keyed_sha256(value)`` and so on, with the key built in.

    They are Arrow UDFs that hold the key, which is thus in no SQL text, function body or
    plan. ``keyed_hash`` on columns is the faster form of the digests that Spark has.
    """
    checked_key(key)
    names = []
    for algorithm in ALGORITHMS:
        name = "keyed_" + algorithm.id.removeprefix("hash-").lower()
        spark.udf.register(name, token_udf(algorithm.id, key))
        names.append(name)
    return names


def hide_keys(spark: SparkSession) -> None:
    """Keep keys, and all other binary constants, out of plans as Spark prints them.

    This holds for ``explain`` and for plan descriptions in the UI and the event
    log, and the setting itself gives nothing away. It does not hold for the node
    labels of the UI's plan graph, which Spark never redacts.
    """
    present = spark.conf.get(_REDACTION, None)
    if not present:
        spark.conf.set(_REDACTION, _BINARY_CONSTANT)
    elif _BINARY_CONSTANT not in present.split("|"):
        spark.conf.set(_REDACTION, f"{present}|{_BINARY_CONSTANT}")
