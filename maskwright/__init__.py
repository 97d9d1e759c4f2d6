"""Keyed hashing of fields in Spark tables and streams."""

from maskwright.functions import ALGORITHMS, DEFAULT_ALGORITHM, keyed_hash
from maskwright.functions.sql import hide_keys, register_sql_functions
from maskwright.operators import (
    hash_fields,
    hash_lookup,
    hash_lookup_map,
    key_hash_dictionary,
    nest_fields,
    project_fields,
)

__all__ = [
    "ALGORITHMS",
    "DEFAULT_ALGORITHM",
    "hash_fields",
    "hash_lookup",
    "hash_lookup_map",
    "hide_keys",
    "key_hash_dictionary",
    "keyed_hash",
    "nest_fields",
    "project_fields",
    "register_sql_functions",
]
