from maskwright.operators.dictionary import key_hash_dictionary
from maskwright.operators.lookup import hash_lookup, hash_lookup_map
from maskwright.operators.records import hash_fields, nest_fields, project_fields

__all__ = [
    "hash_fields",
    "hash_lookup",
    "hash_lookup_map",
    "key_hash_dictionary",
    "nest_fields",
    "project_fields",
]
