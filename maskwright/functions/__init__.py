from maskwright.functions.keyed import ALGORITHMS, DEFAULT_ALGORITHM, keyed_hash

__all__ = ["ALGORITHMS", "DEFAULT_ALGORITHM", "keyed_hash"]
