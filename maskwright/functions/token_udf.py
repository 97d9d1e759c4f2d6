"""Tokens of whole batches as one Arrow UDF, for SQL functions that hold a key."""

from __future__ import annotations

import base64
import hashlib
import sys
import zlib
from collections.abc import Callable

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import functions as F

from maskwright.functions import digests
from maskwright.functions.message import BLANK_CHARACTERS

cloudpickle.register_pickle_by_value(sys.modules[__name__])

_ONE_BY_ONE: dict[str, Callable[[bytes], str]] = {
    "hash-crc32": lambda m: zlib.crc32(m).to_bytes(4, "little").hex(),
    "hash-sha256": lambda m: hashlib.sha256(m).hexdigest(),
    "hash-sha384": lambda m: hashlib.sha384(m).hexdigest(),
    "hash-sha512": lambda m: hashlib.sha512(m).hexdigest(),
}


def token_udf(algorithm: str, key: str):
    """An Arrow UDF from a string to its token by the algorithm of that id."""
    start, digest = key.encode(), _ONE_BY_ONE.get(algorithm)
    in_batch = None if digest else digests.BATCH_DIGESTS[algorithm]
    blank = BLANK_CHARACTERS

    def message(text: str | None) -> bytes | None:
        if text is None or not text.strip(blank):
            return None
        octets = text.encode()
        return start + octets + base64.b64encode(octets)

    def tokens(batch: pa.Array) -> pa.Array:
        texts = batch.to_pylist()
        messages = [message(text) for text in texts]
        if digest:
            found = [None if m is None else digest(m) for m in messages]
        else:
            found = in_batch(pa.array(messages, pa.binary())).to_pylist()
        return pa.array([t if d is None else d for t, d in zip(texts, found)], pa.string())

    return F.arrow_udf(tokens, "string")
