"""The keyed hash: one scalar, seven digests."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from maskwright.functions import digests
from maskwright.functions.message import is_blank, message


@dataclass(frozen=True)
class Algorithm:
    """A digest by name: ``native`` is a Spark expression, ``udf`` makes an Arrow UDF."""

    id: str
    display_name: str
    native: Callable[[Column], Column] | None = None
    udf: Callable[..., Callable[[Column], Column]] | None = None


# Identifiers and display names of the algorithms.
ALGORITHMS = (
    Algorithm("hash-adler32", "adler32", udf=digests.adler32_udf),
    Algorithm("hash-crc32", "crc32", native=digests.crc32),
    Algorithm("hash-crc32c", "crc32c", udf=digests.crc32c_udf),
    Algorithm(
        "hash-farmHashFingerprint64",
        "FarmHash's Fingerprint64",
        udf=digests.farm_fingerprint64_udf,
    ),
    Algorithm("hash-sha256", "sha256", native=digests.sha256),
    Algorithm("hash-sha384", "sha384", native=digests.sha384),
    Algorithm("hash-sha512", "sha512", native=digests.sha512),
)
DEFAULT_ALGORITHM = "sha256"

_BY_NAME = {
    name: algorithm
    for algorithm in ALGORITHMS
    for name in (algorithm.id, algorithm.id.removeprefix("hash-"), algorithm.display_name)
}


def algorithm_named(name: str | None, *, reference_crc32: bool = False) -> Algorithm:
    """The algorithm of that name; SHA-256 for none.

    ``reference_crc32`` makes ``crc32`` mean Adler-32, for tokens that must
    equal ones already made by a system with that mix-up.
    """
    try:
        algorithm = _BY_NAME[name or DEFAULT_ALGORITHM]
    except (KeyError, TypeError):
        known = ", ".join(a.id for a in ALGORITHMS)
        raise ValueError(f"unknown hash algorithm {name!r}; one of {known}") from None
    if reference_crc32 and algorithm.id == "hash-crc32":
        return _BY_NAME["adler32"]
    return algorithm


def checked_key(key: str) -> str:
    """The key itself, if it is a non-empty string."""
    if not isinstance(key, str) or not key:
        raise ValueError("the hash key must be a non-empty string")
    return key


def as_column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def keyed_hash(
    value: Column | str,
    key: str,
    algorithm: str | None = DEFAULT_ALGORITHM,
    *,
    reference_crc32: bool = False,
) -> Column:
    """Token of a value: the hex digest of key, text and base64 of the text.

    Null gives null; empty and all-whitespace texts are returned as they are.
    Other types than strings are hashed by their text form, timestamps by that in the
    session's time zone: a column does not know its type. The result is named
    ``keyed_hash``, since Spark's own name for it would spell out the key.
    """
    text = as_column(value).cast("string")
    return token(text, key, algorithm_named(algorithm, reference_crc32=reference_crc32)).alias(
        "keyed_hash"
    )


def token(text: Column, key: str, algorithm: Algorithm) -> Column:
    """The token of a text, without a name."""
    digest = algorithm.native or algorithm.udf()
    return F.coalesce(digest(message_to_digest(text, key)), text)


def message_to_digest(text: Column, key: str) -> Column:
    """The message of a text, and null where the text stands for itself.

    A digest of it is part of every row's evaluation, not of a CASE branch, so
    Spark computes what it names twice only once.
    """
    return F.when(~is_blank(text), message(checked_key(key), text))
