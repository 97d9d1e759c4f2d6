"""The token dictionary: (hash, plaintext) pairs of chosen fields."""

from __future__ import annotations

from collections.abc import Mapping
from itertools import groupby

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from maskwright.functions.keyed import (
    DEFAULT_ALGORITHM,
    algorithm_named,
    checked_key,
    token,
)
from maskwright.functions.message import text_form
from maskwright.plans.paths import Place, Step, parse, quoted, read, value_of
from maskwright.plans.settings import (
    require_name,
    require_some,
    require_text_form,
    with_attributes,
)


def key_hash_dictionary(
    df: DataFrame,
    paths: Mapping[str, str],
    *,
    key: str,
    hash_name: str = "hash",
    plaintext_name: str = "plaintext",
    algorithm: str | None = DEFAULT_ALGORITHM,
    attributes: Mapping[str, str] | None = None,
    reference_crc32: bool = False,
    together: bool = False,
) -> DataFrame:
    """One row for each non-empty value that the paths select.

    ``paths`` goes from a free label to a path; labels only order the pairs of a
    row. Repeated values give repeated pairs. The table is read once and nothing
    is shuffled: all values of a row are exploded, filtered, and hashed after that.

    ``together`` is for values that come often, such as words: each task sorts its values before
    it hashes them, so that files of the pairs hold equal ones side by side, in few bytes. The
    order of the rows is lost. Streams can't be sorted.
    """
    checked_key(key)
    require_some(paths)
    require_name(hash_name, "hash_name")
    require_name(plaintext_name, "plaintext_name")
    if hash_name.lower() == plaintext_name.lower():
        raise ValueError("hash_name and plaintext_name must differ")
    chosen = algorithm_named(algorithm, reference_crc32=reference_crc32)

    texts = _texts(_places(df.schema, paths, attributes))
    plaintext = F.col(quoted(plaintext_name))
    pairs = df.select(F.explode(texts).alias(plaintext_name))
    pairs = pairs.where(plaintext.isNotNull() & (plaintext != ""))
    if together:
        pairs = pairs.sortWithinPartitions(plaintext)
    return pairs.select(token(plaintext, key, chosen).alias(hash_name), plaintext)


def count_of_pairs(
    schema: T.StructType, paths: Mapping[str, str], attributes: Mapping[str, str] | None = None
) -> Column:
    """How many pairs a record of this schema gives, as a column."""
    texts = _texts(_places(schema, paths, attributes))
    return F.size(F.filter(texts, lambda text: text.isNotNull() & (text != ""))).cast("bigint")


def _places(
    schema: T.StructType, paths: Mapping[str, str], attributes: Mapping[str, str] | None
) -> list[Place]:
    places = []
    for label in sorted(paths):
        path = parse(with_attributes(paths[label], attributes))
        found = [place for place in path.places(schema) if place.exists]
        places += [require_text_form(place, path) for place in found]
    return places


def _texts(places: list[Place]) -> Column:
    """All values of the places as one flat array of strings, empty for none."""
    arrays = []
    for many, group in groupby(places, lambda place: place.depth > 0):
        if many:
            arrays += [_flat_texts(place) for place in group]
        else:
            arrays.append(F.array(*[text_form(value_of(place), place.type) for place in group]))
    if not arrays:
        return _no_texts()
    return F.concat(*arrays) if len(arrays) > 1 else arrays[0]


def _no_texts() -> Column:
    return F.array().cast("array<string>")


def _flat_texts(place: Place) -> Column:
    *above, last = place.steps
    if last.open:
        texts = read(None, tuple(above), lambda line: _elements(line[-1], place, last))
    else:
        texts = read(None, place.steps, lambda line: text_form(line[-1], place.type))
    for _ in range(place.depth - 1):
        # A null array among others would make the flat array null.
        texts = F.flatten(F.filter(texts, lambda inner: inner.isNotNull()))
    return F.coalesce(texts, _no_texts())


def _elements(node: Column, place: Place, step: Step) -> Column:
    values = F.map_values(node) if step.in_map else node
    if isinstance(place.type, T.TimestampType):
        return F.transform(values, lambda value: text_form(value, place.type))
    return values.cast("array<string>")
