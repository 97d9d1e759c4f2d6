"""Row-for-row operators: hash fields, nest fields, project fields.

All of them are narrow projections. They keep the number and order of rows and
never shuffle.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from maskwright.functions.keyed import (
    DEFAULT_ALGORITHM,
    Algorithm,
    algorithm_named,
    checked_key,
    message_to_digest,
    token,
)
from maskwright.functions.message import text_form
from maskwright.plans.paths import Path, Place, Replacement, parse, read, replaced, value_of
from maskwright.plans.settings import (
    mapping_in_order,
    require_some,
    require_text_form,
    with_attributes,
)


def hash_fields(
    df: DataFrame,
    mapping: Mapping[str, str],
    *,
    key: str,
    algorithm: str | None = DEFAULT_ALGORITHM,
    attributes: Mapping[str, str] | None = None,
    reference_crc32: bool = False,
) -> DataFrame:
    """Replace each destination field by the keyed hash of its source field.

    ``mapping`` goes from destination path to source path; equal paths hash in
    place. Mappings apply one after the other in the order of their destination
    texts, so a later one sees what an earlier one wrote. A source that is not
    in the schema makes the destination null; if neither exists, nothing happens.
    """
    checked_key(key)
    chosen = algorithm_named(algorithm, reference_crc32=reference_crc32)
    waiting: list[tuple[Place, Place]] = []
    touched: set[str] = set()
    for destination, source in mapping_in_order(mapping, attributes):
        updates = _updates(df.schema, destination, source)
        # Mappings that do not meet go into one projection. A mapping that
        # reads or writes a column which is still waiting starts the next one.
        spreads = destination.spreads or source.spreads
        if waiting and (spreads or touched & _columns_of(destination, source, updates)):
            df = _apply(df, waiting, chosen, key)
            waiting, touched = [], set()
            updates = _updates(df.schema, destination, source)
        waiting += updates
        touched |= {place.top.lower() for place, _ in updates}
    return _apply(df, waiting, chosen, key)


def nest_fields(
    df: DataFrame,
    mapping: Mapping[str, str | Sequence[str]],
    *,
    attributes: Mapping[str, str] | None = None,
) -> DataFrame:
    """Replace each destination by a struct of the fields its source paths select.

    The values stay clear text. Of fields with one name the last one counts.
    """
    require_some(mapping)
    for text in sorted(mapping):
        sources = _parsed(mapping[text], attributes)
        nested = [
            Replacement(place, _nest(_selected(df.schema, sources, place)))
            for place in _destinations(df.schema, parse(text))
        ]
        df = df.withColumns(replaced(nested))
    return df


def project_fields(
    df: DataFrame,
    sources: str | Sequence[str],
    *,
    attributes: Mapping[str, str] | None = None,
) -> DataFrame:
    """Replace the whole row by the fields the source paths select, in clear text.

    A source that selects nothing leaves the rows as they are.
    """
    require_some(sources)
    fields = _selected(df.schema, _parsed(sources, attributes), None)
    if not fields:
        return df
    return df.select(*[value_of(place).alias(name) for name, place in fields.items()])


def _updates(schema: T.StructType, destination: Path, source: Path) -> list[tuple[Place, Place]]:
    """(place to write, place to read) pairs; a place to read may be missing."""
    updates = []
    for place in _destinations(schema, destination):
        found = source.places(schema, place)
        if len(found) > 1 or any(f.depth for f in found):
            raise ValueError(
                f"{source.text!r} selects more than one field for {destination.text!r}, which "
                "would leave clear text there; use nest_fields for that, or the relative path "
                "'.' to hash each field by its own value"
            )
        missing = Place(types=(None,))
        updates.append((place, found[0] if found else missing))
        if found and found[0].exists:
            require_text_form(found[0], source)
    return [(place, read_from) for place, read_from in updates if place.exists or read_from.exists]


def _destinations(schema: T.StructType, path: Path) -> list[Place]:
    places = path.places(schema)
    if any(place.is_root for place in places):
        raise ValueError("the destination is the whole row; use project_fields for that")
    return places


def _columns_of(destination: Path, source: Path, updates: list[tuple[Place, Place]]) -> set[str]:
    names = [destination.top, source.top]
    names += [place.top for pair in updates for place in pair if not place.is_root]
    return {name.lower() for name in names if name}


def _apply(
    df: DataFrame, updates: list[tuple[Place, Place]], algorithm: Algorithm, key: str
) -> DataFrame:
    helpers: dict[str, Column] = {}
    replacements = []
    for place, source in updates:
        closed = all(step.kind == "field" for step in place.steps)
        if not source.exists:
            replacements.append(Replacement(place, lambda *_: F.lit(None).cast("string")))
        elif algorithm.native or closed:
            replacements.append(Replacement(place, _hash(source, algorithm, key)))
        else:
            # A UDF cannot run inside a lambda. So it runs in a column of its own:
            # on the one source value of the row, or on whole arrays of messages,
            # from which the lambda picks by position.
            name = _free_name(df, f"__digests_{len(helpers)}")
            if source.shared:
                helpers[name] = _digests(place, source, algorithm, key)
                replacements.append(Replacement(place, _pick(source), F.col(name)))
            else:
                helpers[name] = token(_text(source), key, algorithm)
                replacements.append(Replacement(place, _column(name)))
    if helpers:
        df = df.withColumns(helpers)
    return df.withColumns(replaced(replacements)).drop(*helpers)


def _free_name(df: DataFrame, wish: str) -> str:
    """``wish``, with as many underscores behind it as it takes to be no column's name."""
    taken = {name.lower() for name in df.columns}
    while wish.lower() in taken:
        wish += "_"
    return wish


def _text(source: Place, *line) -> Column:
    return text_form(value_of(source, *line), source.type)


def _hash(source: Place, algorithm: Algorithm, key: str):
    return lambda line, _: token(_text(source, line), key, algorithm)


def _digests(place: Place, source: Place, algorithm: Algorithm, key: str) -> Column:
    depth = sum(step.open for step in place.steps)
    messages = read(
        None,
        place.steps,
        lambda line: message_to_digest(_text(source, line), key),
    )
    return algorithm.udf(depth)(messages)


def _pick(source: Place):
    return lambda line, digest: F.coalesce(digest, _text(source, line))


def _column(name: str):
    return lambda *_: F.col(name)


def _nest(fields: dict[str, Place]):
    def make(line, _):
        if not fields:
            return F.lit(None).cast("string")
        return F.struct(*[value_of(place, line).alias(name) for name, place in fields.items()])

    return make


def _parsed(sources: str | Sequence[str], attributes: Mapping[str, str] | None) -> list[Path]:
    texts = [sources] if isinstance(sources, str) else sources
    return [parse(with_attributes(text, attributes)) for text in texts]


def _selected(schema: T.StructType, sources: list[Path], at: Place | None) -> dict[str, Place]:
    fields: dict[str, Place] = {}
    for source in sources:
        for place in source.places(schema, at):
            if place.is_root or place.depth:
                raise ValueError(f"{source.text!r} does not select single fields of a row")
            if place.exists:
                fields[place.name] = place
    return fields
