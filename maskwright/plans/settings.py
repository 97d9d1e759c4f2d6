"""Checks and substitutions made while a plan is built, before any job starts."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import types as T

from maskwright.plans.paths import Path, Place, parse

_ATTRIBUTE = re.compile(r"\$\{([^{}]*)\}")


def with_attributes(text: str, attributes: Mapping[str, str] | None) -> str:
    """The text with each ``${name}`` replaced by that attribute."""

    def value(found: re.Match) -> str:
        name = found.group(1).strip()
        if name not in (attributes or {}):
            raise ValueError(f"no attribute named {name!r} for {text!r}")
        return attributes[name]

    return _ATTRIBUTE.sub(value, text)


def mapping_in_order(
    mapping: Mapping[str, str], attributes: Mapping[str, str] | None
) -> list[tuple[Path, Path]]:
    """(destination, source) pairs, sorted by the destination text."""
    require_some(mapping)
    return [
        (parse(destination), parse(with_attributes(mapping[destination], attributes)))
        for destination in sorted(mapping)
    ]


NO_PATHS = "there is no path to hash"


def require_some(paths: Mapping | Sequence) -> None:
    if not paths:
        raise ValueError(NO_PATHS)


def require_name(name: str, what: str) -> str:
    if not isinstance(name, str) or not name:
        raise ValueError(f"{what} must be a non-empty string")
    return name


def require_text_form(place: Place, path: Path) -> Place:
    """The place, if its values have a plain text form to hash."""
    require_text_type(place.type, f"{path.text!r} selects")
    return place


def require_text_type(kind: T.DataType, what: str) -> None:
    nested = not isinstance(kind, (T.AtomicType, T.NullType))
    if nested or isinstance(kind, (T.BinaryType, T.VariantType)):
        raise ValueError(
            f"{what} a {kind.simpleString()}, which has no plain text form; add a string "
            "column, such as to_json(...), and hash that"
        )
