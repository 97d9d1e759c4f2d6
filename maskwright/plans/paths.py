"""Field addresses and what they mean on a schema.

A path such as ``/person/name``, ``/tags[*]``, ``//ssn`` or ``../id`` is resolved
once, against ``df.schema``, into the fields it selects. Reading and replacing
those fields are then ordinary column expressions: ``getField``/``withField`` for
structs and higher-order functions for arrays and maps.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_SEGMENT = re.compile(
    r"""(?P<slash>//?)?
        (?P<name>\.\.?(?=[/\[]|$) | \* | '[^']+' | "[^"]+" | [^/\[\]'"*]+)?
        (?P<subscripts>(?:\[(?:\*|-?\d+|'[^']*'|"[^"]*")\])*)""",
    re.VERBOSE,
)
_SUBSCRIPT = re.compile(r"\[([^\]]*)\]")


@dataclass(frozen=True)
class Step:
    """One step down: a struct ``field``, an array ``index``, a map ``key``, or
    ``each`` element of an array or value of a map."""

    kind: str
    name: str | int | None = None
    in_map: bool = False

    @property
    def open(self) -> bool:
        return self.kind == "each"


@dataclass(frozen=True)
class Place:
    """A field of the schema: the steps to it and the type after each step.

    ``shared`` counts the leading steps taken over from the place a relative
    path started at: those point into the same array element or map value.
    A last type of None marks a field that the schema does not have.
    """

    steps: tuple[Step, ...] = ()
    types: tuple[T.DataType | None, ...] = ()
    shared: int = 0

    @property
    def type(self) -> T.DataType | None:
        return self.types[-1]

    @property
    def top(self) -> str:
        return self.steps[0].name

    @property
    def name(self) -> str:
        return next(s.name for s in reversed(self.steps) if s.kind == "field")

    @property
    def is_root(self) -> bool:
        return not self.steps

    @property
    def exists(self) -> bool:
        return self.type is not None

    @property
    def depth(self) -> int:
        """How many array layers reading it adds."""
        return sum(step.open for step in self.steps[self.shared :])

    def down(self, step: Step, type: T.DataType | None) -> Place:
        return Place(self.steps + (step,), self.types + (type,), self.shared)

    def up(self) -> Place:
        return Place(
            self.steps[:-1], self.types[:-1], min(self.shared, len(self.steps) - 1)
        )


def root_of(schema: T.StructType) -> Place:
    return Place((), (schema,))


@dataclass(frozen=True)
class Path:
    """A path text cut into moves, not yet tied to a schema."""

    text: str
    absolute: bool
    moves: tuple[tuple[str, str | int | None], ...]

    @property
    def spreads(self) -> bool:
        """Whether it can select fields by more than their exact names."""
        return any(move in ("any", "descend", "descend_any") for move, _ in self.moves)

    @property
    def top(self) -> str | None:
        """The top-level column it names, if it starts with one."""
        if self.absolute and self.moves and self.moves[0][0] == "child":
            return self.moves[0][1]
        return None

    def places(self, schema: T.StructType, at: Place | None = None) -> list[Place]:
        """The places it selects, in schema order, starting at the root or at a place."""
        if self.absolute or at is None:
            places = [root_of(schema)]
        else:
            places = [Place(at.steps, at.types, len(at.steps))]
        folded = name_folding()
        for move, name in self.moves:
            places = [found for place in places for found in _MOVES[move](place, name, folded)]
        return places


def parse(text: str) -> Path:
    if not isinstance(text, str) or not text.startswith(("/", ".")):
        raise ValueError(f"not a field path: {text!r}; it must start with '/' or '.'")
    if text == "/":
        return Path(text, True, ())
    moves: list[tuple[str, str | int | None]] = []
    position = 0
    while position < len(text):
        found = _SEGMENT.match(text, position)
        slash, name, subscripts = found.group("slash", "name", "subscripts")
        starts = position == 0
        position = found.end()
        if name is None or (slash is None and not (starts and name in (".", ".."))):
            raise ValueError(f"not a field path: {text!r}")
        moves.extend(_moves_of(slash, name))
        moves.extend(("subscript", _subscript(s)) for s in _SUBSCRIPT.findall(subscripts))
    return Path(text, text.startswith("/"), tuple(moves))


def _moves_of(slash: str | None, name: str):
    deep = slash == "//"
    if name == ".":
        return []
    if name == "..":
        return [("parent", None)]
    if name == "*":
        return [("descend_any" if deep else "any", None)]
    return [("descend" if deep else "child", _unquoted(name))]


def _subscript(text: str) -> str | int | None:
    if text == "*":
        return None
    return _unquoted(text) if text[0] in "'\"" else int(text)


def _unquoted(text: str) -> str:
    return text[1:-1] if text[0] in "'\"" else text


def name_folding() -> Callable[[str], str]:
    """What to compare column names by: themselves, or their lower case forms."""
    session = SparkSession.getActiveSession()
    exact = session and session.conf.get("spark.sql.caseSensitive", "false") == "true"
    return str if exact else str.lower


def field_named(
    schema: T.StructType, name: str, folded: Callable[[str], str]
) -> T.StructField | None:
    wanted = folded(name)
    return next((field for field in schema.fields if folded(field.name) == wanted), None)


def _child(place: Place, name: str, folded: Callable[[str], str]) -> list[Place]:
    if not isinstance(place.type, T.StructType):
        return []
    field = field_named(place.type, name, folded)
    if field is None:
        return [place.down(Step("field", name), None)]
    return [place.down(Step("field", field.name), field.dataType)]


def _any(place: Place, *_) -> list[Place]:
    if not isinstance(place.type, T.StructType):
        return []
    return [place.down(Step("field", f.name), f.dataType) for f in place.type.fields]


def _descend(place: Place, name: str | None, folded: Callable[[str], str]) -> list[Place]:
    found = []
    for child in _any(place):
        if name is None or folded(child.name) == folded(name):
            found.append(child)
        found.extend(_descend(child, name, folded))
    if isinstance(place.type, (T.ArrayType, T.MapType)):
        for element in _subscripted(place, None):
            found.extend(_descend(element, name, folded))
    return found


def _subscripted(place: Place, subscript: str | int | None, *_) -> list[Place]:
    if isinstance(place.type, T.ArrayType) and not isinstance(subscript, str):
        step = Step("each") if subscript is None else Step("index", subscript)
        return [place.down(step, place.type.elementType)]
    if isinstance(place.type, T.MapType) and not isinstance(subscript, int):
        step = Step("each", None, True) if subscript is None else Step("key", subscript, True)
        return [place.down(step, place.type.valueType)]
    return []


def _parent(place: Place, *_) -> list[Place]:
    return [] if place.is_root else [place.up()]


_MOVES = {
    "child": _child,
    "any": _any,
    "descend": _descend,
    "descend_any": _descend,
    "subscript": _subscripted,
    "parent": _parent,
}


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _enter(node: Column | None, step: Step) -> Column:
    """The one value a closed step leads to; ``None`` is the row itself."""
    if step.kind == "field":
        return F.col(quoted(step.name)) if node is None else node.getField(step.name)
    if step.kind == "index" and step.name >= 0:
        return F.get(node, F.lit(step.name))
    return F.try_element_at(node, F.lit(step.name))


def read(
    node: Column | None,
    steps: tuple[Step, ...],
    leaf: Callable[[list[Column | None]], Column],
    above: Sequence[Column | None] = (),
) -> Column:
    """``leaf`` of every value the steps lead to, in one array layer for each open step.

    ``leaf`` gets all values met on the way, from the row down to the field.
    """
    line = [*above, node]
    if not steps:
        return leaf(line)
    step, rest = steps[0], steps[1:]
    if not step.open:
        return read(_enter(node, step), rest, leaf, line)
    values = F.map_values(node) if step.in_map else node
    return F.transform(values, lambda value: read(value, rest, leaf, line))


def value_of(place: Place, line: Sequence[Column | None] = (None,)) -> Column:
    """The value of a place with no open steps, seen from a line of values."""
    return read(line[place.shared], place.steps[place.shared :], lambda found: found[-1])


@dataclass(frozen=True)
class Replacement:
    """A new value for a place, from the line of values down to it and, if there
    is one, its own entry of ``digests``, an array shaped like the open steps."""

    place: Place
    make: Callable[[list[Column | None], Column | None], Column]
    digests: Column | None = None


def replaced(replacements: list[Replacement]) -> dict[str, Column]:
    """Top-level columns that carry the new values; all read the old ones."""
    columns = {}
    for top, group in _by_first_step([(r, r.place.steps, r.digests) for r in replacements]):
        columns[top.name] = _rewritten(_enter(None, top), group, [None])
    return columns


def _by_first_step(pending):
    groups: dict[Step, list] = {}
    for replacement, steps, digests in pending:
        groups.setdefault(steps[0], []).append((replacement, steps[1:], digests))
    return groups.items()


def _rewritten(node: Column, pending: list, above: list[Column | None]) -> Column:
    line = [*above, node]
    for replacement, steps, digests in pending:
        if not steps:
            return replacement.make(line, digests)
    result = node
    for step, group in _by_first_step(pending):
        if step.kind == "field":
            new = _rewritten(node.getField(step.name), group, line)
            result = result.withField(quoted(step.name), new)
        elif step.in_map:
            result = _each_value(node, step, group, line)
        else:
            result = _each_element(node, step, group, line)
    return result


def _each_element(node: Column, step: Step, group: list, line: list) -> Column:
    def one(value: Column, at: Column) -> Column:
        if step.open:
            return _rewritten(value, _at(group, at), line)
        wanted = step.name if step.name >= 0 else F.size(node) + step.name
        return _where(at == wanted, value, group, line)

    return F.transform(node, one)


def _each_value(node: Column, step: Step, group: list, line: list) -> Column:
    if not step.open:
        return F.transform_values(
            node, lambda key, value: _where(key == step.name, value, group, line)
        )
    if all(digests is None for _, _, digests in group):
        return F.transform_values(node, lambda _, value: _rewritten(value, group, line))

    # Digests are found by position, which only an array of entries tells.
    def one(entry: Column, at: Column) -> Column:
        new = _rewritten(entry.getField("value"), _at(group, at), line)
        return F.struct(entry.getField("key").alias("key"), new.alias("value"))

    return F.map_from_entries(F.transform(F.map_entries(node), one))


def _at(group: list, position: Column) -> list:
    return [(r, s, d if d is None else F.get(d, position)) for r, s, d in group]


def _where(chosen: Column, value: Column, group: list, line: list) -> Column:
    """The new value for the chosen entry; the others as they are, or as text
    where the chosen one turns from another type into a digest."""
    ends = any(not steps for _, steps, _ in group)
    kept = value.cast("string") if ends else value
    return F.when(chosen, _rewritten(value, group, line)).otherwise(kept)
