"""Log files as records: a pattern with named pieces gives the columns.

A pattern is a regular expression in which ``%{PIECE:name}`` stands for one of ``PIECES`` and
makes a column of that name, ``%{PIECE}`` for one without a column. A line that fits the whole
pattern begins a record. Other lines, such as those of a stack trace, belong to the record
before them, also where Spark reads them in another task.
"""

from __future__ import annotations

import re
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from maskwright.sources.blocks import joined_by_head
from maskwright.sources.records import UNIT
from maskwright.sources.routing import LINE, PARTITION, read_lines

#: Pieces of log lines. None has a capturing group.
PIECES = {
    "WORD": r"\w+",
    "NOTSPACE": r"\S+",
    "SPACE": r"\s*",
    "DATA": r".*?",
    "REST": r".*",
    "INT": r"[+-]?\d+",
    "NUMBER": r"[+-]?(?:\d+(?:\.\d*)?|\.\d+)(?:[eE][+-]?\d+)?",
    "HEX": r"(?:0[xX])?[0-9a-fA-F]+",
    "UUID": r"[0-9a-fA-F]{8}(?:-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}",
    "QUOTED": r'"(?:[^"\\]|\\.)*"',
    "IP": r"(?:\d{1,3}(?:\.\d{1,3}){3}|(?:[0-9a-fA-F]{0,4}:){2,7}[0-9a-fA-F]{0,4})",
    "HOST": r"[0-9A-Za-z](?:[0-9A-Za-z.-]*[0-9A-Za-z])?",
    "PATH": r"/[^\s\"?#]*",
    "CLASS": r"[A-Za-z_$][\w$]*(?:\.[A-Za-z_$][\w$]*)*",
    "LEVEL": r"(?i:trace|debug|info|notice|warn(?:ing)?|err(?:or)?|crit(?:ical)?|fatal|severe)",
    "DAY": r"\d{4}-\d{2}-\d{2}",
    "TIME": r"\d{2}:\d{2}(?::\d{2}(?:[.,]\d+)?)?",
    "TIMESTAMP": r"\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}(?::\d{2}(?:[.,]\d+)?)?(?:Z|[+-]\d{2}:?\d{2})?",
    "HTTPDATE": r"\d{2}/[A-Za-z]{3}/\d{4}:\d{2}:\d{2}:\d{2} [+-]\d{4}",
    "SYSLOGDATE": r"[A-Za-z]{3} +\d{1,2} \d{2}:\d{2}:\d{2}",
}
CONTINUED = "continued"

_PIECE = re.compile(r"%\{([^{}:]+)(?::([^{}]+))?\}")
_GROUP = re.compile(r"\\.|\[(?:\\.|[^\]\\])*\]|(\((?!\?)|\(\?<(?![=!]))", re.S)


def compiled(pattern: str, pieces: Mapping[str, str] | None = None) -> tuple[str, list[str]]:
    """The regular expression of a pattern and the names of its columns, in order.

    ``pieces`` adds to ``PIECES`` and may itself hold pieces, without names.
    """
    known = {**PIECES, **(pieces or {})}
    names: list[str] = []

    def expression(piece: str, open_: tuple[str, ...]) -> str:
        if piece not in known or piece in open_:
            raise ValueError(f"no piece {piece!r}" if piece not in known else f"{piece!r} holds itself")
        inner = known[piece]
        if any(match.group(2) for match in _PIECE.finditer(inner)):
            raise ValueError(f"the piece {piece!r} names columns of its own")
        _without_groups(inner)
        return _PIECE.sub(lambda m: f"(?:{expression(m.group(1), (*open_, piece))})", inner)

    def replaced(match: re.Match) -> str:
        piece, name = match.groups()
        if name is None:
            return f"(?:{expression(piece, ())})"
        names.append(name)
        return f"({expression(piece, ())})"

    _without_groups(_PIECE.sub("", pattern))
    whole = _PIECE.sub(replaced, pattern)
    if not names:
        raise ValueError("a pattern names at least one column, as %{PIECE:name}")
    if len({name.lower() for name in names}) < len(names):
        raise ValueError(f"a pattern names each column once, not {names}")
    return rf"\A(?s:{whole})\z", names


def _without_groups(expression: str) -> None:
    if any(match.group(1) for match in _GROUP.finditer(expression)):
        raise ValueError(f"use (?:...) in place of (...) in {expression!r}; pieces are the columns")


def read_logs(
    spark: SparkSession,
    path: str | list[str],
    pattern: str,
    *,
    pieces: Mapping[str, str] | None = None,
    options: Mapping[str, str] | None = None,
    continued: str = CONTINUED,
    unit: bool = False,
) -> DataFrame:
    """The records of log files: a string column for each named piece, null where it is empty
    or in a part of the pattern that was not needed, and ``continued``, the lines that follow
    the first.

    Lines before a file's first record are a record without pieces, so nothing is lost. Columns
    of partition folders come behind. ``unit`` adds the input file as a column of that name.
    """
    whole, names = compiled(pattern, pieces)
    records = joined_by_head(read_lines(spark, path, options=options), F.col(LINE).rlike(whole))
    partition = records.schema[PARTITION].dataType.names if PARTITION in records.columns else []
    taken = [*names, continued, *partition, *([UNIT] if unit else [])]
    if len({name.lower() for name in taken}) < len(taken):
        raise ValueError(f"columns of one name among {taken}")
    first = F.substring_index(LINE, "\n", 1)
    fits = first.rlike(whole)
    found = [F.nullif(F.regexp_extract(first, whole, i + 1), F.lit("")) for i in range(len(names))]
    columns = [F.when(fits, value).alias(name) for name, value in zip(names, found)]
    rest = F.when(F.contains(F.col(LINE), F.lit("\n")), _behind(first))
    columns.append(F.when(fits, rest).otherwise(F.col(LINE)).alias(continued))
    columns += [F.col(PARTITION)[name].alias(name) for name in partition]
    return records.select(*columns, *([UNIT] if unit else []))


def _behind(first: Column) -> Column:
    return F.substring(LINE, F.length(first) + 2, F.length(LINE))

