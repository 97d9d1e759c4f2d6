"""CSV records with line ends in quotes, cut out of files that many tasks read."""

from __future__ import annotations

import re
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from maskwright.sources.blocks import Step, first_of_file, joined_by_state
from maskwright.sources.records import UNIT
from maskwright.sources.routing import BLOCK, HEADER, LINE, PARTITION, read_lines

#: Between records, and within a quoted value.
OUTSIDE, INSIDE = 0, 1


def read_quoted_lines(
    spark: SparkSession, path: str | list[str], *, options: Mapping[str, str] | None = None
) -> DataFrame:
    """The records of CSV files as text, in the form of ``read_lines``: a record is a line, or
    several where a quoted value goes over line ends. ``split_by_unit`` takes them.

    Spark's own reader needs ``multiLine`` for such files and one task for each. Lines end at
    ``\\n`` or ``lineSep``. ``quote``, ``escape`` and ``sep`` are those of Spark's reader; with
    ``header`` the first record of each file is marked in ``header_line`` and not parsed.
    """
    given = {k.lower(): v for k, v in (options or {}).items()}
    separator = given.get("linesep", "\n")
    if separator != "\n":
        raise ValueError("records with line ends in quotes need lines that end at \\n")
    own = {k: v for k, v in (options or {}).items() if k.lower() != "linesep"}
    lines = read_lines(spark, path, options={**own, "lineSep": "\n"})
    quote, escape = given.get("quote", '"'), given.get("escape", "\\")
    comma = given.get("sep", given.get("delimiter", ","))
    if not quote or len(quote) > 1 or len(escape) > 1:
        raise ValueError("records in quotes need one character as quote, and one escape at most")
    # The patterns are compiled in the tasks.
    records = joined_by_state(lines, 2, lambda: quote_step(quote, escape, comma))
    # What ends a line before \n is no part of the record, as in Spark's reader.
    records = records.withColumn(LINE, F.regexp_replace(LINE, r"\r\z", ""))
    if str(given.get("header", "false")).lower() == "true":
        records = records.withColumn(HEADER, first_of_file())
    return records.select([n for n in (UNIT, BLOCK, LINE, PARTITION, HEADER) if n in records.columns])


def quote_step(quote: str, escape: str, separator: str) -> Step:
    """Whether a line begins outside of quotes, and where its end is.

    A value is quoted if a quote is its first character. It ends at a quote before a separator
    or the line's end; after any other quote that is not escaped, the rest of the value counts
    as not quoted, as in Spark's reader.
    """
    q, s = re.escape(quote), re.escape(separator)
    escaped = q + q if escape == quote else f"{re.escape(escape)}." if escape else "(?!)"
    plain = f"[^{q}]" if escape in ("", quote) else f"[^{q}{re.escape(escape)}]"
    # The rest of a quoted value and how it ends; no backing up into what is read.
    rest = re.compile(f"(?:{plain}|{escaped})*+(?:{q}[ \t]*+({s}|\r?\\Z)|({q}))?", re.S)
    to_next = re.compile(s)
    size = len(separator)

    def step(line: str, state: int) -> tuple[bool, int]:
        head = state == OUTSIDE
        if quote not in line:
            return head, state
        at, end = 0, len(line)
        while True:
            if state == INSIDE:
                match = rest.match(line, at)
                if match.group(1) is None and match.group(2) is None:
                    return head, INSIDE
                state, at = OUTSIDE, match.end()
                if match.group(1) is not None:
                    if not match.group(1).startswith(separator):
                        return head, OUTSIDE
                    if at == end:
                        return head, OUTSIDE
                    if line.startswith(quote, at):
                        state, at = INSIDE, at + 1
                        continue
            elif at == 0 and line.startswith(quote):
                state, at = INSIDE, 1
                continue
            # To the first of the next values that is quoted.
            found = to_next.search(line, at)
            while found and not line.startswith(quote, found.end()):
                found = to_next.search(line, found.end())
            if not found:
                return head, OUTSIDE
            state, at = INSIDE, found.end() + 1

    return step
