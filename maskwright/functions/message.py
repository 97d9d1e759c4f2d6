"""The bytes that are digested for a value, and the blank test that guards it."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The code points for which Java's Character.isWhitespace holds.
BLANK_CODE_POINTS = (
    0x0009, 0x000A, 0x000B, 0x000C, 0x000D, 0x001C, 0x001D, 0x001E, 0x001F, 0x0020,
    0x1680, 0x2000, 0x2001, 0x2002, 0x2003, 0x2004, 0x2005, 0x2006, 0x2008, 0x2009,
    0x200A, 0x2028, 0x2029, 0x205F, 0x3000,
)
BLANK_CHARACTERS = "".join(map(chr, BLANK_CODE_POINTS))


def text_form(value: Column, kind: T.DataType | None) -> Column:
    """The text of a value, the same whatever the session's time zone: timestamps as in UTC."""
    if not isinstance(kind, T.TimestampType):
        return value.cast("string")
    seconds = F.unix_micros(value).cast("decimal(20,0)") * F.lit("0.000001").cast("decimal(7,6)")
    since = F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), seconds.cast("decimal(18,6)"))
    return (F.lit("1970-01-01 00:00:00").cast("timestamp_ntz") + since).cast("string")


def is_blank(text: Column) -> Column:
    """True for an empty or all-whitespace text, null for null.

    A left trim stops at the first other character, so a long text costs no
    more than a short one. A regular expression would decode the whole value.
    """
    return F.ltrim(text, F.lit(BLANK_CHARACTERS)) == F.lit("")


def message(key: str, text: Column) -> Column:
    """The bytes of ``key || text || base64(text)``, with no line breaks in base64.

    Spark's ``base64`` breaks lines after 76 characters, so they are taken out
    again; ``replace`` leaves an unbroken text as it is and is several times
    faster than ``translate`` on a long one. The key is a binary constant, which
    plans print as hexadecimal digits that ``hide_keys`` can recognise.
    """
    octets = text.cast("binary")
    encoded = F.replace(F.base64(octets), F.lit("\r\n"), F.lit(""))
    return F.concat(F.lit(key.encode()), octets, encoded.cast("binary"))
