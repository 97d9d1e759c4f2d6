"""Secrets in texts: strong spans, and weak ones where complementary parts meet.

A strong span is a secret by its form. A weak one, such as a user name, an opaque string or
the address of a service, is only reported if a part of another role (access identifier,
secret, endpoint) lies within its scope, the code points around it, or if it is an endpoint that
overlaps a part of another role, such as ``postgres://user:secret@host``. The parts of a text are
joined as intervals by one sweep to the right and one to the left that remember, for each
role, the last part passed, and one over starts and ends for overlaps. All is a matter of one
row: no shuffle, and the work grows with the number of parts (and their sorting), not with
their pairs.

Defined cases: a null text counts as empty and has no spans. Texts are read whole, however long;
spans of one start are in the order of their kinds. Repeated rows are treated alike and keep
their number, an empty table gives an empty one. Other columns stay as they are.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from maskwright.llm.spans import Kind, answered, only, overlaps, redacted, with_spans
from maskwright.llm.tables import column, free_name, quoted

ASSIGN = (
    r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
ACCESS = r"AKIA[A-Z0-9]{14,}"
HEX = r"[0-9a-f]{16,}"
KEY_ID = (
    r"(?i:access_?key_?id|client_?id|user_?name|user_?id|login|account)"
    r"""["']?\x20*[:=]\x20*["']?[A-Za-z0-9._@-]{3,}"""
)
OPAQUE = r"[A-Za-z0-9+/_-]{24,}"
ENDPOINT = (
    r"(?:https?|wss?|s?ftp|ssh|jdbc:[a-z]{2,16}|postgres(?:ql)?|mysql|mongodb|redis|amqps?|s3)"
    r"""://[^\x20\x09-\x0D"'<>]+"""
)
#: Code points before and after a weak span in which another part counts.
SCOPE = 200
BASE = ("assign", "access", "hex")
ROLES = {
    "assign": "secret",
    "access": "access",
    "hex": "secret",
    "key_id": "access",
    "opaque": "secret",
    "endpoint": "endpoint",
}
NAMES = ("access", "secret", "endpoint")


def _mixed(value: Column) -> Column:
    return value.rlike("[0-9]") & value.rlike("[A-Z]") & value.rlike("[a-z]")


KINDS = (
    Kind("assign", ASSIGN, lambda v: F.length(F.regexp_extract(v, ASSIGN, 2)) >= 12),
    Kind("access", ACCESS),
    Kind("hex", HEX),
    Kind("key_id", KEY_ID),
    Kind("opaque", OPAQUE, _mixed),
    Kind("endpoint", ENDPOINT),
)


def scan_secrets(
    docs: DataFrame, *, text_col: str = "text", scope: int = SCOPE
) -> DataFrame:
    """``docs`` with the spans of its secrets as the last column, ``secrets`` or the next
    free name: array<struct<start, place, kind, end, value>>, by start and then kind."""
    into = free_name(docs, "secrets")
    parts = with_spans(docs, column(docs, text_col), KINDS, into)
    spans = F.col(into)
    weak = F.exists(spans, lambda s: ~s["kind"].isin(*BASE))
    kept = [F.col(quoted(name)) for name in docs.columns]
    return parts.select(*kept, F.when(weak, _linked(spans, scope)).otherwise(spans).alias(into))


def _linked(spans: Column, scope: int) -> Column:
    """The strong spans, and the weak ones that overlap no strong one and have a part of another
    role in scope, or, for an endpoint and another weak part, overlap it."""
    # A user name and an opaque string may be one value, so these two do not link by overlap.
    inner = [kind for kind in ROLES if kind != "endpoint"]
    over = overlaps(spans, {"strong": BASE, "endpoint": ["endpoint"], "inner": inner})
    sides = F.zip_with(_sweep(spans, scope, True), _sweep(spans, scope, False), lambda a, b: a | b)
    flags = F.zip_with(over, sides, lambda o, near: F.struct(o.alias("over"), near.alias("near")))

    def reported(span: Column, flag: Column) -> Column:
        over = flag["over"]
        is_endpoint = span["kind"] == "endpoint"
        nested = F.when(is_endpoint, over["inner"]).otherwise(over["endpoint"])
        return span["kind"].isin(*BASE) | (~over["strong"] & (flag["near"] | nested))

    return only(spans, flags, reported)


def _sweep(spans: Column, scope: int, rightward: bool) -> Column:
    """For each span whether a part of another role is in scope on the side that the sweep comes
    from.

    Every span is met twice: where the sweep enters it, it asks for what was passed; where
    the sweep leaves it, it is passed itself.
    """
    sign = 1 if rightward else -1
    near, far = ("start", "end") if rightward else ("end", "start")

    def event(turn: int, place: str) -> Callable[[Column, Column], Column]:
        return lambda s, i: F.struct(
            (sign * s[place]).alias("at"),
            F.lit(turn).alias("turn"),
            i.alias("number"),
            _role(s["kind"]).alias("role"),
        )

    def step(state: Column, e: Column) -> Column:
        return F.struct(
            *(
                F.when((e["turn"] == 0) & (e["role"] == name), e["at"])
                .otherwise(state[name])
                .alias(name)
                for name in NAMES
            )
        )

    def met(state: Column, e: Column) -> Column:
        found = F.lit(False)
        for name in NAMES:
            found = found | ((e["role"] != name) & (state[name] > e["at"] - scope))
        return found

    return answered(
        F.transform(spans, event(1, near)),
        F.transform(spans, event(0, far)),
        1,
        F.struct(*(F.lit(-(1 << 31)).alias(name) for name in NAMES)),
        step,
        met,
        f"struct<{', '.join(f'{name}: int' for name in NAMES)}>",
        "boolean",
    )


def _role(kind: Column) -> Column:
    role = F.lit("secret")
    for name, own in ROLES.items():
        role = F.when(kind == name, own).otherwise(role)
    return role


def redact_secrets(docs: DataFrame, *, text_col: str = "text", scope: int = SCOPE) -> DataFrame:
    """``docs`` with each secret in its texts replaced by its kind in angle brackets."""
    scanned = scan_secrets(docs, text_col=text_col, scope=scope)
    found = column(scanned, scanned.columns[-1])
    text = redacted(column(scanned, text_col), found)
    return scanned.withColumn(text_col, text).select(*(F.col(quoted(c)) for c in docs.columns))
