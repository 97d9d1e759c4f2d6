"""Personal data in texts: fixed forms, and what stands where they stand.

The fixed forms are seeds. Every seed, and every other token that looks like an identifier,
has lexical patterns: the words before it, behind it, and around it, or that a text starts or
ends there. Patterns and values make a graph, in which a
pattern is as good as the share of its values that are known, and a value that is not a
seed is as likely as its good patterns make it. A few rounds of two joins score the graph;
values of high confidence in good patterns are then reported too, as ``context``.

All texts are read once; what goes on from there are identifiers and the words next to
them, written below the checkpoint folder.

Defined cases: a null text counts as empty and has no spans. Texts are read whole, however long.
Repeated rows are treated alike and keep their number; they are one witness for a pattern, as a
value is. A null id is an id like others. An empty table gives an empty one. Only id and
text are read, so other columns cannot clash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from maskwright.llm.spans import SPAN, Kind, bound, chunks_of, cut, uncovered, with_spans
from maskwright.llm.tables import column, stored

#: Like the plain forms of these patterns, but without trying again within a run.
EMAIL = (
    r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
)
IP = r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}"
CARD = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
#: A token with a digit, of six characters or more, that may be an identifier.
TOKEN = r"(?<![A-Za-z0-9@_%+/.-])(?=[A-Za-z@_%+/.-]*[0-9])[A-Za-z0-9@_%+/-][A-Za-z0-9@_%+/.-]{5,}+"
BASE = ("email", "ip", "card", "phone")
FOUND = "context"
MENTIONS = (
    "array<struct<start: int, end: int, value: string, seed: boolean, patterns: array<string>>>"
)
#: Code points before and after a value that are looked at first for its neighbours. Where two
#: whole words do not lie in them, all of the text on that side is.
NEAR = 60
#: In patterns, the start and the end of a text.
START, END = "^", "$"
#: Known values that a pattern needs, and the share of known values.
SUPPORT, SHARE = 3.0, 0.8
#: How far a good pattern is trusted, the confidence that reports a value, and rounds.
TRUST, CONFIDENCE, ROUNDS = 0.9, 0.7, 3

_BYTE = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[0-9]{1,2})"


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(value: Column) -> Column:
    backward = F.reverse(_digits(value))
    places = F.sequence(F.lit(1), F.length(backward))

    def add(total: Column, place: Column) -> Column:
        digit = F.substring(backward, place, F.lit(1)).cast("int")
        double = 2 * digit - F.when(digit > 4, 9).otherwise(0)
        return total + F.when(place % 2 == 0, double).otherwise(digit)

    total = F.aggregate(places, F.lit(0), add)
    return F.length(backward).between(14, 19) & F.when(
        F.length(backward).between(14, 19), total % 10 == 0
    )


KINDS = (
    Kind("email", EMAIL),
    Kind("ip", IP, lambda v: v.rlike(rf"^(?:{_BYTE}\.){{3}}{_BYTE}$")),
    Kind("card", CARD, _luhn),
    Kind("phone", PHONE, lambda v: F.length(_digits(v)).between(10, 15)),
    Kind("token", TOKEN),
)


def personal_data(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """For each row its id and ``spans``: array<struct<start, place, kind, end, value>>."""
    known = docs.select(
        column(docs, id_col).alias("id"),
        F.coalesce(column(docs, text_col), F.lit("")).alias("text"),
    )
    found = with_spans(known, F.col("text"), KINDS, "all")
    base = F.filter("all", lambda s: s["kind"] != "token")
    tokens = F.filter("all", lambda s: s["kind"] == "token")
    free = F.when(F.size(base) > 0, uncovered(F.col("all"), BASE))
    found = found.withColumns({"base": base, "free": free.otherwise(tokens)})
    each = F.concat("base", "free")
    # The length is bound too: within the transform it would be counted again for each value.
    described = bound(
        F.length("text"),
        lambda length: bound(
            chunks_of(F.col("text")),
            lambda chunks: F.transform(each, lambda s: _mention(chunks, length, s)),
        ),
    )
    nothing = F.array().cast(MENTIONS)
    mentions = F.when(F.size(each) > 0, described).otherwise(nothing)
    scanned = stored(
        found.select(
            "id",
            F.md5(F.concat_ws(":", F.coalesce(F.col("id").cast("string"), F.lit("")), "text")).alias("key"),
            "base",
            mentions.alias("mentions"),
        ),
        "scanned",
    )
    each = scanned.select("key", F.explode("mentions").alias("m")).distinct()
    edges = (
        each.select("m.*", F.explode("m.patterns").alias("pattern"))
        .groupBy("pattern", "value")
        .agg(F.max("seed").alias("seed"))
    )
    good, values = _scored(stored(edges, "edges"))
    new = (
        each.filter(~F.col("m.seed"))
        .select("key", "m.start", "m.end", "m.value", F.explode("m.patterns").alias("pattern"))
        .join(good.select("pattern"), "pattern", "left_semi")
        .join(values.filter(F.col("confidence") >= CONFIDENCE), "value", "left_semi")
    )
    span = F.struct(
        "start", F.lit(len(BASE)).alias("place"), F.lit(FOUND).alias("kind"), "end", "value"
    )
    new = new.groupBy("key").agg(F.collect_set(span).alias("new"))
    spans = F.concat("base", F.coalesce("new", F.array().cast(SPAN)))
    return scanned.join(new, "key", "left").select(
        F.col("id").alias(id_col), F.array_sort(spans).alias("spans")
    )


def _mention(chunks: Column, length: Column, span: Column) -> Column:
    """A value, its place, whether it is a seed, and its patterns: one or two words on the left or
    on the right, and one on each side."""

    def words(value: Column) -> Column:
        # Digits near a value are mostly values themselves.
        return F.regexp_replace(F.lower(value), "[0-9]+", "0")

    def either(value: Column, other: str) -> Column:
        return F.when(value != "", value).otherwise(other)

    begin, end = F.greatest(F.lit(0), span["start"] - NEAR), F.least(length, span["end"] + NEAR)
    before, after = cut(chunks, begin, span["start"]), cut(chunks, span["end"], end)
    whole = (begin == 0) | before.rlike(r"\s\S+\s+\S+\s*$")
    before = words(F.when(whole, before).otherwise(cut(chunks, F.lit(0), span["start"])))
    whole = (end == length) | after.rlike(r"^\s*\S+\s+\S+\s")
    after = words(F.when(whole, after).otherwise(cut(chunks, span["end"], length)))
    one = F.regexp_extract(before, r"(\S+)\s*$", 1)
    two = either(F.regexp_extract(before, r"(\S+)\s+\S+\s*$", 1), START)
    behind = F.regexp_extract(after, r"^\s*(\S+)", 1)
    next_ = either(F.regexp_extract(after, r"^\s*\S+\s+(\S+)", 1), END)
    patterns = F.array(
        F.when(one != "", F.concat(F.lit("1 "), one)),
        F.when(one != "", F.concat(F.lit("2 "), two, F.lit(" "), one)),
        F.when(behind != "", F.concat(F.lit("3 "), either(one, START), F.lit(" "), behind)),
        F.when(behind != "", F.concat(F.lit("4 "), behind)),
        F.when(behind != "", F.concat(F.lit("5 "), behind, F.lit(" "), next_)),
    )
    return F.struct(
        span["start"].alias("start"),
        span["end"].alias("end"),
        span["value"].alias("value"),
        (span["kind"] != "token").alias("seed"),
        F.array_compact(patterns).alias("patterns"),
    )


def _scored(edges: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Good patterns (pattern, score) and values that are no seeds (value, confidence)."""
    sure = F.when(F.col("seed"), 1.0).otherwise(0.0)
    weighed = edges.withColumn("confidence", sure)
    for number in range(ROUNDS):
        good = weighed.groupBy("pattern").agg(
            F.sum("confidence").alias("support"), F.count("*").alias("n")
        )
        # Sums of doubles differ with the order of rows; rounding makes reruns agree.
        score = F.round(F.col("support") / F.col("n"), 9)
        good = good.select("pattern", "support", score.alias("score")).filter(
            (F.round("support", 6) >= SUPPORT) & (F.col("score") >= SHARE)
        )
        good = stored(good.select("pattern", "score"), "patterns")
        doubt = F.exp(F.sum(F.log(1 - TRUST * F.col("score"))))
        values = (
            edges.filter("NOT seed")
            .join(good, "pattern")
            .groupBy("value")
            .agg(F.round(1 - doubt, 9).alias("confidence"))
        )
        values = stored(values, "values")
        if number < ROUNDS - 1:
            weighed = edges.join(values, "value", "left").withColumn(
                "confidence", F.when(F.col("seed"), 1.0).otherwise(F.coalesce("confidence", F.lit(0.0)))
            )
    return good, values
