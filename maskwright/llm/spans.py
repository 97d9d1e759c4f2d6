"""Spans of patterns in texts by SQL functions alone: what matched, from where to where.

Spark gives matches without their places. The pieces between matches, from ``split`` by the
same pattern, give the places: the lengths of pieces and matches add up to them.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from maskwright.llm.tables import free_name

SPAN = "array<struct<start: int, place: int, kind: string, end: int, value: string>>"


@dataclass(frozen=True)
class Kind:
    """A kind of span: its Java pattern, and which of its matches count."""

    name: str
    pattern: str
    keep: Callable[[Column], Column] = lambda value: F.lit(True)


def with_spans(df: DataFrame, text: Column, kinds: Sequence[Kind], into: str) -> DataFrame:
    """``df`` with the spans of all kinds, in order of start and then of kind.

    Matches of a kind are leftmost and do not overlap; those that do not count are dropped
    without another try. Places are code points, the end is exclusive. Null texts have none.
    """
    names = [free_name(df, f"{into}_{i}_") for i in range(len(kinds))]
    given = free_name(df, f"{into}_text")
    df = df.withColumn(given, F.coalesce(text, F.lit("")))
    found = {
        name: F.regexp_extract_all(given, F.lit(kind.pattern), 0)
        for name, kind in zip(names, kinds)
    }
    df = df.withColumns(found)
    placed = {
        name: _placed(F.col(given), F.col(name), kind, i)
        for i, (name, kind) in enumerate(zip(names, kinds))
    }
    df = df.withColumns(placed)
    spans = F.array_sort(F.concat(*map(F.col, names)))
    return df.withColumn(into, spans).drop(given, *names)


def _placed(text: Column, matches: Column, kind: Kind, place: int) -> Column:
    pieces = F.slice(F.split(text, kind.pattern, -1), F.lit(1), F.size(matches))
    both = F.zip_with(
        F.transform(pieces, F.length),
        matches,
        lambda gap, value: F.struct(
            gap.alias("gap"), F.length(value).alias("length"), value.alias("value")
        ),
    )

    def span(at: Column, match: Column) -> Column:
        start = at + match["gap"]
        return F.struct(
            start.alias("start"),
            F.lit(place).alias("place"),
            F.lit(kind.name).alias("kind"),
            (start + match["length"]).alias("end"),
            match["value"].alias("value"),
        )

    placed = scanned(
        both,
        F.lit(0),
        lambda at, match: at + match["gap"] + match["length"],
        span,
        state_type="int",
        out_type=SPAN[len("array<") : -1],
    )
    kept = F.filter(placed, lambda s: kind.keep(s["value"]))
    return F.when(F.size(matches) > 0, kept).otherwise(F.array().cast(SPAN))


#: Items that one step of a scan appends to an array, which is copied each time.
SCANNED = 256


def bound(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often the body has it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def scanned(
    items: Column,
    zero: Column,
    step: Callable[[Column, Column], Column],
    out: Callable[[Column, Column], Column],
    *,
    state_type: str,
    out_type: str,
) -> Column:
    """``out`` of each item and the state before it; ``step`` gives the state after it.

    Arrays are cut into blocks: the states before the blocks are found first, then each block
    goes on from its own. So the work grows with the items and not with their square.
    """

    def within(block: Column, state: Column) -> Column:
        start = F.struct(
            state.cast(state_type).alias("state"), F.array().cast(f"array<{out_type}>").alias("out")
        )

        def grown(acc: Column, item: Column) -> Column:
            return F.struct(
                step(acc["state"], item).cast(state_type).alias("state"),
                F.array_append(acc["out"], out(acc["state"], item).cast(out_type)).alias("out"),
            )

        return F.aggregate(block, start, grown, lambda acc: acc["out"])

    def blocks_of(all_items: Column) -> Column:
        last = F.ceil(F.size(all_items) / SCANNED).cast("int") - 1
        starts = F.sequence(F.lit(0), F.greatest(last, F.lit(0)))
        return F.transform(starts, lambda i: F.slice(all_items, i * SCANNED + 1, F.lit(SCANNED)))

    def joined(blocks: Column) -> Column:
        start = F.struct(
            zero.cast(state_type).alias("state"),
            F.array().cast(f"array<{state_type}>").alias("before"),
        )

        def passed(acc: Column, block: Column) -> Column:
            after = F.aggregate(
                block, acc["state"], lambda state, item: step(state, item).cast(state_type)
            )
            return F.struct(
                after.alias("state"), F.array_append(acc["before"], acc["state"]).alias("before")
            )

        before = F.aggregate(blocks, start, passed, lambda acc: acc["before"])
        return F.flatten(F.zip_with(blocks, before, within))

    return bound(bound(items, blocks_of), joined)


def overlaps(spans: Column, groups: Mapping[str, Sequence[str]]) -> Column:
    """For each span, in their order, a struct with a flag for each group of kinds: whether the
    span overlaps one of these kinds. A span of such a kind overlaps itself.

    The spans' starts and ends are met in order: an end asks for the furthest end of those that
    started before it.
    """

    def event(turn: int, at: str, mark: str) -> Callable[[Column, Column], Column]:
        return lambda s, i: F.struct(
            s[at].alias("at"),
            F.lit(turn).alias("turn"),
            i.alias("number"),
            s[mark].alias("mark"),
            s["kind"].alias("kind"),
        )

    asks, tells = F.transform(spans, event(0, "end", "start")), F.transform(spans, event(1, "start", "end"))

    def step(state: Column, e: Column) -> Column:
        return F.struct(
            *(
                F.when((e["turn"] == 1) & e["kind"].isin(*kinds), F.greatest(state[name], e["mark"]))
                .otherwise(state[name])
                .alias(name)
                for name, kinds in groups.items()
            )
        )

    def answer(state: Column, e: Column) -> Column:
        return F.struct(*((state[name] > e["mark"]).alias(name) for name in groups))

    zero = F.struct(*(F.lit(-1).alias(name) for name in groups))
    flags = ", ".join(f"{name}: boolean" for name in groups)
    ints = ", ".join(f"{name}: int" for name in groups)
    return answered(asks, tells, 0, zero, step, answer, f"struct<{ints}>", f"struct<{flags}>")


def answered(
    asks: Column,
    tells: Column,
    turn: int,
    zero: Column,
    step: Callable[[Column, Column], Column],
    answer: Callable[[Column, Column], Column],
    state_type: str,
    answer_type: str,
) -> Column:
    """The answers to ``asks``, in the order of their numbers. Events (at, turn, number, ...) are met
    in order; those of this turn ask, and do not change the state."""
    found = scanned(
        F.array_sort(F.concat(asks, tells)),
        zero,
        step,
        lambda state, e: F.struct(
            F.when(e["turn"] == turn, e["number"]).alias("number"), answer(state, e).alias("answer")
        ),
        state_type=state_type,
        out_type=f"struct<number: int, answer: {answer_type}>",
    )
    asked = F.array_sort(F.filter(found, lambda r: r["number"].isNotNull()))
    return F.transform(asked, lambda r: r["answer"])


def only(spans: Column, flags: Column, keep: Callable[[Column, Column], Column]) -> Column:
    """The spans that ``keep`` takes by themselves and their flags."""
    both = F.zip_with(
        spans, flags, lambda s, f: F.struct(s.alias("span"), keep(s, f).alias("kept"))
    )
    return F.transform(F.filter(both, lambda b: b["kept"]), lambda b: b["span"])


def listed(spans: Column) -> Column:
    """kind:start:end of each span, joined by commas."""
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ","
    )


def count_of(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


def uncovered(spans: Column, kinds: Sequence[str]) -> Column:
    """Spans of other kinds that overlap none of these kinds; ``spans`` are in order."""
    flags = overlaps(spans, {"strong": kinds})
    return only(spans, flags, lambda s, f: ~s["kind"].isin(*kinds) & ~f["strong"])


#: Code points of a chunk of text: cutting out of a chunk doesn't pass over the text before it.
CHUNK = 4096


def chunks_of(text: Column) -> Column:
    """A text as an array of chunks."""
    return F.regexp_extract_all(text, F.lit(f"(?s).{{1,{CHUNK}}}"), F.lit(0))


def cut(chunks: Column, start: Column, end: Column) -> Column:
    """What stands from start to end in a text of chunks."""
    first = F.floor(start / CHUNK).cast("int")
    last = F.floor((F.greatest(end, start + 1) - 1) / CHUNK).cast("int")
    part = F.array_join(F.slice(chunks, first + 1, last - first + 1), "")
    return F.substring(part, start - first * CHUNK + 1, F.greatest(end - start, F.lit(0)))


def redacted(text: Column, spans: Column) -> Column:
    """The text with ``<KIND>`` in the place of each span; overlapping ones become one."""

    def piece(chunks: Column) -> Callable[[Column, Column], Column]:
        def between(at: Column, span: Column) -> Column:
            mark = F.concat(F.lit("<"), F.upper(span["kind"]), F.lit(">"))
            return F.when(
                span["start"] >= at, F.concat(cut(chunks, at, span["start"]), mark)
            ).otherwise("")

        return between

    def marked(chunks: Column) -> Column:
        pieces = scanned(
            spans,
            F.lit(0),
            lambda at, span: F.greatest(at, span["end"]),
            piece(chunks),
            state_type="int",
            out_type="string",
        )
        furthest = F.array_max(F.transform(spans, lambda s: s["end"]))
        return F.concat(F.array_join(pieces, ""), cut(chunks, furthest, F.length(text)))

    return F.when(F.size(spans) > 0, bound(chunks_of(text), marked)).otherwise(text)
