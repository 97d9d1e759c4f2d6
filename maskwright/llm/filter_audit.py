"""How filters of documents interact: what each removes alone, in every order, and on average.

Each part of the documents (a language, say) keeps one sorted posting list for each filter,
the places of the documents that fail it. The lists are cut into ranges of ids, so that no
part is too large for a task. What a filter removes after some others is the difference of its
list and the union of theirs, found by galloping through all of these lists at once; sizes
over the ranges are summed. Differences for every set of earlier filters give every order.

Defined cases: a null text counts as empty, a null part is the empty string. Places are the
order of ids within a range, nulls first, so that repeated ids and rows count as documents of
their own. A null id neither repeats a text nor is repeated. A mark of several rows of one id
holds if one of them has it. Texts are read whole. An empty table has no parts and
no rows. Other columns are not touched.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from itertools import permutations
from math import factorial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from maskwright.llm.tables import column, stored

#: More filters have too many orders to list; 7 have 5,040.
MOST_FILTERS = 7
_BLANKS = " \t\n\x0b\x0c\r"
_LISTS = "part string, documents bigint, lists array<array<int>>"


def word_filters(text: Column) -> dict[str, Column]:
    """Four conditions under which a text fails: too short, too repetitive, too many capitals,
    special characters."""
    text = F.coalesce(text, F.lit(""))
    trimmed = F.trim(text, F.lit(_BLANKS))
    words = F.split(trimmed, r"[\x20\x09-\x0D]+")
    none = trimmed == ""
    capitals = F.length(F.regexp_replace(text, "[^A-Z]+", ""))
    special = [text.contains(mark) for mark in "#$%&*|"]
    either = special[0]
    for one in special[1:]:
        either = either | one
    return {
        "A": none | (F.size(words) < 100),
        "B": ~none & (100 * F.size(F.array_distinct(words)) < 80 * F.size(words)),
        "C": 100 * capitals > 10 * F.length(text),
        "D": either,
    }


def repeats(docs: DataFrame, *, id_col: str = "id", text_col: str = "digest") -> DataFrame:
    """``docs`` with whether a smaller id has the same text, as the last column, ``repeats``.

    The first id of each text is joined back by text and id, so a text of very many documents
    is spread by their ids and not one group.
    """
    first = docs.groupBy(F.col(text_col).alias("_text")).agg(F.min(id_col).alias("_id"))
    first = first.filter(F.col("_id").isNotNull())
    same = (F.col(text_col) == F.col("_text")) & (F.col(id_col) == F.col("_id"))
    later = F.col("_id").isNull() & F.col(id_col).isNotNull()
    return docs.join(first, same, "left").select("*", later.alias("repeats")).drop("_text", "_id")


def posting_lists(flagged: DataFrame, count: int) -> DataFrame:
    """Posting lists of rows (part, id, bits): one row for each range of ids of a part, with
    its number of documents and, for each of ``count`` bits, the places of those that have it.

    Rows are sorted by part and id across tasks, so a part with very many rows goes over
    several. A task takes rows batch by batch; a range is at most one batch, whatever the part.
    """

    def lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = batch.column("part").to_numpy(zero_copy_only=False)
            bits = batch.column("bits").to_numpy()
            starts = np.flatnonzero(np.r_[True, parts[1:] != parts[:-1]]) if len(parts) else []
            ends = [*starts[1:], len(parts)]
            rows = [
                (parts[a], int(b - a), [np.flatnonzero(bits[a:b] >> i & 1) for i in range(count)])
                for a, b in zip(starts, ends)
            ]
            if rows:
                kinds = pa.string(), pa.int64(), pa.list_(pa.list_(pa.int32()))
                columns = [pa.array(list(c), kind) for c, kind in zip(zip(*rows), kinds)]
                yield pa.RecordBatch.from_arrays(columns, ["part", "documents", "lists"])

    order = ["part", "id", "bits"]
    ranged = flagged.repartitionByRange(*order).sortWithinPartitions(*order)
    return ranged.select("part", "bits").mapInArrow(lists, _LISTS)


def gallop(ids: np.ndarray, others: np.ndarray) -> np.ndarray:
    """For each of some sorted ids whether it is among other sorted ids.

    The search for an id starts where the one before ended: steps double until they pass it,
    and halve again. All ids step at once, from the lower bound that their neighbours in a
    grid of every 64th id have found.
    """
    found = np.zeros(len(ids), bool)
    if not len(ids) or not len(others):
        return found
    # Only the stretch where both lists overlap is looked at.
    a, b = np.searchsorted(ids, others[0]), np.searchsorted(ids, others[-1], side="right")
    inside = ids[a:b]
    if not len(inside):
        return found
    low = np.repeat(np.searchsorted(others, inside[::64]), 64)[: len(inside)]
    step = 1
    while True:
        probe = np.minimum(low + step, len(others) - 1)
        behind = others[probe] < inside
        if not behind.any():
            break
        low = np.where(behind, probe, low)
        step *= 2
    high = np.minimum(low + step, len(others) - 1)
    while (low < high).any():
        middle = (low + high) >> 1
        behind = others[middle] < inside
        low, high = np.where(behind, middle + 1, low), np.where(behind, high, middle)
    found[a:b] = others[low] == inside
    return found


def without(ids: np.ndarray, lists: Sequence[np.ndarray]) -> np.ndarray:
    """The sorted ids that are in none of the sorted lists."""
    for others in sorted(lists, key=len, reverse=True):
        ids = ids[~gallop(ids, others)]
    return ids


def removals(postings: DataFrame, filters: int, marks: int) -> DataFrame:
    """For each part, filter and set of earlier filters (bits): ``documents`` of the part,
    ``removed``, those that fail the filter and none of the set; ``together``, those that fail
    any of both; and ``marked``, for each mark how many of the removed ones have it.

    The lists of a row are those of the filters, then those of the marks.
    """

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for part, documents, lists in zip(*batch.to_pydict().values()):
                lists = [np.array(one, np.int32) for one in lists]
                marked = lists[filters:]
                # The size of each union is that without its last list and what that adds.
                union = {0: 0}
                left = {}
                for chosen in range(1 << filters):
                    for f in range(filters):
                        if chosen >> f & 1:
                            continue
                        last = chosen.bit_length() - 1
                        rest = left[f, chosen ^ 1 << last] if chosen else lists[f]
                        left[f, chosen] = without(rest, [lists[last]]) if chosen else rest
                        union[chosen | 1 << f] = union[chosen] + len(left[f, chosen])
                for (f, chosen), ids in left.items():
                    hits = [int(gallop(ids, mark).sum()) for mark in marked]
                    out.append((part, documents, f, chosen, len(ids), union[chosen | 1 << f], hits))
            if out:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(list(c), kind) for c, kind in zip(zip(*out), _SIZE_KINDS)], _SIZES
                )

    sizes = postings.mapInArrow(merge, _SIZE_SCHEMA)
    return sizes.groupBy("part", "filter", "earlier").agg(
        *(F.sum(name).alias(name) for name in ("documents", "removed", "together")),
        F.array(*(F.sum(F.col("marked")[i]) for i in range(marks))).alias("marked"),
    )


_SIZE_SCHEMA = (
    "part string, documents bigint, filter int, earlier int, removed bigint, together bigint, "
    "marked array<bigint>"
)
_SIZES = ["part", "documents", "filter", "earlier", "removed", "together", "marked"]
_SIZE_KINDS = (
    pa.string(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.list_(pa.int64()),
)


def audit(removed: DataFrame, names: Sequence[str], marks: Sequence[str]) -> DataFrame:
    """One row for each part, order of all filters, and step, from ``removals``."""
    count = len(names)
    # Of all orders, those in which just these filters come earlier.
    earlier = F.bit_count("earlier")
    orders = F.element_at(
        F.array(*(F.lit(factorial(k) * factorial(count - 1 - k)) for k in range(count))),
        earlier + 1,
    )
    own = Window.partitionBy("part", "filter")
    known = removed.withColumns(
        {
            "fails": F.sum(F.when(earlier == 0, F.col("removed"))).over(own),
            "unique_fails": F.sum(F.when(earlier == count - 1, F.col("removed"))).over(own),
            "shapley": F.sum(orders * F.col("removed")).over(own),
        }
    )
    steps = []
    for order in permutations(range(count)):
        for step, f in enumerate(order):
            before = sum(1 << g for g in order[:step])
            steps.append(("".join(names[g] for g in order), step + 1, f, before))
    spark = removed.sparkSession
    kind = "filter_order string, step int, filter int, earlier int"
    each = spark.createDataFrame(steps, kind)  # fixed: only as long as the orders
    lost = [F.col("marked")[i].cast("long").alias(name) for i, name in enumerate(marks)]
    return known.join(F.broadcast(each), ["filter", "earlier"]).select(
        "part",
        "filter_order",
        "step",
        (F.col("documents") - F.col("together")).alias("kept"),
        "removed",
        (F.col("fails") - F.col("removed")).alias("redundant"),
        "unique_fails",
        *lost,
        "shapley",
    )


def filter_audit(
    docs: DataFrame,
    conditions: Mapping[str, Column],
    *,
    part: Column,
    marks: Mapping[str, DataFrame] | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    repeated: str | None = None,
) -> DataFrame:
    """The audit of filters of ``docs``, given as the conditions under which a row fails them.

    ``repeated`` names one more filter, the last: a smaller id has the same text, in any part.
    ``marks`` are one-column tables of the ids that have a mark.
    """
    names = [*conditions, *([repeated] if repeated else [])]
    if len(names) > MOST_FILTERS:
        raise ValueError(f"at most {MOST_FILTERS} filters, whose orders can be listed")
    marks = marks or {}
    text = F.coalesce(column(docs, text_col), F.lit(""))
    bits = F.lit(0)
    for i, condition in enumerate(conditions.values()):
        bits = bits + F.when(condition, 1 << i).otherwise(0)
    flagged = docs.select(
        column(docs, id_col).alias("id"),
        F.coalesce(part.cast("string"), F.lit("")).alias("part"),
        bits.alias("bits"),
        *([F.unhex(F.sha2(text, 256)).alias("digest")] if repeated else []),
    )
    if repeated:
        # Written, as both the first ids and the join read it.
        flagged = repeats(stored(flagged, "flagged"))
        last = F.when(F.col("repeats"), 1 << len(conditions)).otherwise(0)
        flagged = flagged.withColumn("bits", F.col("bits") + last).drop("digest", "repeats")
    for i, ids in enumerate(marks.values(), len(names)):
        marked = ids.select(F.col(ids.columns[0]).alias("_marked")).distinct()
        flagged = flagged.join(marked, F.col("id") == F.col("_marked"), "left")
        mark = F.when(F.col("_marked").isNotNull(), 1 << i).otherwise(0)
        flagged = flagged.withColumn("bits", F.col("bits") + mark).drop("_marked")
    postings = posting_lists(flagged, len(names) + len(marks))
    return audit(removals(postings, len(names), len(marks)), names, list(marks))
