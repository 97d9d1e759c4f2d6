"""Mixing sources to target weights along a time-varying curriculum.

Every source has a weight schedule over training time, 0 to 1. Its integral up to t is the
share of the source's target that is demanded by then. Documents of a source stand in the
order of a hash; the words before a document, put into the inverse of that integral, give
the moment at which it is trained on. Ordering all documents by that moment gives the mix.

No source is gathered in one task: the running sum of words is built from sums of hash
buckets, and only the documents of one bucket are ordered together.

Defined cases: a null text has no words. A document without words is never taken. A null
source is a source of its own, the last one. Repeated rows are documents like others. A
source without words has the target 0. An empty table gives an empty mix. Documents of equal
hashes stand in the order of their sizes; equal ones are interchangeable. Texts are counted
whole, however long. Other columns stay as they are.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from maskwright.llm.tables import column, free_name, quoted, stored

WORD = r"[^\x20\x09-\x0D]+"
#: Weights by the source's place in code point order, repeating.
WEIGHTS = (5.0, 2.0, 1.0)
#: All words taken, as a share of all words there are; most times that a source is used.
SHARE, MOST = 1.5, 2.0
#: Weight schedules (time, relative weight), by the source's place, repeating: the first
#: third of the sources fades, the second grows, the last is strongest half way.
SCHEDULES = (
    ((0.0, 1.5), (1.0, 0.5)),
    ((0.0, 0.5), (1.0, 1.5)),
    ((0.0, 0.5), (0.5, 1.5), (1.0, 0.5)),
)
#: Documents of a hash bucket, about; the square root of all where that is more.
BUCKET_ROWS = 500

Schedule = Sequence[tuple[float, float]]


def word_count(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("long")


def mix_sources(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: Sequence[float] = WEIGHTS,
    schedules: Sequence[Schedule] = SCHEDULES,
    share: float = SHARE,
    most: float = MOST,
) -> DataFrame:
    """The documents with one more, last column, named ``mix`` or the next free name.

    It holds size, source_size, target, taken and takes: for each use of the document
    the number of the pass over its source, the words taken and the position, 0 to 1.
    """
    names = {n: free_name(docs, n) for n in ("size", "src", "key", "bucket", "before")}
    size, src, key, bucket, before = (F.col(name) for name in names.values())
    text, source = column(docs, text_col), column(docs, source_col).cast("string")
    known = [F.coalesce(c.cast("string"), F.lit("")) for c in (column(docs, id_col), text)]
    # At most as many buckets of a source as keep the list of buckets and the buckets alike.
    rows = docs.count()
    digits = max(2, math.ceil(math.log(rows / max(BUCKET_ROWS, rows**0.5) + 1, 16)))
    keyed = docs.withColumns(
        {
            names["size"]: word_count(text),
            # Nulls come after all names.
            names["src"]: F.when(source.isNull(), "1").otherwise(F.concat(F.lit("0"), source)),
            names["key"]: F.md5(F.concat_ws(":", *known)),
        }
    ).withColumn(names["bucket"], key.substr(1, digits))
    sums = stored(
        keyed.groupBy(src.alias("src"), bucket.alias("bucket")).agg(F.sum(size).alias("words")),
        "mix-sums",
    )
    earlier = Window.partitionBy("src").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select(
        "src", "bucket", F.coalesce(F.sum("words").over(earlier), F.lit(0)).alias("offset")
    ).join(targets(sums, weights, share, most), "src")
    offsets = offsets.select(
        F.col("src").alias(names["src"]),
        F.col("bucket").alias(names["bucket"]),
        F.struct("offset", "source_size", "target", "place").alias(names["before"]),
    )
    within = (
        Window.partitionBy(names["src"], names["bucket"])
        .orderBy(names["key"], names["size"])
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    placed = keyed.join(offsets, [names["src"], names["bucket"]])
    start = before["offset"] + F.coalesce(F.sum(size).over(within), F.lit(0))
    started = placed.withColumn(names["bucket"], start)
    takes = F.filter(
        F.array(*(_take(k, size, bucket, before, schedules) for k in range(math.ceil(most)))),
        lambda take: take["words"] > 0,
    )
    mix = F.struct(
        size.alias("size"),
        before["source_size"].alias("source_size"),
        before["target"].alias("target"),
        F.aggregate(takes, F.lit(0).cast("long"), lambda n, take: n + take["words"]).alias("taken"),
        takes.alias("takes"),
    )
    kept = [F.col(quoted(name)) for name in docs.columns]
    return started.select(*kept, mix.alias(free_name(docs, "mix")))


def targets(sums: DataFrame, weights: Sequence[float], share: float, most: float) -> DataFrame:
    """For each source its words, its target and its place in code point order.

    Targets are proportional to weight but for those that stop at ``most`` times their
    source. With the sources in order of that bound over weight, the level that the rest
    shares is the highest of (what is left) / (weight that is left).
    """
    everywhere = Window.partitionBy(F.lit(0))
    steps = everywhere.orderBy(F.col("bound") / F.col("weight"), "src")
    above = steps.rowsBetween(Window.unboundedPreceding, -1)
    below = steps.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    weight = F.element_at(
        F.array(*map(F.lit, map(float, weights))), (F.col("place") % len(weights) + 1).cast("int")
    )
    return (
        sums.groupBy("src")
        .agg(F.sum("words").alias("source_size"))
        .withColumn("place", F.row_number().over(everywhere.orderBy("src")) - 1)
        .withColumns({"weight": weight, "bound": most * F.col("source_size")})
        .withColumn("all", share * F.sum("source_size").over(everywhere))
        .withColumn(
            "level",
            (F.col("all") - F.coalesce(F.sum("bound").over(above), F.lit(0.0)))
            / F.sum("weight").over(below),
        )
        .withColumn("level", F.max("level").over(everywhere))
        .select(
            "src",
            "source_size",
            F.least("bound", F.col("level") * F.col("weight")).alias("target"),
            "place",
        )
    )


def _take(k: int, size: Column, start: Column, before: Column, schedules) -> Column:
    """The use of a document in pass k over its source."""
    begin = k * before["source_size"] + start
    left = F.floor(before["target"]) - begin
    words = F.greatest(F.lit(0).cast("long"), F.least(size, left))
    demand = (begin + words / 2) / before["target"]
    which = before["place"] % len(schedules)
    position = reduce(
        lambda rest, i: F.when(which == i, _moment(demand, schedules[i])).otherwise(rest),
        range(1, len(schedules)),
        _moment(demand, schedules[0]),
    )
    return F.struct(
        F.lit(k).alias("repeat"),
        words.alias("words"),
        F.when(words > 0, position).alias("position"),
    )


def _moment(demand: Column, schedule: Schedule) -> Column:
    """The time at which this share of a source's target has been demanded."""
    parts = list(zip(schedule, schedule[1:]))
    total = sum((t1 - t0) * (w0 + w1) / 2 for (t0, w0), (t1, w1) in parts)
    found, done = F.lit(None).cast("double"), 0.0
    for (t0, w0), (t1, w1) in parts:
        rest, slope = demand - done, (w1 - w0) / (t1 - t0) / total
        root = F.sqrt(F.greatest(F.lit(0.0), (w0 / total) ** 2 + 2 * slope * rest))
        here = F.least(F.lit(float(t1)), t0 + 2 * rest / (w0 / total + root))
        found = here if done == 0.0 else F.when(rest >= 0, here).otherwise(found)
        done += (t1 - t0) * (w0 + w1) / 2 / total
    return found


def training_order(mixed: DataFrame, *, text_col: str = "text") -> DataFrame:
    """One row for each use of a document, in the order of training.

    The last column of ``mixed`` is taken as the one that :func:`mix_sources` adds; it
    becomes the use. Where a source's target ends within a document, the text of that
    use ends after the words taken.
    """
    mix, uses = mixed.columns[-1], free_name(mixed, "use")
    each = mixed.withColumn(uses, F.explode(column(mixed, mix)["takes"]))
    text, use = F.col(quoted(text_col)), F.col(uses)
    space = r"[\x20\x09-\x0D]"
    first = F.concat(F.lit(rf"^(?:{space}*+{WORD}+){{"), use["words"].cast("string"), F.lit("}+"))
    whole = use["words"] >= F.col(quoted(mix))["size"]
    cut = F.when(whole, text).otherwise(F.call_function("regexp_extract", text, first, F.lit(0)))
    columns = [(cut if c == text_col else F.col(quoted(c))).alias(c) for c in mixed.columns[:-1]]
    ordered = each.select(*columns, use.alias(mix))
    position = F.col(quoted(mix))["position"]
    return ordered.repartitionByRange(position).sortWithinPartitions(position)
