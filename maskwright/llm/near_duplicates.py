"""Near-duplicate documents: DartMinHash bands propose, exact similarity decides.

Copies of a text become one class first. Classes that share the bucket of a band are
candidates, but a bucket never gives all its pairs. First each member is compared with one
member, another in each bucket, and the links found make components. Then only members of different
components of a bucket are still open: those outside the bucket's largest component are
compared with the members of the others, if sizes and the bits of their signatures allow
the similarity. Similarity is the share of distinct word shingles (Jaccard), in lower case
and without punctuation, counted exactly on whole texts.

Defined cases: a null text counts as empty. Texts without words are near-duplicates of equal
texts only. Rows of one id are one document. A document whose id is null is named by a hash
of its text. Repeated rows keep their number in the result. An empty table gives none. Texts
are read whole. A class is named by its smallest id. Other columns stay as they are where
documents are dropped, and are not read otherwise.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from maskwright.llm.components import components
from maskwright.llm.darts import BANDS, ROWS, dart_sketch
from maskwright.llm.shingles import WORDS, shingle_set
from maskwright.llm.tables import column, free_name, quoted, stored

SIMILARITY = 0.8
#: Ids that are broadcast rather than shuffled, at most: 8 bytes each, some 100 MB in memory.
BROADCAST_IDS = 1_000_000
#: Standard deviations by which the bits of a true link may stray; beyond: 1 of 20 million.
STRAY = 5.5


def near_duplicates(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    words: int = WORDS,
    similarity: float = SIMILARITY,
    bands: int = BANDS,
    rows: int = ROWS,
) -> DataFrame:
    """For each row its id, class_id and kept.

    ``class_id`` is the smallest id that is reached by links, ``kept`` is true for the row
    of that id. Ids must fit a bigint.
    """
    classes = _classes(docs, id_col, text_col, words, similarity, bands, rows)
    return classes.select(F.col("own").alias(id_col), "class_id", "kept")


def drop_near_duplicates(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``docs`` with one row of each class, the one that is kept. Texts are only shuffled
    where more ids are dropped than can be broadcast, or where ids are repeated."""
    classes = stored(
        _classes(docs, id_col, text_col, WORDS, SIMILARITY, BANDS, ROWS).select("id", "kept"),
        "classes",
    )
    text, own = column(docs, text_col), column(docs, id_col).cast("bigint")
    key = free_name(docs, "key")
    keyed = docs.withColumn(key, F.coalesce(own, F.xxhash64(F.coalesce(text, F.lit("")))))
    dropped = classes.filter("NOT kept").select(F.col("id").alias(key)).distinct()
    unique = keyed.join(_sent(dropped), key, "left_anti")
    repeated = classes.filter("kept").groupBy(F.col("id").alias(key)).count().filter("count > 1")
    repeated = stored(repeated.select(key), "repeated")
    if not repeated.isEmpty():
        number = free_name(keyed, "number")
        same = Window.partitionBy(key).orderBy(F.md5(F.coalesce(text, F.lit(""))))
        several = unique.join(_sent(repeated), key, "left_semi")
        one = several.withColumn(number, F.row_number().over(same)).filter(F.col(number) == 1)
        unique = unique.join(_sent(repeated), key, "left_anti").unionByName(one.drop(number))
    return unique.select(*(F.col(quoted(name)) for name in docs.columns))


def _sent(ids: DataFrame) -> DataFrame:
    """Ids, marked for a broadcast where they are few enough."""
    return F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids


def _classes(
    docs: DataFrame, id_col: str, text_col: str, words: int, similarity: float, bands: int, rows: int
) -> DataFrame:
    """(id, own, class_id, kept) for each row; ``id`` is never null, ``own`` as it came."""
    known = docs.select(
        column(docs, id_col).cast("bigint").alias("id"),
        F.coalesce(column(docs, text_col), F.lit("")).alias("text"),
    ).select("text", F.coalesce("id", F.xxhash64("text")).alias("id"), F.col("id").alias("own"))
    sketched = known.select(
        "id",
        "own",
        F.unhex(F.md5("text")).alias("digest"),
        dart_sketch(F.col("text"), words=words, bands=bands, rows=rows).alias("sketch"),
    )
    sketched = stored(sketched, "sketches")
    # The same text, and the same id, is the same document.
    by_text = sketched.groupBy("digest").agg(F.min("id").alias("first"))
    names = sketched.select("id", "own", "digest").join(by_text, "digest")
    by_id = names.groupBy("id").agg(F.min("first").alias("lowest"))
    nodes = sketched.join(by_id.filter("id = lowest"), "id").select("id", "sketch.*")
    nodes = nodes.filter("n > 0")
    buckets = nodes.select("id", "n", "bits", F.explode("keys").alias("key"))

    leaders = (
        buckets.groupBy("key")
        .agg(
            F.min_by("id", F.xxhash64("id", "key")).alias("leader"),
            F.min("id").alias("first"),
            F.max("id").alias("last"),
        )
        .filter("first < last")
    )
    shared = stored(
        buckets.join(leaders.select("key", "leader"), "key").select(
            "key", "id", "n", "bits", "leader"
        ),
        "buckets",
    )
    first = (
        shared.filter("id <> leader")
        .select(F.greatest("id", "leader").alias("id"), F.least("id", "leader").alias("other"))
        .distinct()
    )
    sets = stored(_sets(shared.select("id").distinct(), known, words), "sets")
    links = stored(_links(first, sets, similarity), "links")
    joined = stored(components(links), "components")
    late = stored(_late(shared, joined, sets, similarity, bands * rows), "late")
    if not late.isEmpty():
        tied = joined.select("id", F.col("component").alias("other"))
        joined = stored(components(tied.unionByName(late)), "components")
    # The class of a row: of its text's first id, of that id's other texts, and of links.
    named = names.join(by_id, "id").groupBy("digest").agg(F.min("lowest").alias("node"))
    classed = names.select("id", "own", "digest").join(named, "digest")
    classed = classed.join(joined.withColumnRenamed("id", "node"), "node", "left")
    class_id = F.coalesce("component", "node")
    return classed.select(
        "id", "own", class_id.alias("class_id"), (class_id == F.col("id")).alias("kept")
    )


def _sets(ids: DataFrame, texts: DataFrame, words: int) -> DataFrame:
    """(id, set): the distinct shingles of the ids in question, from their texts.

    Where the ids are few they go to the texts, else both are shuffled.
    """
    wanted = texts.select("id", "text").join(_sent(stored(ids, "ids")), "id", "left_semi")
    sets = wanted.select("id", shingle_set(F.col("text"), words).alias("set"))
    # Copies of an id are one set; the union of its texts, where they differ.
    return sets.groupBy("id").agg(F.array_distinct(F.flatten(F.collect_set("set"))).alias("set"))


def _similarity(a: Column, b: Column) -> Column:
    common = F.size(F.array_intersect(a, b))
    return common / (F.size(a) + F.size(b) - common)


def _links(pairs: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """Those of the pairs (id, other) that are similar enough."""
    others = sets.select(F.col("id").alias("other"), F.col("set").alias("other_set"))
    both = pairs.join(sets, "id").join(others, "other")
    close = _similarity(F.col("set"), F.col("other_set")) >= similarity
    return both.filter(close).select("id", "other")


def _late(
    shared: DataFrame, joined: DataFrame, sets: DataFrame, similarity: float, coordinates: int
) -> DataFrame:
    """Links of bucket members that are not in one component yet.

    The join itself compares the sets, so only links leave it. A pair that shares several
    buckets is compared in the smallest of them.
    """
    members = shared.join(joined, "id", "left").select(
        *(c for c in shared.columns if c != "leader"), F.coalesce("component", "id").alias("part")
    )
    parts = members.groupBy("key", "part").agg(F.count("*").alias("size"))
    mixed = (
        parts.groupBy("key")
        .agg(F.max(F.struct("size", "part"))["part"].alias("main"), F.count("*").alias("parts"))
        .filter("parts > 1")
    )
    members = stored(members.join(mixed.select("key", "main"), "key"), "mixed")
    keys = members.groupBy("id").agg(F.sort_array(F.collect_set("key")).alias("keys"))
    members = members.join(keys, "id").join(sets, "id")
    left = members.filter("part <> main").select(
        *(F.col(c).alias(f"{c}_") for c in ("key", "id", "n", "bits", "part", "keys", "set"))
    )
    differing = (1 - similarity) / 2 * coordinates
    limit = math.floor(differing + STRAY * math.sqrt(differing))
    pairs = left.join(
        members,
        (F.col("key") == F.col("key_"))
        & (F.col("part") != F.col("part_"))
        & ((F.col("part") == F.col("main")) | (F.col("part_") < F.col("part")))
        & (F.least("n", "n_") >= similarity * F.greatest("n", "n_"))
        & (_differing(F.col("bits"), F.col("bits_"), coordinates) <= limit)
        & (F.col("key") == F.array_min(F.array_intersect("keys", "keys_")))
        & (_similarity(F.col("set"), F.col("set_")) >= similarity),
    )
    return pairs.select(F.col("id_").alias("id"), F.col("id").alias("other"))


def _differing(a: Column, b: Column, coordinates: int) -> Column:
    parts = [F.bit_count(a[i].bitwiseXOR(b[i])) for i in range(-(-coordinates // 64))]
    return reduce(lambda x, y: x + y, parts)
