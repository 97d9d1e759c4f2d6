"""Near-duplicate embeddings by tiled comparison along principal components.

Vectors of one label are put in the order of their first principal component and cut into
tiles. Two tiles are only compared if that component allows the cosine. Within a pair of
tiles the products of the leading components are added first; the rest is bounded by the
norms of the remaining suffixes, and a pair is given up as soon as it can't reach the
threshold. A pair of tiles returns the number of links of each vector and a forest that
connects what is linked, never the pairs.

Defined cases: vectors that are null, zero or hold null or non-finite components, a null
label or a null id link with nothing. Vectors of different lengths don't link. Repeated
rows are one vector, which each of them reports. Copies of a vector under other ids are
compared once and counted as links of each other. A cosine of just the threshold links. An
empty table gives an empty one; only id, label and vector are read, so other columns cannot
clash.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from maskwright.llm.components import components
from maskwright.llm.tables import column, stored
from maskwright.llm.vectors import matrix, usable

COSINE = 0.93
#: Vectors of a tile, about.
TILE = 1024
#: Share of pairs still open from which on they are followed one by one.
SPARSE = 0.02
#: Pairs that are followed at once.
PAIRS = 1 << 16
#: What rounding may do to a product of unit vectors, with room to spare.
SLACK = 1e-9


def embedding_links(
    vectors: DataFrame,
    *,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    cosine: float = COSINE,
) -> DataFrame:
    """For each row its id, n_links, component_id and kept."""
    vector = column(vectors, vector_col)
    rows = vectors.select(
        column(vectors, id_col).cast("bigint").alias("id"),
        column(vectors, label_col).alias("label"),
        vector.cast("array<float>").alias("vector"),
        usable(vector).alias("usable"),
    )
    able = F.col("usable") & F.col("id").isNotNull() & F.col("label").isNotNull()
    shown = F.array_join(F.transform("vector", lambda x: x.cast("string")), ",")
    copy = F.md5(F.concat_ws("|", F.col("label").cast("string"), shown))
    rows = rows.withColumn("copy", F.when(able, copy))
    ids = rows.select("id", "copy").filter("copy IS NOT NULL").distinct()
    groups = ids.groupBy("copy").agg(F.min("id").alias("node"), F.count("*").alias("copies"))
    groups = stored(groups, "copies")
    nodes = (
        rows.filter("copy IS NOT NULL")
        .join(groups, "copy")
        .filter("id = node")
        .dropDuplicates(["copy"])
        .select("copy", "node", "copies", "label", "vector", F.size("vector").alias("length"))
    )
    nodes = stored(nodes, "nodes")
    bases = _bases(nodes)
    placed = _placed(nodes, bases)
    linked = stored(_compared(placed, bases, cosine), "links")
    sums = linked.groupBy("node").agg(F.sum("links").alias("links"))
    joined = components(linked.select("node", "root").filter("node <> root"))
    found = groups.join(sums, "node", "left").join(
        joined.withColumnRenamed("id", "node"), "node", "left"
    )
    found = found.select(
        "copy",
        (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
        F.coalesce("component", "node").alias("component_id"),
    )
    # Rows without a copy key are spread by their id.
    own = F.concat_ws(" ", F.lit("none"), F.col("id").cast("string"))
    key = F.coalesce("copy", own)
    out = rows.select("id", key.alias("copy")).join(found, "copy", "left")
    component = F.coalesce("component_id", "id")
    return out.select(
        F.col("id").alias(id_col),
        F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("id") == component, F.lit(False)).alias("kept"),
    )


def _units(values: np.ndarray) -> np.ndarray:
    values = values / np.abs(values).max(axis=1, keepdims=True)
    return values / np.sqrt((values * values).sum(axis=1, keepdims=True))


def _bases(nodes: DataFrame) -> dict[int, np.ndarray]:
    """For each length of vectors the principal axes of all unit vectors, strongest first."""

    def moments(parts):
        sums: dict[int, np.ndarray] = {}
        for part in parts:
            for length, own in part.groupby("length"):
                unit = _units(matrix(own["vector"]))
                sums[length] = sums.get(length, 0) + unit.T @ unit
        if sums:
            flat = [square.ravel().tolist() for square in sums.values()]
            yield pd.DataFrame({"length": list(sums), "sums": flat})

    parts = nodes.select("length", "vector").mapInPandas(moments, "length int, sums array<double>")
    sums: dict[int, np.ndarray] = {}
    for row in parts.toLocalIterator():  # a square matrix for each task and length
        square = np.array(row["sums"]).reshape(row["length"], row["length"])
        sums[row["length"]] = sums.get(row["length"], 0) + square
    return {length: np.linalg.eigh(total)[1][:, ::-1] for length, total in sums.items()}


def _placed(nodes: DataFrame, bases: dict[int, np.ndarray]) -> DataFrame:
    """The nodes with their first component, and their tile in the order of it."""

    def first(parts):
        for part in parts:
            out = np.zeros(len(part))
            for length in part["length"].unique():
                at = (part["length"] == length).to_numpy()
                out[at] = _units(matrix(part["vector"][at])) @ bases[length][:, 0]
            yield part.assign(first=out)

    kinds = [f"{f.name} {f.dataType.simpleString()}" for f in nodes.schema]
    placed = stored(nodes.mapInPandas(first, ", ".join([*kinds, "first double"])), "firsts")
    # Cut points, and the number of tiles of the wanted size.
    cuts = placed.groupBy("label", "length").agg(
        F.percentile_approx("first", [i / 256 for i in range(1, 256)], 10_000).alias("cuts"),
        F.ceil(F.count("*") / TILE).cast("int").alias("tiles"),
    )
    placed = placed.join(cuts, ["label", "length"])
    rank = F.size(F.filter("cuts", lambda c: c < F.col("first")))
    even = F.floor(rank * F.least("tiles", F.lit(256)) / 256).cast("int")
    # Beyond 256 tiles each is divided by a hash; what isn't apart is compared anyway.
    more = F.pmod(F.xxhash64("node", "copy"), F.ceil(F.col("tiles") / 256)).cast("int")
    return placed.withColumn("tile", even * F.ceil(F.col("tiles") / 256).cast("int") + more).drop(
        "cuts", "tiles"
    )


def _compared(placed: DataFrame, bases: dict[int, np.ndarray], cosine: float) -> DataFrame:
    """(node, links, root) for vectors with links, from each pair of tiles."""
    placed = placed.select("node", "copies", "label", "length", "tile", "vector", "first")
    placed = stored(placed, "tiles")
    tiles = placed.groupBy("label", "length", "tile").agg(
        F.min("first").alias("low"), F.max("first").alias("high")
    )
    renamed = (F.col(c).alias(f"{c}_") for c in ("tile", "low", "high"))
    other = tiles.select("label", "length", *renamed)
    gap = math.sqrt(max(0.0, 2 - 2 * cosine)) + SLACK
    pairs = tiles.join(other, ["label", "length"]).filter(
        (F.col("tile") <= F.col("tile_"))
        & (F.col("low_") <= F.col("high") + gap)
        & (F.col("low") <= F.col("high_") + gap)
    )
    pairs = stored(pairs.select("label", "length", "tile", "tile_"), "tile-pairs")
    left = placed.join(pairs, ["label", "length", "tile"])
    right = placed.withColumnRenamed("tile", "tile_").join(pairs, ["label", "length", "tile_"])
    keys = ["label", "length", "tile", "tile_"]
    columns = [*keys, "node", "copies", "vector"]
    # Other names on the right, else the two sides of one table can't be told apart.
    left = left.select(columns)
    right = right.select(columns).toDF(*(f"right_{c}" for c in columns))

    def compare(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        b = b.set_axis(columns, axis=1)
        length = int(a["length"].iloc[0])
        same = int(a["tile"].iloc[0]) == int(a["tile_"].iloc[0])
        i, j = _near(matrix(a["vector"]), matrix(b["vector"]), bases[length], cosine, same)
        nodes = np.concatenate([a["node"].to_numpy(), b["node"].to_numpy()])
        if same:  # both sides are the same rows, maybe in another order
            order = np.argsort(a["node"].to_numpy(), kind="stable")
            back = np.argsort(b["node"].to_numpy(), kind="stable")
            place = np.empty(len(b), np.int64)
            place[back] = order
            once = i < place[j]
            i, j = i[once], place[j][once]
            nodes, copies = a["node"].to_numpy(), a["copies"].to_numpy()
        else:
            j = j + len(a)
            copies = np.concatenate([a["copies"].to_numpy(), b["copies"].to_numpy()])
        links = np.bincount(i, copies[j], len(nodes)) + np.bincount(j, copies[i], len(nodes))
        root = nodes.copy()
        while len(i):
            before = root.copy()
            low = np.minimum(root[i], root[j])
            np.minimum.at(root, i, low)
            np.minimum.at(root, j, low)
            if (root == before).all():
                break
        at = links > 0
        return pd.DataFrame(
            {"node": nodes[at], "links": links[at].astype(np.int64), "root": root[at]}
        )

    return (
        left.groupBy(keys)
        .cogroup(right.groupBy([f"right_{c}" for c in keys]))
        .applyInPandas(compare, "node bigint, links bigint, root bigint")
    )


def _near(a: np.ndarray, b: np.ndarray, axes: np.ndarray, cosine: float, same: bool):
    """Places (i, j) of the pairs with at least this cosine."""
    ua, ub = _units(a), _units(b)
    ra, rb = ua @ axes, ub @ axes
    width = ra.shape[1]
    steps = sorted({min(width, 1 << k) for k in range(2, 1 + max(2, width.bit_length()))} | {width})
    suffix_a = np.sqrt(np.maximum(0, 1 - np.cumsum(ra * ra, axis=1)))
    suffix_b = np.sqrt(np.maximum(0, 1 - np.cumsum(rb * rb, axis=1)))
    done, sums = 0, np.zeros((len(a), len(b)))
    for step in steps:
        sums += ra[:, done:step] @ rb[:, done:step].T
        done = step
        rest = suffix_a[:, step - 1, None] * suffix_b[None, :, step - 1]
        alive = sums + rest >= cosine - SLACK
        if step == width or np.count_nonzero(alive) <= SPARSE * alive.size:
            break
    i, j = np.nonzero(alive)
    found = []
    for start in range(0, len(i), PAIRS):
        p, q = i[start : start + PAIRS], j[start : start + PAIRS]
        partial, at = sums[p, q], done
        for step in (s for s in steps if s > done):
            partial = partial + (ra[p, at:step] * rb[q, at:step]).sum(axis=1)
            at = step
            going = partial + suffix_a[p, step - 1] * suffix_b[q, step - 1] >= cosine - SLACK
            p, q, partial = p[going], q[going], partial[going]
        close = np.abs(partial - cosine) <= SLACK
        exact = partial >= cosine
        exact[close] = (ua[p[close]] * ub[q[close]]).sum(axis=1) >= cosine
        found.append((p[exact], q[exact]))
    return (np.concatenate([x[k] for x in found]) if found else np.empty(0, np.int64) for k in (0, 1))
