"""Nearest neighbours by inner product: multiprobe p-stable hashing, exact reranking.

Vectors get one more component that gives all of them the same length, so that the largest
inner product is the smallest distance. Each table cuts some Gaussian projections into
cells; a vector's cells are its bucket. Of a neighbour at distance r, a projection differs
by a normal variable with deviation r, which gives the probability of each bucket. A query
visits buckets in the order of it until ``REACH`` of it is covered, in every table. The
bound r is the distance of the query's k-th nearest vector in a bounded sample, so the true
k-th neighbour is no farther.

A visit is work on blocks: a bucket meets the queries that visit it, and no others, in tiles of
bounded size, so what is moved grows with the visits. A tile returns at most k candidates a query,
only ones that beat the sample's. Candidates are ranked by the product of the original vectors,
in double precision.

The sample's own best are candidates too. Tests demand a recall of 0.9 of the buckets alone.

Defined cases: vectors that are null, zero or hold null or non-finite components, or whose id
is null, take no part; only vectors of one length are compared. Repeated rows are one vector.
With fewer than k candidates in the sample every bucket is visited. Equal products go to the
smaller id. An empty table gives an empty one. Other columns are not read.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from maskwright.llm.tables import column, stored
from maskwright.llm.vectors import matrix, usable

K = 20
TABLES, WIDTH, REACH = 2, 1.5, 0.9
#: Vectors in the sample that bounds distances, at most.
SAMPLE = 8192
#: Vectors and queries of a tile, about.
TILE_VECTORS, TILE_QUERIES = 4096, 2048
#: Rounding of a product, for its size.
SLACK = 1e-12


class Hash:
    """The tables for vectors of one length and one largest norm."""

    def __init__(self, length: int, longest: float, projections: int):
        random = np.random.default_rng(length)
        shape = (TABLES, projections, length + 1)
        self.axes, self.longest = random.normal(size=shape), longest
        self.shift = random.uniform(0, WIDTH, size=shape[:2])

    def vectors(self, values: np.ndarray) -> np.ndarray:
        """Cells of vectors: table, vector, projection."""
        scaled = values / self.longest
        rest = np.sqrt(np.maximum(0, 1 - (scaled * scaled).sum(axis=1)))
        return np.floor(self._at(np.column_stack([scaled, rest])) / WIDTH).astype(np.int64)

    def queries(self, values: np.ndarray) -> np.ndarray:
        """Places of queries on the projections: table, query, projection."""
        norms = np.sqrt((values * values).sum(axis=1, keepdims=True))
        return self._at(np.column_stack([values / norms, np.zeros(len(values))]))

    def _at(self, values: np.ndarray) -> np.ndarray:
        return np.einsum("tpd,nd->tnp", self.axes, values) + self.shift[:, None, :]


def nearest(
    vectors: DataFrame,
    is_query,
    *,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    k: int = K,
) -> DataFrame:
    """(query_id, rank, id, score): the k nearest found for each query, without itself.

    ``is_query`` is a condition on the column ``id``, which holds the ids as bigint.
    """
    vector = column(vectors, vector_col)
    rows = vectors.filter(usable(vector)).select(
        column(vectors, id_col).cast("bigint").alias("id"),
        vector.cast("array<float>").alias("vector"),
    )
    rows = rows.filter("id IS NOT NULL").distinct().withColumn("length", F.size("vector"))
    rows = stored(rows, "vectors")
    squares = F.transform(F.col("vector").cast("array<double>"), lambda x: x * x)
    norm = F.sqrt(F.aggregate(squares, F.lit(0.0), lambda total, x: total + x))
    shapes = rows.groupBy("length").agg(
        F.count("*").alias("n"), F.max(norm).alias("longest")
    )
    # One row for each length that vectors have.
    shapes = {row["length"]: row for row in shapes.collect()}
    if not shapes:
        none = rows.select(F.col("id").alias("query_id"), "id", F.lit(0.0).alias("score"))
        return _ranked(none, k, id_col)
    # About a tile of vectors in a bucket, with some four cells on each projection.
    hashes = {
        length: Hash(
            length, row["longest"], max(3, round(math.log(row["n"] / TILE_VECTORS, 4) + 1))
        )
        for length, row in shapes.items()
    }
    index = stored(_indexed(rows, hashes), "index")
    # Buckets: cells are bounded by geometry, and a bucket holds about a tile of vectors.
    buckets = index.groupBy("length", "table", "cells").agg(F.count("*").alias("n"))
    found = {}
    for row in buckets.collect():
        found.setdefault((row["length"], row["table"]), []).append((row["cells"], row["n"]))
    share = F.lit(0.0)
    for length, row in shapes.items():
        part = min(1.0, 0.9 * SAMPLE / row["n"])
        share = F.when(F.col("length") == length, part).otherwise(share)
    spread = F.pmod(F.xxhash64("id", F.lit(41)), F.lit(1 << 30)) / float(1 << 30)
    sample = {
        length: (part["id"].to_numpy(), matrix(part["vector"]))
        for length, part in rows.filter(spread < share).toPandas().groupby("length")
    }
    probes = stored(_probes(rows.filter(is_query), hashes, found, sample, k), "probes")
    found_there = _candidates(index, probes, k)
    return _ranked(found_there.unionByName(_sampled(rows.filter(is_query), sample, k)), k, id_col)


def _ranked(candidates: DataFrame, k: int, id_col: str) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "id")
    best = candidates.groupBy("query_id", "id").agg(F.max("score").alias("score"))
    ranked = best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", F.col("id").alias(id_col), "score")


def _indexed(rows: DataFrame, hashes: dict[int, Hash]) -> DataFrame:
    def index(parts):
        for part in parts:
            for length, own in part.groupby("length"):
                for table, found in enumerate(hashes[length].vectors(matrix(own["vector"]))):
                    cells = [",".join(map(str, c)) for c in found.tolist()]
                    yield own.assign(table=table, cells=cells)

    return rows.mapInPandas(
        index, "id bigint, vector array<float>, length int, table int, cells string"
    )


def _phi(x: np.ndarray) -> np.ndarray:
    """The normal distribution function (Abramowitz and Stegun 7.1.26), to 1e-7."""
    z = np.abs(x) / math.sqrt(2)
    t = 1 / (1 + 0.3275911 * z)
    series = (0.254829592, -0.284496736, 1.421413741, -1.453152027, 1.061405429)
    poly = sum(c * t ** (i + 1) for i, c in enumerate(series))
    return np.where(x >= 0, 1 - poly * np.exp(-z * z) / 2, poly * np.exp(-z * z) / 2)


def _probes(queries, hashes, found, sample, k: int) -> DataFrame:
    """A row for each query and bucket that it visits, with the score that it has to beat."""
    cells_of = {
        key: (np.array([list(map(int, c.split(","))) for c, _ in all_cells]), all_cells)
        for key, all_cells in found.items()
    }

    def probe(parts):
        for part in parts:
            for length, own in part.groupby("length"):
                values, ids = matrix(own["vector"]), own["id"].to_numpy()
                known, others = sample.get(length, (np.empty(0), np.empty((0, length))))
                scores = values @ others.T
                scores[ids[:, None] == known[None, :]] = -np.inf
                enough = scores.shape[1] > k
                least = np.full(len(ids), -np.inf)
                if enough:
                    least = np.partition(scores, -k, axis=1)[:, -k]
                norms = np.sqrt((values * values).sum(axis=1)) * hashes[length].longest
                apart = np.sqrt(np.maximum(1e-6, 2 - 2 * least / norms))
                apart[~np.isfinite(least)] = np.inf
                least -= SLACK * norms
                for table, places in enumerate(hashes[length].queries(values)):
                    cells, named = cells_of[length, table]
                    for i in range(len(ids)):
                        low = (cells * WIDTH - places[i]) / apart[i]
                        chance = np.prod(_phi(low + WIDTH / apart[i]) - _phi(low), axis=1)
                        order = np.argsort(-chance, kind="stable")
                        reached = np.cumsum(chance[order])
                        stop = len(order)
                        if np.isfinite(least[i]) and reached[-1] > 0:
                            stop = 1 + int(np.searchsorted(reached, REACH * reached[-1]))
                        visited = order[:stop]
                        yield pd.DataFrame(
                            {
                                "length": length,
                                "table": table,
                                "cells": [named[v][0] for v in visited],
                                "query_id": ids[i],
                                "query": [own["vector"].iloc[i]] * len(visited),
                                "least": least[i],
                            }
                        )

    return queries.mapInPandas(
        probe,
        "length int, table int, cells string, query_id bigint, query array<float>, least double",
    )


def _sampled(queries: DataFrame, sample, k: int) -> DataFrame:
    """The best k of the sample for each query, so that none has fewer than it could."""

    def best(parts):
        for part in parts:
            for length, own in part.groupby("length"):
                if length in sample:
                    none = np.full(len(own), -np.inf)
                    yield _best(
                        own["id"].to_numpy(), matrix(own["vector"]), none, *sample[length], k
                    )

    return queries.mapInPandas(best, "query_id bigint, id bigint, score double")


def _best(query_ids, queries, leasts, ids, values, k: int) -> pd.DataFrame:
    """For each query the best k vectors that reach its least score, by exact products."""
    size = np.sqrt((values * values).sum(axis=1).max() * (queries * queries).sum(axis=1))
    scores, names, found, products = queries @ values.T, [], [], []
    for i, (query_id, least) in enumerate(zip(query_ids, leasts)):
        own = scores[i]
        own[ids == query_id] = -np.inf
        if len(own) > k:
            least = max(least, np.partition(own, -k)[-k] - SLACK * size[i])
        at = np.flatnonzero((own >= least) & (own > -np.inf))
        exact = (values[at] * queries[i]).sum(axis=1)
        order = np.lexsort((ids[at], -exact))[:k]
        names.append(np.full(len(order), query_id))
        found.append(ids[at][order])
        products.append(exact[order])
    return pd.DataFrame(
        {
            "query_id": np.concatenate(names),
            "id": np.concatenate(found),
            "score": np.concatenate(products),
        }
    )


def _tiles(index: DataFrame, probes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Vectors and visits dealt to tiles: a bucket is cut into pieces of its vectors and parts of
    the queries that visit it. A vector goes once to each part of its own bucket's visits, and
    nowhere if none visits the bucket."""
    bucket = ["length", "table", "cells"]
    sizes = index.groupBy(bucket).agg(
        F.ceil(F.count("*") / TILE_VECTORS).cast("int").alias("pieces")
    )
    visits = probes.groupBy(bucket).agg(
        F.ceil(F.count("*") / TILE_QUERIES).cast("int").alias("parts")
    )
    cut = sizes.join(visits, bucket)
    piece = F.pmod(F.xxhash64("id", F.lit(42)), F.col("pieces")).cast("int")
    vectors = index.join(cut, bucket).withColumn("piece", piece)
    vectors = vectors.withColumn("query_part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    part = F.pmod(F.xxhash64("query_id"), F.col("parts")).cast("int")
    asked = probes.join(cut, bucket).withColumn("query_part", part)
    asked = asked.withColumn("piece", F.explode(F.sequence(F.lit(0), F.col("pieces") - 1)))
    return vectors.drop("pieces", "parts"), asked.drop("pieces", "parts")


def _candidates(index: DataFrame, probes: DataFrame, k: int) -> DataFrame:
    """The best k of each tile for each query: (query_id, id, score)."""
    vectors, asked = _tiles(index, probes)
    keys = ["length", "table", "cells", "piece", "query_part"]

    def best(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        if not len(a) or not len(b):
            return pd.DataFrame({"query_id": [], "id": [], "score": []})
        return _best(
            b["query_id"].to_numpy(), matrix(b["query"]), b["least"].to_numpy(),
            a["id"].to_numpy(), matrix(a["vector"]), k,
        )

    return (
        vectors.select(*keys, "id", "vector")
        .groupBy(keys)
        .cogroup(asked.select(*keys, "query_id", "query", "least").groupBy(keys))
        .applyInPandas(best, "query_id bigint, id bigint, score double")
    )
