from __future__ import annotations

import math
import random

import numpy as np
import pytest

from maskwright.llm import embedding_links as E
from maskwright.llm import nearest as A
from maskwright.llm.queries import op3_embedding_links, op6_nearest

SCHEMA = "vec_id bigint, embedding array<float>, label int"
NAN, INF = float("nan"), float("inf")


def rows(seed: int, n: int, width: int) -> list[tuple]:
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(n // 12, width))
    values = rng.normal(size=(n, width))
    near = rng.random(n) < 0.6
    spread = rng.choice([0.0, 0.15, 0.3, 0.45], size=(n, 1))
    values[near] = (centres[rng.integers(0, len(centres), n)] + spread * values)[near]
    values *= rng.choice([0.01, 1, 50], size=(n, 1))
    labels = rng.choice([0, 0, 0, 1, 2], size=n).tolist()
    out = [(i, v.tolist(), label) for i, (v, label) in enumerate(zip(values.astype("f4"), labels))]
    odd = [None, [], [0.0] * width, [NAN] + [1.0] * (width - 1), [INF] * width, [None, 1.0], [1.0, 2.0]]
    out += [(n + i, v, 0) for i, v in enumerate(odd)]
    out += [(n + 20, out[1][1], None), (None, out[2][1], 0), (n + 21, out[3][1], out[3][2]), out[4], out[4]]
    return out + [(n + 40, [2.0, 4.0], 0), (n + 60, [-1.0, 0.5], 0)]


def usable(v) -> bool:
    return bool(v) and all(x is not None and math.isfinite(x) for x in v) and any(v)


def linked(given):
    """Links and components by comparing all pairs."""
    nodes = {(i, tuple(v), label) for i, v, label in given if usable(v) and None not in (i, label)}
    nodes = sorted(nodes)
    parent = {i: i for i, *_ in given if i is not None}
    links = dict.fromkeys(parent, 0)

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for n, (i, v, label) in enumerate(nodes):
        for j, w, other in nodes[:n]:
            if label == other and len(v) == len(w):
                a, b = np.array(v, float), np.array(w, float)
                if a @ b / math.sqrt((a @ a) * (b @ b)) >= E.COSINE:
                    links[i] += 1
                    links[j] += 1
                    x, y = find(i), find(j)
                    parent[max(x, y)] = min(x, y)
    return [
        (i, links[i], find(i), find(i) == i) if i is not None else (None, 0, None, False)
        for i, *_ in given
    ]


@pytest.mark.parametrize("tile", [E.TILE, 40])
def test_links_are_brute_force(spark, tmp_path, monkeypatch, tile):
    monkeypatch.setattr(E, "TILE", tile)
    given = rows(1, 500, 16)
    spark.createDataFrame(given, SCHEMA).write.parquet(f"{tmp_path}/embeddings.parquet")
    found = op3_embedding_links(spark, str(tmp_path)).collect()
    want = linked(given)
    assert sum(row[1] for row in want) > 500
    assert sorted(map(tuple, found), key=repr) == sorted(want, key=repr)


def test_no_vectors(spark, tmp_path):
    for name, given in (("none", []), ("odd", [(1, None, 0), (2, [0.0], None), (3, [1.0], 0)])):
        folder = f"{tmp_path}/{name}"
        spark.createDataFrame(given, SCHEMA).write.parquet(f"{folder}/embeddings.parquet")
        found = op3_embedding_links(spark, folder).collect()
        assert sorted(map(tuple, found)) == [(i, 0, i, True) for i, *_ in given]
        assert op6_nearest(spark, folder).collect() == []


def neighbours(given):
    nodes = sorted({(i, tuple(v)) for i, v, _ in given if usable(v) and i is not None})
    out = {}
    for i, v in nodes:
        if i % 20 == 0:
            scores = {}
            for j, w in nodes:
                if j != i and len(w) == len(v):
                    product = float(np.array(v, float) @ np.array(w, float))
                    scores[j] = max(product, scores.get(j, -math.inf))
            out[i] = sorted(scores.items(), key=lambda s: (-s[1], s[0]))[: A.K]
    return out


@pytest.mark.parametrize("sample, tiles", [(A.SAMPLE, 4096), (300, 50)])
def test_recall(spark, tmp_path, monkeypatch, sample, tiles):
    monkeypatch.setattr(A, "SAMPLE", sample)
    monkeypatch.setattr(A, "TILE_VECTORS", tiles)
    monkeypatch.setattr(A, "TILE_QUERIES", tiles)
    given = rows(2, 1500, 24)
    spark.createDataFrame(given, SCHEMA).write.parquet(f"{tmp_path}/embeddings.parquet")
    found: dict[int, list] = {}
    for row in op6_nearest(spark, str(tmp_path)).orderBy("query_id", "rank").collect():
        found.setdefault(row["query_id"], []).append(row)
    want = neighbours(given)
    assert set(found) == {i for i, best in want.items() if best}
    hits = total = 0
    for i, best in want.items():
        own = found.get(i, [])
        assert [r["rank"] for r in own] == list(range(1, len(best) + 1))
        exact = dict(best)
        for r in own:
            if r["vec_id"] in exact:
                assert r["score"] == pytest.approx(exact[r["vec_id"]], rel=1e-12, abs=1e-12)
        assert [(r["score"], -r["vec_id"]) for r in own] == sorted(
            ((r["score"], -r["vec_id"]) for r in own), reverse=True
        )
        hits += len({r["vec_id"] for r in own} & set(exact))
        total += len(best)
    assert hits / total >= 0.95


def test_recall_of_the_buckets_alone(spark, tmp_path, monkeypatch):
    """Without the sample's candidates, on vectors without any structure."""
    monkeypatch.setattr(A, "SAMPLE", 300)
    monkeypatch.setattr(A, "TILE_VECTORS", 200)
    monkeypatch.setattr(A, "TILE_QUERIES", 40)
    monkeypatch.setattr(
        A, "_sampled", lambda queries, *_: queries.sparkSession.createDataFrame(
            [], "query_id bigint, id bigint, score double"
        )
    )
    rng = random.Random(11)
    given = [(i, [rng.gauss(0, 1) for _ in range(16)], None) for i in range(4000)]
    spark.createDataFrame(given, SCHEMA).write.parquet(f"{tmp_path}/embeddings.parquet")
    values = np.array([v for _, v, _ in given], np.float32).astype(float)
    hits = total = 0
    found: dict[int, set] = {}
    for row in op6_nearest(spark, str(tmp_path)).collect():
        found.setdefault(row["query_id"], set()).add(row["vec_id"])
    for i in range(0, 4000, 20):
        scores = values @ values[i]
        scores[i] = -np.inf
        hits += len(found[i] & set(np.argsort(-scores)[: A.K].tolist()))
        total += A.K
    assert hits / total >= 0.9, hits / total


def test_vectors_go_where_they_are_asked_for(spark, monkeypatch):
    """A bucket's vectors meet the parts of its own visits, and those of no other bucket."""
    monkeypatch.setattr(A, "TILE_VECTORS", 10)
    monkeypatch.setattr(A, "TILE_QUERIES", 5)
    cells = [("a", 40, 12), ("b", 7, 1), ("never", 100, 0)]
    index = [(3, 0, c, i, [1.0]) for c, n, _ in cells for i in range(n)]
    visits = [(3, 0, c, q, [1.0], 0.0) for c, _, n in cells for q in range(n)]
    vectors, asked = A._tiles(
        spark.createDataFrame(index, "length int, table int, cells string, id bigint, vector array<float>"),
        spark.createDataFrame(
            visits, "length int, table int, cells string, query_id bigint, query array<float>, least double"
        ),
    )
    assert {r["cells"]: r["count"] for r in vectors.groupBy("cells").count().collect()} == {"a": 120, "b": 7}
    assert {r["cells"]: r["count"] for r in asked.groupBy("cells").count().collect()} == {"a": 48, "b": 1}
    # Every vector of a bucket meets every visit of it once.
    keys = ["length", "table", "cells", "piece", "query_part"]
    assert vectors.join(asked, keys).count() == 40 * 12 + 7
