from __future__ import annotations

import random

import numpy as np
import pytest

from maskwright.llm import near_duplicates as N
from maskwright.llm.components import components
from maskwright.llm.darts import signatures
from maskwright.llm.near_duplicates import drop_near_duplicates, near_duplicates
from maskwright.llm.queries import op9_dart_minhash
from maskwright.llm.shingles import shingles


@pytest.mark.parametrize("overlap", [0.4, 0.8, 0.95])
def test_shared_coordinates_estimate_similarity(overlap):
    rng = np.random.default_rng(0)
    found = []
    common = round(500 * 2 * overlap / (1 + overlap))
    for _ in range(30):
        base = rng.integers(0, 2**63, 1000, dtype=np.uint64)
        a, b = base[:500], np.r_[base[:common], base[500 : 1000 - common]]
        both = signatures(
            np.r_[a, b], np.ones(len(a) + len(b)), np.repeat([0, 1], [len(a), len(b)]), 2, 160
        )
        found.append((both[0] == both[1]).mean())
    assert abs(np.mean(found) - overlap) < 0.03


def test_shared_coordinates_estimate_weighted_similarity():
    rng, found = np.random.default_rng(1), []
    v, w = np.array([3.0, 1.5, 0.5, 0.0]), np.array([1.0, 2.5, 0.5, 0.25])
    for _ in range(300):
        e = rng.integers(0, 2**63, 4, dtype=np.uint64)
        both = signatures(np.r_[e, e], np.r_[v, w], np.repeat([0, 1], 4), 2, 160)
        found.append((both[0] == both[1]).mean())
    assert abs(np.mean(found) - np.minimum(v, w).sum() / np.maximum(v, w).sum()) < 0.03


def test_a_signature_depends_on_its_set_alone():
    rng = np.random.default_rng(2)
    sets = [rng.integers(0, 2**63, n, dtype=np.uint64) for n in (1, 2, 50, 3000)]
    together = signatures(
        np.concatenate(sets), np.ones(3053), np.repeat(range(4), [len(s) for s in sets]), 5, 160
    )
    assert (together[4] == np.uint64(2**64 - 1)).all()
    for i, s in enumerate(sets):
        alone = signatures(s[::-1], np.ones(len(s)), np.zeros(len(s), int), 1, 160)
        assert (alone[0] == together[i]).all()


def brute(rows: list[tuple]) -> dict[int, int]:
    sets = {i: set(shingles(t).tolist()) for i, t in rows}
    texts = dict(rows)
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[:n]:
            both = len(sets[a] & sets[b])
            union = len(sets[a] | sets[b])
            same = (texts[a] or "") == (texts[b] or "")
            if same or union and both / union >= N.SIMILARITY:
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {i: find(i) for i in ids}


def rows(seed=4) -> list[tuple]:
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(400)]
    passage = [rng.choice(words) for _ in range(60)]
    out: list[str | None] = []
    for _ in range(60):
        text = [rng.choice(words) for _ in range(rng.choice([3, 8, 60, 200]))]
        out.append(" ".join(text))
        for _ in range(rng.choice([0, 0, 1, 2])):
            copy = list(text)
            for _ in range(rng.choice([0, 1, 2, 5])):
                copy[rng.randrange(len(copy))] = rng.choice(words)
            out.append(" ".join(copy))
    # A large group whose members differ more and more, and texts that share a passage.
    base = [rng.choice(words) for _ in range(120)]
    for i in range(120):
        copy = list(base)
        for _ in range(rng.randrange(12)):
            copy[rng.randrange(len(copy))] = rng.choice(words)
        out.append(" ".join(copy))
        out.append(" ".join(passage + [rng.choice(words) for _ in range(40 + i % 50)]))
    out += [None, None, "", " ", "...", "!!", "Same Words, here", "same words here", "one"]
    out += [out[0]] * 40 + ["x " * 30_000, "x " * 30_001]
    rng.shuffle(out)
    return [(i * 3 + 1, text) for i, text in enumerate(out)]


def test_query_is_brute_force(spark, tmp_path):
    given = rows()
    spark.createDataFrame(given, "doc_id bigint, text string").write.parquet(
        f"{tmp_path}/documents.parquet"
    )
    want = brute(given)
    assert len(set(want.values())) < len(want) - 80
    found = op9_dart_minhash(spark, str(tmp_path)).collect()
    assert sorted(map(tuple, found)) == sorted((i, c, i == c) for i, c in want.items())


def test_ids_broadcast_or_not(spark, monkeypatch):
    given = rows(5)[:120]
    docs = spark.createDataFrame(given, "doc_id bigint, text string")
    first = sorted(map(tuple, near_duplicates(docs).collect()))
    monkeypatch.setattr(N, "BROADCAST_IDS", 0)
    assert sorted(map(tuple, near_duplicates(docs).collect())) == first
    assert sorted(r["doc_id"] for r in drop_near_duplicates(docs).collect()) == sorted(
        i for i, _, kept in first if kept
    )


def test_one_row_of_each_class_stays(spark):
    text = "some words that are long enough to have shingles of five words"
    given = [(5, text, "k"), (3, text + " more", "k"), (3, text + " more", "k"), (9, "other", "k")]
    given += [(None, "without an id", None), (None, "without an id", None), (8, None, None)]
    docs = spark.createDataFrame(given, "doc_id bigint, text string, `key.1` string")
    kept = drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    assert sorted(map(tuple, kept.collect()), key=repr) == sorted(
        [given[1], given[3], given[4], given[6]], key=repr
    )


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id bigint, text string")
    assert near_duplicates(docs).collect() == [] and drop_near_duplicates(docs).collect() == []


def test_components(spark):
    rng = random.Random(7)
    links = [(rng.randrange(400), rng.randrange(400)) for _ in range(180)]
    links += [(i, i + 1) for i in range(1000, 1300)] + [(2000, i) for i in range(2001, 2500)]
    links += [(5, 5), (7, 7)] + links[:20]
    parent: dict[int, int] = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in links:
        if a != b:
            x, y = find(a), find(b)
            parent[max(x, y)] = min(x, y)
    found = components(spark.createDataFrame(links, "a bigint, b bigint")).collect()
    assert sorted(map(tuple, found)) == sorted((x, find(x)) for x in parent)
    assert components(spark.createDataFrame([], "a bigint, b bigint")).collect() == []
