from __future__ import annotations

import random
import re
from collections import defaultdict

import duckdb
import pytest
from pyspark.sql import functions as F

from maskwright.llm import mixing
from maskwright.llm.mixing import mix_sources, training_order
from maskwright.llm.queries import ORACLES, op2_mixing

SCHEMA = "doc_id bigint, text string, source string, mix string, `a.b` int, size int"


def rows() -> list[tuple]:
    rng = random.Random(2)
    out = []
    for i in range(700):
        source = rng.choice(["hot"] * 6 + ["a", "b", "é", "Z", None, "none"])
        words = rng.choice([0, 1, 3, 9, 30, 200])
        text = None if i % 97 == 0 else rng.choice(["", " ", "\n"]).join([""] * 2) + " w\t".join(["x"] * (words + 1))
        out.append((i if i % 50 else None, text, source, "kept", i, -1))
    return [*out, out[5], out[5], (1, "only", "tiny", None, None, None), (2, "", "empty", None, None, None)]


def size(text) -> int:
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def filled(sizes: dict, share: float, most: float) -> dict:
    """Targets by resharing the excess again and again."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: mixing.WEIGHTS[i % 3] for i, s in enumerate(names)}
    target, free, left = {}, set(names), share * sum(sizes.values())
    while True:
        level = left / sum(weight[s] for s in free)
        over = {s for s in free if level * weight[s] > most * sizes[s]}
        if not over:
            return target | {s: level * weight[s] for s in free}
        for s in over:
            target[s] = most * sizes[s]
            left -= target[s]
            free.remove(s)


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("mixing"))
    spark.createDataFrame(rows(), SCHEMA).write.parquet(f"{folder}/documents.parquet")
    return folder


def test_query(spark, folder):
    made = op2_mixing(spark, folder)
    found = made.collect()
    sizes = defaultdict(int)
    for _, text, source, *_ in rows():
        sizes[source] += size(text)
    targets = filled(dict(sizes), mixing.SHARE, mixing.MOST)
    assert sorted((r["doc_id"], r["size"]) for r in found if r["doc_id"]) == sorted(
        (r[0], size(r[1])) for r in rows() if r[0]
    )
    total = defaultdict(int)
    for row in found:
        assert 0 <= row["taken"] <= 2 * row["size"]
        total[row["source_size"], round(row["target"], 6)] += row["taken"]
    assert sorted(total) == sorted({(sizes[s], round(t, 6)) for s, t in targets.items()})
    for (_, target), taken in total.items():
        assert target - 1 <= taken <= target
    again = op2_mixing(spark, folder).collect()
    assert sorted(map(tuple, again), key=repr) == sorted(map(tuple, found), key=repr)


def test_query_is_sql(spark, folder):
    connection = duckdb.connect()
    connection.execute(
        f"CREATE VIEW documents AS SELECT * FROM '{folder}/documents.parquet/*.parquet'"
    )
    theirs = connection.execute(ORACLES["op2_mixing"])
    names = [c[0] for c in theirs.description]
    ours = op2_mixing(spark, folder).select(*names).collect()
    assert sorted(map(tuple, ours), key=repr) == sorted(theirs.fetchall(), key=repr)


def test_training_order_follows_the_schedules(spark):
    docs = spark.range(6000).select(
        F.col("id").alias("doc_id"),
        F.lit("a b c d").alias("text"),
        F.concat(F.lit("s"), F.col("id") % 3).alias("source"),
    )
    ordered = training_order(mix_sources(docs))
    assert ordered.columns == ["doc_id", "text", "source", "mix"]
    uses = ordered.select("source", "mix.*").collect()
    positions = [r["position"] for r in uses]
    assert positions == sorted(positions) and 0 <= positions[0] and positions[-1] <= 1
    # Of a source, the share demanded by a moment is the integral of its weights up to it.
    for name, schedule in zip(("s0", "s1", "s2"), mixing.SCHEDULES):
        own = [r["position"] for r in uses if r["source"] == name]
        for moment in (0.25, 0.5, 0.8):
            steps = [i / 2000 for i in range(2001)]

            def weight(t):
                for (t0, w0), (t1, w1) in zip(schedule, schedule[1:]):
                    if t <= t1:
                        return w0 + (w1 - w0) * (t - t0) / (t1 - t0)

            done = sum(weight(t) for t in steps if t <= moment) / sum(map(weight, steps))
            assert abs(sum(p <= moment for p in own) / len(own) - done) < 0.01


def test_the_last_use_is_cut_to_the_words_taken(spark, folder):
    mixed = mix_sources(spark.read.parquet(f"{folder}/documents.parquet"))
    assert mixed.columns[-1] == "mix_"
    for row in training_order(mixed).collect():
        assert size(row["text"]) == row["mix_"]["words"] > 0
        assert row["mix"] in ("kept", None) and row["size"] in (-1, None)


def test_empty_tables(spark):
    docs = spark.createDataFrame([], "doc_id bigint, text string, source string")
    assert training_order(mix_sources(docs)).collect() == []
    docs = spark.createDataFrame([(1, None, None)], docs.schema)
    mix = mix_sources(docs).first()["mix"]
    assert (mix["size"], mix["target"], mix["taken"], mix["takes"]) == (0, 0.0, 0, [])


def test_native_plan(spark, folder):
    plan = op2_mixing(spark, folder)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas|CartesianProduct", plan)
