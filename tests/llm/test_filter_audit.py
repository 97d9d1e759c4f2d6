from __future__ import annotations

import random
from collections import Counter
from itertools import permutations
from pathlib import Path

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from maskwright.llm.filter_audit import filter_audit, gallop, posting_lists, removals, without
from maskwright.llm.queries import ORACLES, op12_filter_audit


def test_galloping_finds_what_sets_find():
    rng = np.random.default_rng(4)
    for _ in range(400):
        a, b, c = (
            np.unique(rng.integers(0, rng.choice([3, 50, 2000]), rng.choice([0, 1, 5, 200, 900])))
            for _ in range(3)
        )
        assert gallop(a, b).tolist() == [x in set(b) for x in a]
        assert without(a, [b, c]).tolist() == sorted(set(a) - set(b) - set(c))


ROWS = 900


def documents() -> list[tuple]:
    rng = random.Random(6)
    words = ["a", "b", "C", "Dé", "EF", "#x", "word", "\x1c", " ", "\n", "x\ty"]
    rows = []
    for i in range(ROWS):
        size = rng.choice([0, 3, 99, 100, 101, 130])
        own = [f"w{i}-{j}" if rng.random() < 0.7 else rng.choice(words) for j in range(size)]
        text = rng.choice([" ", "\n ", "  "]).join(own)
        # A third in one part, nulls, the empty part, and copies across parts.
        lang = rng.choice(["en", "en", "de", None, "", "it's"])
        text = rng.choice([text, text, None, "copy of " * 60, "Ü" * 9, "A" * 11 + "é" * 100])
        rows.append((rng.choice([i, i, i, i // 3]), text, lang, "own"))
    rows += [(None, "copy of " * 60, "en", "x"), (None, "copy of " * 60, "en", "x"), (5, "long " * 90_000, "xx", "")]
    return [*rows, rows[7], rows[7]]


LABELS = [(i, i % 3 % 2, 1 if i % 7 == 0 else None) for i in range(0, ROWS, 2)] + [(4, 1, 1), (None, 1, 1)]


def fails(rows):
    first = {}
    for i, text, *_ in rows:
        if i is not None:
            first[text or ""] = min(first.get(text or "", i), i)
    for i, text, *_ in rows:
        text = text or ""
        words = text.encode().split()  # bytes split at ASCII white space only
        yield "".join(
            letter
            for letter, failed in {
                "A": len(words) < 100,
                "B": 100 * len(set(words)) < 80 * len(words),
                "C": 100 * sum("A" <= c <= "Z" for c in text) > 10 * len(text),
                "D": any(c in "#$%&*|" for c in text),
                "E": i is not None and i > first[text],
            }.items()
            if failed
        )


def brute(rows, labels) -> list[tuple]:
    good = {i for i, quality, _ in labels if quality == 1 and i is not None}
    toxic = {i for i, _, t in labels if t == 1 and i is not None}
    parts: dict[str, list] = {}
    for row, failed in zip(rows, fails(rows)):
        parts.setdefault(row[2] or "", []).append((row[0], failed))
    out = []
    for part, docs in parts.items():
        found, shares = [], Counter()
        for order in permutations("ABCDE"):
            left, gone = docs, []
            for step, f in enumerate(order, 1):
                removed = [d for d in left if f in d[1]]
                redundant = sum(f in d[1] for d in gone)
                left, gone = [d for d in left if f not in d[1]], gone + removed
                shares[f] += len(removed)
                ids = [d[0] for d in removed]
                found.append(
                    (part, "".join(order), step, len(left), len(removed), redundant,
                     sum(d[1] == f for d in docs), sum(i in good for i in ids), sum(i in toxic for i in ids))
                )
        out += [(*row, shares[row[1][row[2] - 1]]) for row in found]
    return sorted(out)


def written(spark, folder, rows, labels) -> str:
    spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string").write.parquet(
        f"{folder}/documents.parquet"
    )
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(
        f"{folder}/labels.parquet"
    )
    return str(folder)


def by_sql(folder: str) -> list[tuple]:
    connection = duckdb.connect()
    for name in ("documents", "labels"):
        connection.execute(f"CREATE VIEW {name} AS FROM '{folder}/{name}.parquet/*.parquet'")
    return sorted(connection.execute(ORACLES["op12_filter_audit"]).fetchall())


def test_query_equals_brute_force_and_sql(spark, tmp_path):
    folder = written(spark, tmp_path, documents(), LABELS)
    found = op12_filter_audit(spark, folder)
    assert found.columns == [
        "part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails",
        "good_lost", "toxic_lost", "shapley",
    ]
    rows = sorted(map(tuple, found.collect()))
    assert rows == brute(documents(), LABELS) == by_sql(folder)
    assert len(rows) == 600 * 5 and any(row[7] for row in rows) and any(row[8] for row in rows)
    # Every document is somewhere, and the shares of an order add up to what is removed.
    assert sum(row[3] + row[4] for row in rows if row[1:3] == ("ABCDE", 1)) == len(documents())


@pytest.mark.parametrize("rows", ["1", "7"])
def test_ranges_of_any_size_add_up(spark, tmp_path, rows):
    """Parts cut into ranges of a few rows give what whole parts give."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", rows)
    try:
        folder = written(spark, tmp_path, documents()[:120], LABELS)
        found = op12_filter_audit(spark, folder).collect()
        assert sorted(map(tuple, found)) == brute(documents()[:120], LABELS)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_postings_are_sorted_places_of_failures(spark):
    rows = [("p", i, i % 4) for i in range(50)] + [("q", None, 3), ("q", 1, 0)]
    lists = posting_lists(spark.createDataFrame(rows, "part string, id bigint, bits int"), 2)
    found = lists.collect()
    assert sum(row["documents"] for row in found) == 52
    assert sum(len(row["lists"][0]) for row in found) == sum(bits & 1 for *_, bits in rows)
    assert all(list(one) == sorted(set(one)) for row in found for one in row["lists"])
    sizes = {(r["part"], r["filter"], r["earlier"]): r for r in removals(lists, 2, 0).collect()}
    assert sizes["p", 0, 0]["removed"] == 25 and sizes["p", 0, 2]["removed"] == 13
    assert sizes["p", 1, 1]["together"] == 37 and sizes["q", 1, 1]["removed"] == 0


def test_empty_tables_and_other_filters(spark, tmp_path):
    assert op12_filter_audit(spark, written(spark, tmp_path, [], [])).collect() == []
    docs = spark.createDataFrame(
        [(1, "x", 3, 0), (2, "y", 3, 0), (3, None, None, 0)], "id int, part string, bits int, digest int"
    )
    found = filter_audit(
        docs, {"X": F.col("part") == "x", "N": F.col("part").isNull()}, part=F.col("bits"), id_col="id",
        text_col="part",
    )
    rows = {(r["part"], r["filter_order"], r["step"]): r["kept"] for r in found.collect()}
    assert rows == {
        ("3", "XN", 1): 1, ("3", "XN", 2): 1, ("3", "NX", 1): 2, ("3", "NX", 2): 1,
        ("", "XN", 1): 1, ("", "XN", 2): 0, ("", "NX", 1): 0, ("", "NX", 2): 0,
    }
    with pytest.raises(ValueError, match="filters"):
        filter_audit(docs, {c: F.lit(True) for c in "ABCDEFGH"}, part=F.col("part"), id_col="id")


def test_rows_of_the_test_tables(spark):
    folder = Path("/root/testdata/sf0.001")
    if folder.exists():
        connection = duckdb.connect()
        for name in ("documents", "labels"):
            connection.execute(f"CREATE VIEW {name} AS FROM '{folder}/{name}.parquet'")
        theirs = sorted(connection.execute(ORACLES["op12_filter_audit"]).fetchall())
        assert sorted(map(tuple, op12_filter_audit(spark, str(folder)).collect())) == theirs
