from __future__ import annotations

import hashlib
import heapq
import random
import re
import zlib

import pytest

from maskwright.llm import conversation_repair
from maskwright.llm.conversation_repair import Search, repair, search
from maskwright.llm.queries import op13_conversation_repair

GOOD, BEGUN = re.compile(r"(s?(ua)+)?\Z"), re.compile(r"s?(ua)*u?\Z")


def cheapest(rows: list[tuple[str, str, str]]) -> tuple[int, str, tuple]:
    """The cost, the edits and the repaired rows of rows (role, text, fault), by Dijkstra over
    (cost, edits)."""
    heap, done = [(0, "", 0, "", ())], set()
    while True:
        cost, edits, i, initials, kept = heapq.heappop(heap)
        if i == len(rows) and GOOD.match(initials):
            return cost, edits, kept
        if (i, initials[-1:]) in done:
            continue
        done.add((i, initials[-1:]))

        def push(more, edit, j, new=None):
            grown = initials + new[0][0] if new else initials
            if BEGUN.match(grown):
                own = (*kept, new) if new else kept
                heapq.heappush(heap, (cost + more, edits + edit, j, grown, own))

        for role in ("user", "assistant"):
            push(3, "I", i, (role, ""))
        if i < len(rows):
            role, text, fault = rows[i]
            push(4, "D", i + 1)
            if fault not in ("blank", "duplicate"):
                more = 3 if fault == "truncated" else 0
                if role[:1] in ("s", "u", "a"):
                    push(more, "K", i + 1, (role, text))
                for other in ("user", "assistant"):
                    push(3 + more, "R", i + 1, (other, text))


def brute(rows) -> list[tuple]:
    conversations: dict = {}
    for conv, turn, role, text in rows:
        own = conversations.setdefault(conv, [])
        role, text = " " if role is None else role, " " if text is None else text
        names = (" " if v is None else v for v in (conv, turn))
        damage = zlib.crc32(":".join(map(str, names)).encode()) % 20
        if damage == 1:
            text = ""
        if damage == 2:
            text = re.sub("[.!?]", "", text)
        if damage == 4:
            role = "user"
        own += [(turn, role, text)] * (0 if damage == 0 else 2 if damage == 3 else 1)
    out = []
    for conv, own in conversations.items():
        own.sort(
            key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.sha256(r[2].encode()).digest())
        )
        turns = {turn for turn, *_ in own if turn is not None}
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        faults, seen = [], set()
        for _, role, text in own:
            shown = re.sub(r"[\x20\x09-\x0D]", "", text)
            fault = "blank" if not shown else "duplicate" if (role, text) in seen else ""
            faults.append(fault or ("" if shown[-1] in ".!?" else "truncated"))
            seen.add((role, text))
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(own, own[1:]))
        cost, edits, kept = cheapest([(r, t, f) for (_, r, t), f in zip(own, faults)])
        digest = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in kept).encode()).hexdigest()
        counts = (faults.count(f) for f in ("blank", "duplicate", "truncated"))
        out.append((conv, gaps, *counts, illegal, cost, edits, digest))
    return sorted(out, key=repr)


def letter(role: str, fault: str) -> str:
    if fault in ("blank", "duplicate"):
        return "-"
    plain = role[0] if role[0] in "sua" else "?"
    return ("!" if plain == "?" else plain.upper()) if fault else plain


@pytest.mark.parametrize("block", [1, 2, 3, 16])
def test_search_equals_dijkstra(block, monkeypatch):
    monkeypatch.setattr(conversation_repair, "BLOCK", block)
    rng = random.Random(block)
    roles = ["system", "user", "assistant", "user", "assistant", "tool", " "]
    for _ in range(250):
        clean = rng.random() < 0.3
        rows = [
            (rng.choice(roles), f"t{i}", "" if clean else rng.choice(["", "", "", "blank", "duplicate", "truncated"]))
            for i in range(rng.randint(0, 30))
        ]
        ours = Search()
        for role, _, fault in rows:
            ours.add(letter(role, fault))
        assert ours.result() == cheapest(rows)[:2], rows


def test_letters_of_equally_cheap_edits():
    """Deleting and a new row cost more than another role; of equal costs D comes before I."""
    assert search("", 0, (0, 3), True) == (0, "")
    assert search("ua", 0, (0, 3), True) == (0, "KK")
    assert search("uu", 0, (0, 3), True) == (3, "KR")
    assert search("s", 0, (0, 3), True) == (4, "D")
    assert search("ss", 0, (0, 3), True) == (6, "KIR")
    assert search("?", 0, (0, 3), True) == (4, "D")
    assert search("U", 0, (0, 3), True) == (4, "D")
    assert search("uua", 0, (0, 3), True) == (3, "KIKK")
    assert search("u", 3, (0,), False) is None and search("ua", 0, (1,), False) is None


def test_a_conversation_of_very_many_rows():
    """Work grows with the rows: 200,000 of them, a fifth with faults."""
    rng = random.Random(2)
    ours = Search()
    for i in range(200_000):
        ours.add(rng.choice("ua" * 10 + "s-UA?") if i % 5 == 0 else "ua"[i % 2])
    cost, edits = ours.result()
    assert len(edits) - edits.count("I") == 200_000
    prices = {"D": 4, "I": 3, "K": 0, "R": 3}
    assert cost >= sum(prices[e] for e in edits)


TEXTS = ["Yes.", "No!", "cut", "", " \n", "Why?  \t", "é", ".", None, "x." * 9, "a\x1c", "…"]


def conversations() -> list[tuple]:
    rng = random.Random(8)
    rows = []
    for conv in range(250):
        turns = rng.choice([1, 2, 4, 6, 9, 40])
        for turn in range(turns):
            role = rng.choice(["user", "assistant"]) if rng.random() < 0.2 else ["user", "assistant"][turn % 2]
            role = rng.choice([role] * 9 + ["system", None, "", "tool", "User"])
            rows.append((conv, rng.choice([turn] * 12 + [None, turn + 2]), role, rng.choice(TEXTS)))
    hot = [(1000, i, ["user", "assistant"][i % 2], f"row {i}.") for i in range(1500)]
    repeated = [(1001, 1, "user", "same.")] * 40
    rows += [(None, 0, "user", "Hi."), (None, None, None, None), (None, 1, "assistant", "Ho.")]
    rows += [(2000 + i, 0, "user", "a.") for i in range(60)] + [(3000, 0, "user", "w " * 400_000 + ".")]
    return rows + hot + repeated


def written(spark, folder, rows, kind="conv_id bigint, turn bigint, role string, text string"):
    spark.createDataFrame(rows, kind).write.parquet(f"{folder}/conversations.parquet")
    return str(folder)


def test_query_equals_brute_force(spark, tmp_path):
    folder = written(spark, tmp_path, conversations())
    found = op13_conversation_repair(spark, folder)
    assert found.columns == [
        "conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256",
    ]
    rows = sorted(map(tuple, found.collect()), key=repr)
    assert rows == brute(conversations())
    # Some conversations have lost all their rows.
    assert any(row[7] == "" for row in rows)


def test_small_batches_change_nothing(spark, tmp_path):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
    try:
        folder = written(spark, tmp_path, conversations()[:400])
        found = op13_conversation_repair(spark, folder).collect()
        assert sorted(map(tuple, found), key=repr) == brute(conversations()[:400])
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_empty_table_and_other_names(spark, tmp_path):
    assert op13_conversation_repair(spark, written(spark, tmp_path, [])).collect() == []
    kind = "c string, turn int, who string, said string, audit string, place string, digest string"
    rows = [("x", 2, "user", "b.", "own", "p", "d"), ("x", 1, "user", "a.", "own", "p", "d")]
    found = repair(
        spark.createDataFrame(rows, kind), conversation="c", turn="turn", role="who", text="said"
    )
    assert [tuple(r) for r in found.audits.collect()] == [("x", 0, 0, 0, 0, 1, 3, "KR")]
    assert [tuple(r) for r in found.rows.collect()] == [
        ("x", 0, "K", "user", "a."), ("x", 1, "R", "assistant", "b."),
    ]
