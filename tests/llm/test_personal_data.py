from __future__ import annotations

import hashlib
import math
import random
import re
import time
from collections import defaultdict

import pytest

from maskwright.llm import personal_data as P
from maskwright.llm.queries import op8_personal_data

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(map(int, reversed(digits))):
        total += d if i % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d)
    return total % 10 == 0


def keep(kind: str, value: str) -> bool:
    digits = re.sub("[^0-9]", "", value)
    if kind == "ip":
        return all(int(part) <= 255 for part in value.split("."))
    if kind == "card":
        return 14 <= len(digits) <= 19 and luhn(digits)
    return kind == "email" or 10 <= len(digits) <= 15


def base_spans(text: str) -> list[tuple[int, int, str, int, str]]:
    return sorted(
        (m.start(), i, kind, m.end(), m.group())
        for i, (kind, pattern) in enumerate(PATTERNS.items())
        for m in re.finditer(pattern, text)
        if keep(kind, m.group())
    )


def patterns(text: str, start: int, end: int) -> list[str]:
    plain = lambda s: re.sub("[0-9]+", "0", s.lower())
    left, right = (re.findall(r"[^ \t\n\x0b\f\r]+", plain(t)) for t in (text[:start], text[end:]))
    found = []
    if left:
        found += [f"1 {left[-1]}", f"2 {left[-2] if left[1:] else '^'} {left[-1]}"]
    if right:
        found.append(f"3 {left[-1] if left else '^'} {right[0]}")
        found += [f"4 {right[0]}", f"5 {right[0]} {right[1] if right[1:] else '$'}"]
    return found


def brute(rows: list[tuple]) -> list[tuple]:
    """The same by dictionaries, without Spark."""
    mentions, bases = [], []
    for i, (_, text) in enumerate(rows):
        text = text or ""
        base = base_spans(text)
        bases.append(base)
        mentions += [(i, s[0], s[3], s[4], True, patterns(text, s[0], s[3])) for s in base]
        for m in re.finditer(r"[A-Za-z0-9@_%+/.-]+", text):
            value, start = m.group(), m.start()
            if value[0] == "." or len(value) < 6 or not re.search("[0-9]", value):
                continue
            if not any(s[0] < m.end() and start < s[3] for s in base):
                mentions.append((i, start, m.end(), value, False, patterns(text, start, m.end())))
    edges: dict[tuple[str, str], bool] = defaultdict(bool)
    for _, _, _, value, seed, found in mentions:
        for pattern in found:
            edges[pattern, value] |= seed
    confidence: dict[str, float] = {}
    for _ in range(P.ROUNDS):
        sums = defaultdict(lambda: [0.0, 0])
        for (pattern, value), seed in edges.items():
            sums[pattern][0] += 1.0 if seed else confidence.get(value, 0.0)
            sums[pattern][1] += 1
        good = {
            p: round(s / n, 9)
            for p, (s, n) in sums.items()
            if round(s, 6) >= P.SUPPORT and round(s / n, 9) >= P.SHARE
        }
        doubts = defaultdict(float)
        for (pattern, value), seed in edges.items():
            if not seed and pattern in good:
                doubts[value] += math.log(1 - P.TRUST * good[pattern])
        confidence = {value: round(1 - math.exp(d), 9) for value, d in doubts.items()}
    out = []
    for i, (doc_id, _) in enumerate(rows):
        new = {
            (start, 4, "context", end, value)
            for j, start, end, value, seed, found in mentions
            if j == i and not seed and confidence.get(value, 0) >= P.CONFIDENCE
            and any(p in good for p in found)
        }
        every = sorted([*bases[i], *new])
        text_of = lambda spans: ",".join(f"{s[2]}:{s[0]}:{s[3]}" for s in spans)
        digest = hashlib.sha256(text_of(bases[i]).encode()).hexdigest()
        out.append(
            (doc_id, *(sum(s[2] == k for s in bases[i]) for k in PATTERNS), digest, text_of(every))
        )
    return sorted(out, key=repr)


def write(spark, folder, rows):
    spark.createDataFrame(rows, "doc_id bigint, text string").write.parquet(
        f"{folder}/documents.parquet"
    )


def contexts() -> list[str]:
    rng = random.Random(5)
    filler = ["the", "of", "house", "tree", "Weg", "día", "run"]
    made = []
    for i in range(120):
        words = [rng.choice(filler) for _ in range(12)]
        seed = rng.choice(
            [f"a{i}@mail.example.com", f"10.{i}.3.4", f"+1 (202) 555-{1000 + i}", "4111 1111 1111 1111"]
        )
        words.insert(6, f"reach me at {seed} thanks")
        if i % 8 == 0:
            words.insert(3, f"reach me at ID-{i:04d}-X thanks")
        if i % 4 == 0:
            words.insert(9, f"part no. ZX{i:05d} here")
        if i % 10 == 0:
            # Far away, longer than the window, at the start of the text, and behind it only.
            words.insert(0, rng.choice([f"{seed} is my member number", f"XK-{i:05d} is my member number"]))
            words.append(f"as {'m' * 90}\n{' ' * 80}{seed} {' ' * 70}{'w' * 100} end")
        made.append(" ".join(words))
    return made


def noise() -> list[str]:
    rng = random.Random(9)
    bits = list("0123456789") + ["@", ".", "-", " ", "+", "(", ")", "a", "B", "_", "é", "\n", "256", "4111"]
    return ["".join(rng.choice(bits) for _ in range(rng.randint(0, 60))) for _ in range(500)]


@pytest.fixture(scope="module")
def rows():
    texts = [None, "", *contexts(), *noise(), "1" * 3000, "a." * 3000, "a@b.c_d@e.f" * 50]
    rows = [(i if i % 11 else None, text) for i, text in enumerate(texts)]
    return [*rows, rows[5], rows[5]]


def test_query_is_brute_force(spark, tmp_path, rows):
    write(spark, tmp_path, rows)
    ours = sorted(map(tuple, op8_personal_data(spark, str(tmp_path)).collect()), key=repr)
    theirs = brute(rows)
    assert ours == theirs
    found = " ".join(row[-1] for row in theirs)
    assert found.count("context") >= 15
    texts = dict(enumerate(contexts()))
    assert "reach me at ID-0000-X" in texts[0]


def test_only_good_patterns_add(spark, tmp_path, rows):
    write(spark, tmp_path, [(i, text) for i, text in enumerate(contexts())])
    for doc_id, *_, spans in op8_personal_data(spark, str(tmp_path)).collect():
        text = contexts()[doc_id]
        for span in filter(lambda s: s.startswith("context"), spans.split(",")):
            _, start, end = span.split(":")
            assert text[int(start) : int(end)].startswith("ID-")


def test_empty_table(spark, tmp_path):
    write(spark, tmp_path, [])
    assert op8_personal_data(spark, str(tmp_path)).collect() == []


def test_a_value_at_the_start_of_a_text_is_found(spark, tmp_path):
    """Words behind a value are enough; nothing stands before it."""
    texts = [f"a{i}@mail.example.com is my member number" for i in range(9)]
    rows = list(enumerate([*texts, "XK-20441 is my member number", "XK-20442 was never it"]))
    write(spark, tmp_path, rows)
    found = sorted(map(tuple, op8_personal_data(spark, str(tmp_path)).collect()), key=repr)
    assert found == brute(rows)
    spans = {row[0]: row[-1] for row in found}
    assert spans[9] == "context:0:8" and spans[10] == ""


@pytest.mark.parametrize("chunk", [7, 4096])
def test_chunks_change_nothing(spark, tmp_path, monkeypatch, chunk):
    monkeypatch.setattr("maskwright.llm.spans.CHUNK", chunk)
    rows = list(enumerate(contexts()))
    write(spark, tmp_path, rows)
    assert sorted(map(tuple, op8_personal_data(spark, str(tmp_path)).collect()), key=repr) == brute(rows)


def test_work_grows_with_the_values_of_a_text(spark, tmp_path):
    def seconds(count: int) -> float:
        folder = tmp_path / str(count)
        text = " ".join(f"mail a{i}@b.example or ID-{i:06d}-X now" for i in range(count))
        write(spark, folder, [(1, text)])
        start = time.perf_counter()
        op8_personal_data(spark, str(folder)).collect()
        return time.perf_counter() - start

    seconds(50)
    few, many = seconds(4_000), seconds(16_000)
    assert many < 8 * few + 2, (few, many)


def test_text_without_values_is_not_counted_for_each_value(spark, tmp_path):
    values = " ".join(f"mail a{i}@b.example or ID-{i:06d}-X now" for i in range(150))

    def seconds(words: int) -> float:
        folder = tmp_path / str(words)
        write(spark, folder, [(1, values + " word" * words)])
        start = time.perf_counter()
        op8_personal_data(spark, str(folder)).collect()
        return time.perf_counter() - start

    short, long = seconds(1), seconds(400_000)
    assert long < short + 40, (short, long)
