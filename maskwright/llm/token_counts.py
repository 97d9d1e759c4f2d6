"""Numbers of tokens of texts by a word-level BPE file, without making the tokens.

A text is cut at the file's special strings, normalized, put in lower case and split into
words. The symbols of a word are its bytes, the last one marked as the word's end. They stand
in a linked list; a heap holds every pair of neighbours that can merge, by rank and then by
place. The lowest pair is popped and merged until none is left; entries whose symbols have
changed meanwhile are skipped. A word of n bytes takes O(n log n) steps, and its count is n
less the number of merges: no ids are made.

Defined cases: a null text counts as empty and has 0 tokens. Texts are never cut; a word is
only kept in the task's bounded cache if it is short, and long ones are counted anew. Repeated
rows each have their row, an empty table gives an empty one, and ties between pairs of one
rank go to the left one. The count is a column expression, so other columns cannot clash.
"""

from __future__ import annotations

import json
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass, field
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column

from maskwright.llm.batches import task_udf

#: The words of the format, matched in lower-case text; all else is left out.
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\p{White_Space}\p{L}\p{N}]+"
#: Half of the words kept with their counts by a task, and the longest that is kept.
KEPT_WORDS = 400_000
KEPT_LENGTH = 48
#: Texts over so many characters are matched word by word and not as one list.
LISTED_TEXT = 1_000_000


@dataclass(frozen=True)
class Merges:
    """What is needed to count: for two neighbouring symbols their rank and what they become,
    the symbols of single bytes within a word and at its end, and the special strings."""

    pairs: dict[int, tuple[int, int]] = field(repr=False)
    inner: list[int] = field(repr=False)
    last: list[int] = field(repr=False)
    special: tuple[str, ...]
    #: More than any symbol; two symbols a and b are looked up as a * width + b.
    width: int


def _byte_letters() -> list[str]:
    """The letter that stands for each byte in files of byte-level BPE: printable bytes stand
    for themselves, the others for the letters from U+0100 on, in order."""
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    hidden = iter(range(0x100, 0x200))
    return [chr(b if b in shown else next(hidden)) for b in range(256)]


def read_merges(path: str) -> Merges:
    """The merges of a tokenizer file in JSON whose model is BPE with word ends."""
    with open(path, encoding="utf-8") as file:
        content = json.load(file)
    model = content["model"]
    end = model.get("end_of_word_suffix") or ""
    symbols = _byte_letters()
    number = {s: i for i, s in enumerate(dict.fromkeys([*symbols, *(s + end for s in symbols)]))}
    merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
    width = len(merges) + 2 * 256 + 1
    pairs: dict[int, tuple[int, int]] = {}
    for rank, (left, right) in enumerate(merges):
        made = number.setdefault(left + right, len(number))
        pairs.setdefault(number[left] * width + number[right], (rank, made))
    added = content.get("added_tokens", [])
    if any(t.get(way) for t in added for way in ("single_word", "lstrip", "rstrip", "normalized")):
        raise ValueError("special strings must count wherever they stand in the raw text")
    special = [t["content"] for t in added]
    return Merges(
        pairs,
        [number[s] for s in symbols],
        [number[s + end] for s in symbols],
        tuple(sorted(special, key=len, reverse=True)),
        width,
    )


class Counter:
    """Counts of tokens by merges."""

    def __init__(self, merges: Merges):
        self.merges = merges
        self.words = regex.compile(WORDS)
        self.special = regex.compile("|".join(map(regex.escape, merges.special)))
        self.kept = _Kept(self)

    def merged(self, word: bytes) -> int:
        """The number of tokens of one word."""
        inner, pair_of, width = self.merges.inner, self.merges.pairs.get, self.merges.width
        size = len(word)
        if not size:
            return 0
        symbols = [inner[b] for b in word]
        symbols[-1] = self.merges.last[word[-1]]
        # A pair stands in the heap as rank, place, and what it would become.
        heap = []
        for i in range(size - 1):
            found = pair_of(symbols[i] * width + symbols[i + 1])
            if found:
                heap.append((found[0], i, found[1]))
        if not heap:
            return size
        heapify(heap)
        after = list(range(1, size + 1))
        before = list(range(-1, size))
        # What the pair that starts here would become now; -1: nothing, or no start any more.
        becomes = [-1] * size
        for _, i, made in heap:
            becomes[i] = made
        merges = 0
        while heap:
            _, i, made = heappop(heap)
            if becomes[i] != made:
                continue
            merges += 1
            gone = after[i]
            right = after[i] = after[gone]
            symbols[i] = made
            becomes[gone] = becomes[i] = -1
            if right < size:
                before[right] = i
                found = pair_of(made * width + symbols[right])
                if found:
                    becomes[i] = found[1]
                    heappush(heap, (found[0], i, found[1]))
            left = before[i]
            if left >= 0:
                found = pair_of(symbols[left] * width + made)
                if found:
                    becomes[left] = found[1]
                    heappush(heap, (found[0], left, found[1]))
                else:
                    becomes[left] = -1
        return size - merges

    def count(self, text: str) -> int:
        """The number of tokens of a text; a special string is one."""
        if not any(mark in text for mark in self.merges.special):
            return self._plain(text)
        parts = self.special.split(text)
        return sum(map(self._plain, parts)) + len(parts) - 1

    def _plain(self, text: str) -> int:
        text = unicodedata.normalize("NFC", text)
        # Letter by letter, so a capital sigma never becomes the final form.
        text = text.replace("Σ", "σ").lower()
        if len(text) > LISTED_TEXT:
            words: Iterator[str] = (match.group() for match in self.words.finditer(text))
            return sum(map(self.kept.__getitem__, words))
        return sum(map(self.kept.__getitem__, self.words.findall(text)))


class _Kept(dict):
    """Counts by word, bounded: a full half is put aside, and what is met again moves out of
    it before the next half goes."""

    def __init__(self, counter: Counter):
        super().__init__()
        self.counter, self.aside = counter, {}

    def __missing__(self, word: str) -> int:
        count = self.aside.get(word)
        if count is None:
            count = self.counter.merged(word.encode())
            if len(word) > KEPT_LENGTH:
                return count
        if len(self) >= KEPT_WORDS:
            self.aside = dict(self)
            self.clear()
        self[word] = count
        return count


def token_count(text: Column, merges: Merges) -> Column:
    """The number of tokens of a text column, as long; 0 for null texts."""

    def make():
        count = Counter(merges).count

        def counted(texts: pa.Array) -> pa.Array:
            numbers = (count(value.as_py() or "") for value in texts)
            return pa.array(np.fromiter(numbers, np.int64, len(texts)))

        return counted

    return task_udf(make, "bigint")(text)
