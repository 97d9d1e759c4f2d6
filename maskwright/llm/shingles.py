"""Hashed word shingles of texts, as NumPy arrays."""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column

from maskwright.llm.batches import task_udf

WORDS = 5
_WORD = re.compile(r"\w+")
#: Hashes of words kept by a Python worker.
KEPT_WORDS = 50_000
#: Words that are worked on at once.
BLOCK_WORDS = 100_000
GOLDEN = np.uint64(0x9E3779B97F4A7C15)


class _Hashes(dict):
    def __missing__(self, word: str) -> int:
        if len(self) >= KEPT_WORDS:
            self.clear()
        number = self[word] = xxhash.xxh3_64_intdigest(word)
        return number


_hashes = _Hashes()


def mixed(x: np.ndarray) -> np.ndarray:
    """Well-spread 64-bit values, by the finalizer of SplitMix64."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(text: str | None, words: int = WORDS) -> np.ndarray:
    """One hash for each run of so many words, in lower case and without punctuation.

    A shorter text is one shingle; a text without words has none.
    """
    found = _WORD.findall((text or "").lower())
    if not found:
        return np.empty(0, np.uint64)
    hashes = np.fromiter(map(_hashes.__getitem__, found), np.uint64, len(found))
    width = min(words, len(hashes))
    runs = np.zeros(len(hashes) - width + 1, np.uint64)
    for i in range(width):
        runs = (runs ^ hashes[i : i + len(runs)]) * GOLDEN
        runs ^= runs >> np.uint64(29)
    return mixed(runs + np.uint64(width))


def blocks(texts: Iterable[str | None], words: int) -> Iterator[list[np.ndarray]]:
    """The shingles of texts, some texts at a time, so that memory stays bounded."""
    block, size = [], 0
    for text in texts:
        runs = shingles(text, words)
        block.append(runs)
        size += len(runs)
        if size >= BLOCK_WORDS:
            yield block
            block, size = [], 0
    if block:
        yield block


def shingle_set(text: Column, words: int = WORDS) -> Column:
    """The distinct shingle hashes of a text column, ``array<bigint>``, ascending."""

    def sets(texts: pa.Array) -> pa.Array:
        flat, ends = [np.empty(0, np.int64)], [0]
        for value in texts:
            flat.append(np.unique(shingles(value.as_py(), words)).view(np.int64))
            ends.append(ends[-1] + len(flat[-1]))
        return pa.ListArray.from_arrays(
            pa.array(ends, pa.int32()), pa.array(np.concatenate(flat), pa.int64())
        )

    return task_udf(lambda: sets, "array<bigint>")(text)
