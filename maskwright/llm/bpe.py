"""Byte-level BPE by a rank file: encoding with a queue of ranks, and decoding.

A pre-token starts as single bytes in a linked list. Every pair of neighbours that has a
rank stands in the bucket of that rank; a hierarchical bitmap over the ranks tells with a
few find-first-set steps which bucket is the lowest that is not empty. Merging changes two
pairs at most; entries made stale by a merge are skipped when they come up. So a pre-token
of n bytes takes O(n log n) steps, however long it is. The bucket of a short pre-token is itself
a bitmap of its positions, that of a long one a heap.

The ids of short pre-tokens are kept as bytes, so that those of a text are joined, not copied
one by one; the ids of a whole batch are decoded by one gather over the tokens.

Defined cases: a null text counts as empty and gives no ids. Texts are never cut. Repeated rows
each have their ids, an empty table gives an empty one. Two pairs of one rank merge from left
to right. Ids and bytes are column expressions, so other columns cannot clash.
"""

from __future__ import annotations

import base64
from array import array
from collections.abc import Callable
from heapq import heappop, heappush

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import Column

from maskwright.llm.batches import task_udf

#: Half of the pre-tokens kept with their ids by a task, and the longest that is kept.
KEPT_PIECES = 400_000
KEPT_LENGTH = 48
#: Texts over so many characters are matched piece by piece and not as one list.
LISTED_TEXT = 1_000_000
#: The longest pre-token, in bytes, whose positions fit a small bitmap.
SHORT = 60


def read_ranks(path: str) -> dict[bytes, int]:
    """The ranks of a file with a base64 token and its rank in each line."""
    with open(path, "rb") as lines:
        parts = (line.split() for line in lines)
        return {base64.b64decode(part[0]): int(part[1]) for part in parts if part}


class Encoder:
    """Ids of texts by ranks; each match of the pattern is encoded on its own.

    The queue: a bucket of positions for each rank; a bit for each bucket that is not
    empty, in words of about the square root of their number of bits; above these, a bit
    for each word that is not zero. It is empty between pre-tokens.
    """

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks = ranks
        count = max(ranks.values(), default=0) + 1
        self.shift = max(1, (count - 1).bit_length() + 1 >> 1)
        self.buckets: list[list[int]] = [[] for _ in range(count)]
        self.masks = [0] * count
        self.words = [0] * ((count >> self.shift) + 1)
        of_bytes = [bytes((b,)) for b in range(256)]
        #: The rank of each two bytes, or -1.
        self.two = [[ranks.get(a + b, -1) for b in of_bytes] for a in of_bytes]
        self.single = [ranks.get(b, -1) for b in of_bytes]
        # White space is Unicode's property; Python's own class also has four separators.
        spaces = pattern.replace(r"\s", r"\p{White_Space}").replace(r"\S", r"\P{White_Space}")
        self.pattern = regex.compile(spaces)
        self.kept = _Kept(self)

    def merged(self, piece: bytes) -> list[int]:
        """The ids of one pre-token."""
        ranks = self.ranks
        if piece in ranks:
            return [ranks[piece]]
        size, shift, low = len(piece), self.shift, (1 << self.shift) - 1
        if size <= SHORT:
            return self._short(piece)
        rank_of, buckets, words, top = ranks.get, self.buckets, self.words, 0
        after = list(range(1, size + 1))
        before = list(range(-1, size))
        pair = self._pairs(piece)
        ids = self._singles(piece)
        for i, rank in enumerate(pair):
            if rank >= 0:
                if bucket := buckets[rank]:
                    bucket.append(i)  # ascending, so a heap
                    continue
                bucket.append(i)
                word = rank >> shift
                words[word] |= 1 << (rank & low)
                top |= 1 << word
        while top:
            # The lowest bit of the lowest word is the lowest rank.
            word = (top & -top).bit_length() - 1
            bits = words[word]
            first = bits & -bits
            rank = (word << shift) + first.bit_length() - 1
            bucket = buckets[rank]
            i = heappop(bucket)
            if not bucket:
                words[word] = bits = bits ^ first
                if not bits:
                    top ^= 1 << word
            if pair[i] != rank:
                continue
            gone = after[i]
            ids[i], ids[gone] = rank, -1
            middle = after[i] = after[gone]
            pair[gone] = pair[i] = -1
            if middle < size:
                before[middle] = i
                rank = rank_of(piece[i : after[middle]], -1)
                if rank >= 0:
                    pair[i] = rank
                    bucket = buckets[rank]
                    if not bucket:
                        word = rank >> shift
                        words[word] |= 1 << (rank & low)
                        top |= 1 << word
                    heappush(bucket, i)
            left = before[i]
            if left >= 0:
                pair[left] = rank = rank_of(piece[left:middle], -1)
                if rank >= 0:
                    bucket = buckets[rank]
                    if not bucket:
                        word = rank >> shift
                        words[word] |= 1 << (rank & low)
                        top |= 1 << word
                    heappush(bucket, left)
        return [number for number in ids if number >= 0]

    def _short(self, piece: bytes) -> list[int]:
        """The same where a bucket is a bitmap of positions."""
        size, shift, low = len(piece), self.shift, (1 << self.shift) - 1
        rank_of, masks, words, top = self.ranks.get, self.masks, self.words, 0
        after = [*range(1, size + 1)]
        before = [*range(-1, size)]
        pair = self._pairs(piece)
        ids = self._singles(piece)
        place = 1
        for rank in pair:
            if rank >= 0:
                if not masks[rank]:
                    word = rank >> shift
                    words[word] |= 1 << (rank & low)
                    top |= 1 << word
                masks[rank] |= place
            place <<= 1
        while top:
            word = (top & -top).bit_length() - 1
            bits = words[word]
            rank = (word << shift) + (bits & -bits).bit_length() - 1
            mask = masks[rank]
            masks[rank] = rest = mask & (mask - 1)
            i = (mask ^ rest).bit_length() - 1
            if not rest:
                words[word] = bits = bits & (bits - 1)
                if not bits:
                    top &= top - 1
            if pair[i] != rank:
                continue
            gone = after[i]
            ids[i], ids[gone] = rank, -1
            middle = after[i] = after[gone]
            pair[gone] = pair[i] = -1
            if middle < size:
                before[middle] = i
                pair[i] = rank = rank_of(piece[i : after[middle]], -1)
                if rank >= 0:
                    if not masks[rank]:
                        word = rank >> shift
                        words[word] |= 1 << (rank & low)
                        top |= 1 << word
                    masks[rank] |= 1 << i
            left = before[i]
            if left >= 0:
                pair[left] = rank = rank_of(piece[left:middle], -1)
                if rank >= 0:
                    if not masks[rank]:
                        word = rank >> shift
                        words[word] |= 1 << (rank & low)
                        top |= 1 << word
                    masks[rank] |= 1 << left
        return [number for number in ids if number >= 0]

    def _pairs(self, piece: bytes) -> list[int]:
        """What rank the pair that starts at each byte has; -1: none, or no start any more."""
        two = self.two
        pair = [two[a][b] for a, b in zip(piece, piece[1:])]
        pair.append(-1)
        return pair

    def _singles(self, piece: bytes) -> list[int]:
        """The id of each byte. That of merged ones stands where they start, -1 elsewhere."""
        single = self.single
        ids = [single[b] for b in piece]
        if -1 in ids:
            raise KeyError(f"no rank for a byte of {piece[:40]!r}")
        return ids

    def packed(self, text: str) -> bytes:
        """The ids of a text, each as 32 bits."""
        if len(text) > LISTED_TEXT:
            pieces = (match.group() for match in self.pattern.finditer(text))
        else:
            pieces = self.pattern.findall(text)
        return b"".join(map(self.kept.__getitem__, pieces))

    def ids(self, text: str) -> list[int]:
        return np.frombuffer(self.packed(text), np.int32).tolist()


class _Kept(dict):
    """Packed ids by pre-token. Bounded, as the pre-tokens of a corpus are not: a full half is put
    aside, and what is met again moves out of it before the next half goes."""

    def __init__(self, encoder: Encoder):
        super().__init__()
        self.encoder, self.aside = encoder, {}

    def __missing__(self, piece: str) -> bytes:
        ids = self.aside.get(piece)
        if ids is None:
            ids = array("i", self.encoder.merged(piece.encode())).tobytes()
            if len(piece) > KEPT_LENGTH:
                return ids
        if len(self) >= KEPT_PIECES:
            self.aside = dict(self)
            self.clear()
        self[piece] = ids
        return ids


def _encoded(texts: pa.Array, packed: Callable[[str], bytes]) -> pa.ListArray:
    """The ids of texts, from one buffer for all of them."""
    parts = [packed(value.as_py() or "") for value in texts]
    ends = np.cumsum([0, *(len(part) >> 2 for part in parts)])
    ids = pa.Array.from_buffers(pa.int32(), int(ends[-1]), [None, pa.py_buffer(b"".join(parts))])
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), ids)


def bpe_encode(text: Column, ranks: dict[bytes, int], pattern: str) -> Column:
    """The ids of a text column, ``array<int>``; null texts give an empty array."""

    def make():
        packed = Encoder(ranks, pattern).packed
        return lambda texts: _encoded(texts, packed)

    # Not deterministic for the optimizer only: else each use of the ids encodes anew.
    return task_udf(make, "array<int>").asNondeterministic()(text)


def bpe_round_trip(text: Column, ranks: dict[bytes, int], pattern: str) -> Column:
    """struct<ids: array<int>, decoded: binary> of a text column: the ids, and the bytes
    that they decode to, by one Python worker in place of two."""

    def make():
        packed = Encoder(ranks, pattern).packed
        tokens = _tokens(ranks)

        def both(texts: pa.Array) -> pa.Array:
            ids = _encoded(texts, packed)
            return pa.StructArray.from_arrays([ids, _decoded(ids, tokens)], ["ids", "decoded"])

        return both

    kind = "ids array<int>, decoded binary"
    return task_udf(make, kind).asNondeterministic()(text)


def _tokens(ranks: dict[bytes, int]) -> pa.Array:
    """The token of each id up to the largest one; null where an id has none."""
    tokens: list[bytes | None] = [None] * (max(ranks.values(), default=-1) + 1)
    for token, number in ranks.items():
        tokens[number] = token
    return pa.array(tokens, pa.large_binary())


def _decoded(ids: pa.ListArray, tokens: pa.Array) -> pa.Array:
    """The bytes of rows of ids: the tokens of all ids are gathered end to end, and the rows
    are the stretches between the tokens at their ends. Null rows stay null."""
    flat = ids.values
    if flat.null_count or len(flat) and pc.min(flat).as_py() < 0:
        raise ValueError("an id is null or in no rank")
    taken = tokens.take(flat)
    if taken.null_count:
        raise ValueError("an id is in no rank")
    _, starts, joined = taken.buffers()
    if not len(flat):
        places, joined = np.zeros(1, np.int64), pa.py_buffer(b"")
    else:
        places = np.frombuffer(starts, np.int64)[: len(flat) + 1]
    rows = np.frombuffer(ids.buffers()[1], np.int32)[ids.offset : ids.offset + len(ids) + 1]
    ends = pa.py_buffer(places[rows])
    whole = pa.Array.from_buffers(pa.large_binary(), len(ids), [None, ends, joined])
    if ids.null_count:
        whole = pc.if_else(ids.is_valid(), whole, pa.scalar(None, pa.large_binary()))
    return whole.cast(pa.binary())


def bpe_decode(ids: Column, ranks: dict[bytes, int]) -> Column:
    """The bytes of an ``array<int>`` column of ids.

    Null rows stay null. An id that is null or in no rank is an error, never dropped.
    """
    tokens = _tokens(ranks)
    return task_udf(lambda: lambda rows: _decoded(rows, tokens), "binary")(ids)
