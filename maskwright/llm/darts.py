"""DartMinHash: sparse weighted signatures for banded joining.

Darts fall on the plane of weight and rank, one for each unit of area in the mean, and the
darts of an element depend on that element alone. A weighted element owns the region below
its weight. Each dart has a coordinate of the signature; the lowest rank in a coordinate
wins. Two sets share the winner of a coordinate with the probability of their weighted
Jaccard similarity. Ranks are visited in cells, each twice as long as all before it, until
every coordinate of a set is filled, so the work does not grow with elements times
coordinates.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column

from maskwright.llm.batches import task_udf
from maskwright.llm.shingles import GOLDEN, WORDS, blocks, mixed

#: Coordinates: 32 bands of 5. Of two sets with similarity 0.8, all bands differ in 3 cases
#: of a million.
BANDS, ROWS = 32, 5
FIRST_CELL = 1 / 16
_NONE = np.uint64(0xFFFFFFFFFFFFFFFF)
_HIGH = np.uint64(0xFFFFFFFF00000000)


def _poisson_cdf(mean: float) -> np.ndarray:
    top = int(mean + 12 * math.sqrt(mean) + 24)
    logs = [k * math.log(mean) - mean - math.lgamma(k + 1) for k in range(top)]
    return np.cumsum(np.exp(logs))


def _fraction(x: np.ndarray) -> np.ndarray:
    return (x >> np.uint64(11)).astype(np.float64) * 2.0**-53


def signatures(
    elements: np.ndarray, weights: np.ndarray, owner: np.ndarray, sets: int, size: int
) -> np.ndarray:
    """Signatures of weighted sets, ``sets`` by ``size``. ``owner`` is the set that an element
    belongs to. Sets without elements have only the highest value."""
    layers = np.ceil(weights).astype(np.int64)
    at = np.repeat(np.arange(len(elements)), layers)
    layer = np.arange(len(at)) - np.repeat(np.cumsum(layers) - layers, layers)
    owner, height = owner[at], weights[at] - layer
    keys = mixed(elements[at] + layer.astype(np.uint64) * GOLDEN)
    best = np.full(sets * size, _NONE)
    low, high, cell = 0.0, FIRST_CELL, 1
    while len(keys):
        counts_of = mixed(keys ^ mixed(np.array([cell], np.uint64) * GOLDEN))
        counts = np.searchsorted(_poisson_cdf(high - low), _fraction(counts_of), side="right")
        thrown = np.repeat(np.arange(len(keys)), counts)
        number = np.arange(len(thrown)) - np.repeat(np.cumsum(counts) - counts, counts)
        rank = mixed(counts_of[thrown] + (number + 1).astype(np.uint64) * GOLDEN)
        place = mixed(rank + GOLDEN)
        mark = mixed(place + GOLDEN)
        inside = _fraction(mark) <= height[thrown]
        slot = owner[thrown] * size + (place % np.uint64(size)).astype(np.int64)
        here = np.full(sets * size, _NONE)
        np.minimum.at(here, slot[inside], ((rank & _HIGH) | (mark >> np.uint64(32)))[inside])
        best = np.where(best == _NONE, here, best)
        going = (best.reshape(sets, size) == _NONE).any(axis=1)[owner]
        keys, owner, height = keys[going], owner[going], height[going]
        low, high, cell = high, 2 * high, cell + 1
    return best.reshape(sets, size)


def _sketches(block: list[np.ndarray], bands: int, rows: int, weighted: bool):
    """Numbers of distinct shingles, band keys and one bit for each coordinate."""
    distinct = [np.unique(runs, return_counts=True) for runs in block]
    sizes = np.array([len(runs) for runs, _ in distinct])
    elements = np.concatenate([runs for runs, _ in distinct])
    counts = np.concatenate([counts for _, counts in distinct]).astype(np.float64)
    owner = np.repeat(np.arange(len(block)), sizes)
    weights = counts if weighted else np.ones(len(elements))
    signature = signatures(elements, weights, owner, len(block), bands * rows)
    grouped = signature.reshape(len(block), bands, rows)
    keys = np.broadcast_to(mixed(np.arange(1, bands + 1).astype(np.uint64)), grouped.shape[:2])
    for i in range(rows):
        keys = mixed(keys ^ grouped[:, :, i])
    lengths = -(-bands * rows // 64) * 64
    bits = np.zeros((len(block), lengths), np.uint8)
    bits[:, : bands * rows] = signature & np.uint64(1)
    packed = np.ascontiguousarray(np.packbits(bits, axis=1)).view(np.int64)
    return sizes, keys.view(np.int64), packed


def dart_sketch(
    text: Column,
    *,
    words: int = WORDS,
    bands: int = BANDS,
    rows: int = ROWS,
    weighted: bool = False,
) -> Column:
    """Of a text column, struct<n: int, keys: array<bigint>, bits: array<bigint>>.

    ``n`` counts distinct shingles, ``keys`` are the bucket of each band, ``bits`` one bit
    of each coordinate. ``weighted`` takes how often a shingle occurs as its weight,
    otherwise each has the weight 1. A text without words has no keys.
    """

    def sketch(texts: pa.Array) -> pa.Array:
        values = (value.as_py() for value in texts)
        parts = [_sketches(block, bands, rows, weighted) for block in blocks(values, words)]
        if not parts:
            parts = [(np.empty(0, np.int64), np.empty((0, bands), np.int64), np.empty((0, 1)))]
        sizes = np.concatenate([p[0] for p in parts])
        keys = np.concatenate([p[1] for p in parts])[sizes > 0]
        bits = np.concatenate([p[2] for p in parts])[sizes > 0]

        def listed(values: np.ndarray) -> pa.Array:
            ends = np.concatenate([[0], np.cumsum((sizes > 0) * values.shape[1])])
            return pa.ListArray.from_arrays(
                pa.array(ends, pa.int32()), pa.array(values.ravel().astype(np.int64))
            )

        return pa.StructArray.from_arrays(
            [pa.array(sizes, pa.int32()), listed(keys), listed(bits)], ["n", "keys", "bits"]
        )

    return task_udf(lambda: sketch, "n int, keys array<bigint>, bits array<bigint>")(text)
