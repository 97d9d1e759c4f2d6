"""Quality of documents by support vectors over naive Bayes features.

A document is the set of its n-grams: of characters, of kinds of characters, and of words
that only say whether they repeat, each hashed to a bucket. An indicator is scaled by its
log-count ratio, log((p / |p|) / (q / |q|)), with p and q the numbers of good and bad
labelled documents that have it. A linear hinge-loss model is fitted to the scaled
indicators by dual coordinate descent.

The counts cover all labelled rows. The linear model is fitted on at most ``SHARDS`` times
``SHARD_ROWS`` of them, chosen by a hash of the text, in as many tasks, whose weights are
averaged. Scoring needs one pass over the texts and no shuffle.

Defined cases: a null text counts as empty and still has a score. Labels that are null are
none; of several labels of one id the largest counts. Without labels of both classes every
score is 0.5. Texts are read whole, in overlapping parts if they are long. Repeated rows count,
and are scored, each by itself, but copies of a text are chosen for the fit together. An empty
table gives an empty one. Scores are column expressions, so other columns cannot clash.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from maskwright.llm.batches import small_batches, task_udf
from maskwright.llm.linear_svm import fit_sigmoid, fit_svm, sigmoid
from maskwright.llm.tables import column

BUCKETS = 1 << 16
#: Most shards, and most rows of a shard, that the linear model is fitted on.
SHARDS, SHARD_ROWS = 8, 4000
#: Labels that are broadcast, at most (16 bytes each); more are joined by a shuffle.
BROADCAST_LABELS = 2_000_000
#: Characters that are worked on at once.
PART = 1 << 20

_PRIMES = (0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D, 0x27D4EB2F, 0x165667B1, 0xD3A2646D)


def _kinds() -> np.ndarray:
    """For every code point its kind: lower, upper, digit, space, line end, or itself."""
    kinds = np.full(0x110000, 5, np.uint32)
    text = [chr(i) for i in range(0x3000) if not 0xD800 <= i < 0xE000]
    for i, c in enumerate(text):
        if c == "\n":
            kinds[i] = 4
        elif c.isspace():
            kinds[i] = 3
        elif c.isdigit():
            kinds[i] = 2
        elif c.isupper():
            kinds[i] = 1
        elif c.isalpha():
            kinds[i] = 0
        elif i < 128:
            kinds[i] = 6 + i
    return kinds


_KINDS = _kinds()


def _grams(codes: np.ndarray, lengths: range, seed: int) -> Iterator[np.ndarray]:
    hashes = np.full(len(codes), seed, np.uint32)
    for n in range(1, lengths.stop):
        if len(codes) < n:
            return
        hashes = (hashes[: len(codes) - n + 1] ^ codes[n - 1 :]) * np.uint32(_PRIMES[n - 1])
        hashes ^= hashes >> np.uint32(15)
        if n in lengths:
            yield hashes >> np.uint32(16)


def _share_grams(counts: np.ndarray, total: int, seed: int) -> np.ndarray:
    """For each kind of token one bucket that says how large its share is, in halvings."""
    share = np.maximum(counts, 0) / max(total, 1)
    step = np.where(counts > 0, np.ceil(-2 * np.log2(np.maximum(share, 1e-6))), 99)
    kind = np.arange(len(counts), dtype=np.uint32) * np.uint32(131)
    hashes = (kind + step.astype(np.uint32) + np.uint32(seed)) * np.uint32(_PRIMES[0])
    hashes ^= hashes >> np.uint32(15)
    return (hashes * np.uint32(_PRIMES[1])) >> np.uint32(16)


def features(text: str | None) -> np.ndarray:
    """The buckets of a text's n-grams, ascending and distinct."""
    text = text or ""
    present = np.zeros(BUCKETS, bool)
    kind_counts = np.zeros(134, np.int64)
    for start in range(0, max(len(text), 1), PART):
        # Parts overlap, so that no n-gram is lost between them.
        codes = np.frombuffer(text[start : start + PART + 5].encode("utf-32-le"), np.uint32)
        kinds = _KINDS[codes]
        kind_counts += np.bincount(kinds[:PART], minlength=134)
        for hashes in _grams(codes, range(1, 4), 1):
            present[hashes] = True
        for hashes in _grams(kinds, range(2, 7), 2):
            present[hashes] = True
    words = text.split()
    lines = text.split("\n")
    repeats = np.array(
        [
            sum(map(str.__eq__, words, words[1:])),
            sum(map(str.__eq__, words, words[2:])),
            len(lines) - len(set(lines)),
            len(words) - len(set(words)),
        ]
    )
    present[_share_grams(kind_counts, len(text), 3)] = True
    present[_share_grams(repeats[[0, 1, 3]], len(words), 4)] = True
    present[_share_grams(repeats[[2]], len(lines), 5)] = True
    return np.flatnonzero(present)


def labelled(
    docs: DataFrame,
    labels: DataFrame,
    held_out: Column,
    *,
    label_col: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    labels_id: str = "doc_id",
) -> DataFrame:
    """(text, label, draw) of all labelled documents that are not held out; the last is a hash of id
    and text to choose rows by."""
    named = labels.select(
        column(labels, labels_id).alias("id"), column(labels, label_col).cast("int").alias("label")
    ).filter("id IS NOT NULL AND label IS NOT NULL")
    named = named.groupBy("id").agg(F.max("label").alias("label"))
    if named.count() <= BROADCAST_LABELS:
        named = F.broadcast(named)
    texts = docs.filter(~held_out).select(
        column(docs, id_col).alias("id"), F.coalesce(column(docs, text_col), F.lit("")).alias("text")
    )
    return texts.join(named, "id").select("text", "label", F.xxhash64("id", "text").alias("draw"))


@dataclass(frozen=True)
class Model:
    """Ratios that scale the indicators, weights of the scaled ones (bias last), sigmoid."""

    ratios: np.ndarray
    weights: np.ndarray
    a: float
    b: float

    def margin(self, text: str | None) -> float:
        index, values = _scaled(features(text), self.ratios)
        return float(self.weights[index] @ values + self.weights[-1])

    def score(self, text: str | None) -> float:
        return float(sigmoid(self.a * self.margin(text) + self.b))


def train_quality(examples: DataFrame) -> Model:
    """A model from (text, label) rows."""
    examples = examples.select("text", "label")

    def count(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts, rows = np.zeros((2, BUCKETS), np.int64), np.zeros(2, np.int64)
        for part in parts:
            for text, label in zip(part["text"], part["label"]):
                counts[int(label > 0), features(text)] += 1
                rows[int(label > 0)] += 1
        at = np.flatnonzero(counts.any(axis=0))
        yield pd.DataFrame({"bucket": at, "bad": counts[0, at], "good": counts[1, at]})
        yield pd.DataFrame({"bucket": [-1], "bad": rows[:1], "good": rows[1:]})

    small_batches()
    counted = examples.mapInPandas(count, "bucket bigint, bad bigint, good bigint")
    found = counted.groupBy("bucket").agg(F.sum("bad").alias("bad"), F.sum("good").alias("good"))
    table = found.toPandas()  # one row for each bucket at most
    rows = table[table["bucket"] < 0]
    bad_rows, good_rows = (int(rows[c].sum()) for c in ("bad", "good"))
    if not bad_rows or not good_rows:
        return Model(np.zeros(BUCKETS), np.zeros(BUCKETS + 1), 1.0, 0.0)
    counts = np.ones((2, BUCKETS))
    seen = table[table["bucket"] >= 0]
    counts[:, seen["bucket"].to_numpy()] += seen[["bad", "good"]].to_numpy().T
    ratios = np.log(counts[1] / counts[1].sum()) - np.log(counts[0] / counts[0].sum())

    total = bad_rows + good_rows
    shards = min(SHARDS, -(-total // SHARD_ROWS))
    spread = F.pmod(F.xxhash64("text", F.lit(11)), F.lit(1 << 30)) / float(1 << 30)
    # About three quarters of the bound, so that chance never makes a shard too large.
    share = min(1.0, 0.75 * SHARDS * SHARD_ROWS / total)
    chosen = examples.filter(spread < share).withColumn(
        "shard", F.pmod(F.xxhash64("text", F.lit(12)), F.lit(shards))
    )

    def fit(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values(["label", "text"]).sample(frac=1.0, random_state=5)
        rows = [_scaled(features(text), ratios) for text in part["text"]]
        positive = (part["label"].to_numpy() > 0).astype(float)
        weights = fit_svm(rows, 2 * positive - 1, BUCKETS)
        margins = np.array([weights[i] @ v + weights[-1] for i, v in rows])
        a, b = fit_sigmoid(margins, positive)
        return pd.DataFrame({"weights": [np.append(weights, [a, b]).tolist()], "n": [len(part)]})

    fitted = chosen.groupBy("shard").applyInPandas(fit, "weights array<double>, n bigint").toPandas()
    fitted = fitted.sort_values("n", ignore_index=True)
    model = np.average(np.stack(fitted["weights"].to_numpy()), axis=0, weights=fitted["n"])
    return Model(ratios, model[:-2], float(model[-2]), float(model[-1]))


def _scaled(index: np.ndarray, ratios: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    values = ratios[index]
    return index, values / max(np.sqrt(values @ values), 1e-9)


def quality_score(text: Column, model: Model) -> Column:
    """The likelihood, 0 to 1, that a text is labelled as good."""

    def score(texts: pa.Array) -> pa.Array:
        return pa.array([model.score(text.as_py()) for text in texts], pa.float64())

    return task_udf(lambda: score, "double")(text)
