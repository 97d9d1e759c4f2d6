"""Language of texts: the family first, then one-versus-one support vectors within it.

A text is the vector of its letter n-grams (square roots of counts, at length one). Linear
machines between each two families vote for a family; machines between each two languages
of that family vote for the language. Close relatives are thus told apart by machines that
have seen only them. The machines are fitted on at most ``SAMPLE`` labelled rows of each
language, chosen by a hash of the text, each machine in a task of its own. Prediction is
one pass over the texts without a shuffle.

Defined cases: a text that is null or has no letter is ``und`` with the score 0. Null labels
are none. With one language only, that one is predicted; with none, ``und``. Equal votes go to
the larger sum of likelihoods, then to the first name. Texts are read whole. Repeated rows are
predicted each by itself, but copies of a text are chosen for the fit together. An empty table
gives an empty one. Predictions are column expressions, so other columns cannot clash.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from maskwright.llm.batches import small_batches, task_udf
from maskwright.llm.linear_svm import fit_sigmoid, fit_svm, sigmoid

#: Labelled rows of a language that the machines are fitted on, at most.
SAMPLE = 1500
BUCKETS = 1 << 15
PART = 1 << 20
UNKNOWN = "und"
#: Families by language. A language that isn't here is a family of its own.
FAMILIES = {
    "de": "germanic", "en": "germanic", "nl": "germanic", "sv": "germanic", "da": "germanic",
    "no": "germanic", "es": "romance", "fr": "romance", "it": "romance", "pt": "romance",
    "ro": "romance", "ca": "romance", "cs": "slavic", "pl": "slavic", "ru": "slavic",
    "sk": "slavic", "uk": "slavic", "bg": "slavic",
}


def _letters() -> np.ndarray:
    """Each letter as itself, everything else as a space."""
    table = np.full(0x110000, 32, np.uint32)
    for i in range(0x110000):
        if not 0xD800 <= i < 0xE000 and chr(i).isalpha():
            table[i] = i
    return table


_LETTERS = _letters()
_PRIMES = tuple(np.uint32(p) for p in (0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D))


def features(text: str | None) -> tuple[np.ndarray, np.ndarray] | None:
    """Buckets and values of a text's letter n-grams; nothing if it has no letter."""
    counts = np.zeros(BUCKETS, np.int64)
    lower, lettered = f" {(text or '').lower()} ", False
    for start in range(0, len(lower), PART):
        codes = np.frombuffer(lower[start : start + PART + 2].encode("utf-32-le"), np.uint32)
        letters = _LETTERS[codes]
        lettered = lettered or bool((letters != 32).any())
        # Runs of other characters are one space.
        letters = letters[np.append(True, (letters[1:] != 32) | (letters[:-1] != 32))]
        hashes, every = np.full(len(letters), 17, np.uint32), []
        for n, prime in enumerate(_PRIMES):
            if len(letters) <= n:
                break
            hashes = (hashes[: len(letters) - n] ^ letters[n:]) * prime
            hashes ^= hashes >> np.uint32(15)
            every.append(hashes >> np.uint32(17))
        counts += np.bincount(np.concatenate(every), minlength=BUCKETS)
    if not lettered:
        return None
    at = np.flatnonzero(counts)
    values = np.sqrt(counts[at])
    return at, values / np.sqrt(values @ values)


@dataclass(frozen=True)
class Model:
    """For each pair of names the weights and the sigmoid of the machine between them."""

    families: dict[str, list[str]]
    machines: dict[tuple[str, str], tuple[np.ndarray, float, float]]

    def _vote(self, names: list[str], at: np.ndarray, values: np.ndarray) -> tuple[str, float]:
        votes = {name: [0.0, 0.0, 1.0] for name in names}
        for pair in combinations(names, 2):
            weights, a, b = self.machines[pair]
            likely = float(sigmoid(a * (weights[at] @ values + weights[-1]) + b))
            for name, p in zip(pair, (likely, 1 - likely)):
                votes[name][0] += p > 0.5
                votes[name][1] += p
                votes[name][2] = min(votes[name][2], p)
        best = max(names, key=lambda name: votes[name][:2])
        return best, votes[best][2]

    def predict(self, text: str | None) -> tuple[str, float]:
        found = features(text) if self.families else None
        if found is None:
            return UNKNOWN, 0.0
        family, sure = self._vote(sorted(self.families), *found)
        lang, surely = self._vote(self.families[family], *found)
        return lang, sure * surely


def train_language(examples: DataFrame, families: Mapping[str, str] = FAMILIES) -> Model:
    """A model from rows (text, lang)."""
    examples = examples.filter("lang IS NOT NULL AND text IS NOT NULL")
    totals = {row["lang"]: row["count"] for row in examples.groupBy("lang").count().collect()}
    members: dict[str, list[str]] = {}
    for lang in sorted(totals):
        members.setdefault(f"family {families.get(lang, lang)}", []).append(lang)
    pairs = list(combinations(sorted(members), 2))
    pairs += [pair for langs in members.values() for pair in combinations(langs, 2)]
    if not pairs:
        return Model(members, {})
    of = {lang: family for family, langs in members.items() for lang in langs}
    share = F.lit(0.0)
    for lang, total in totals.items():
        share = F.when(F.col("lang") == lang, min(1.0, 0.9 * SAMPLE / total)).otherwise(share)
    spread = F.pmod(F.xxhash64("text", F.lit(31)), F.lit(1 << 30)) / float(1 << 30)
    # The machines that learn from a language, by number.
    learns = F.array().cast("array<int>")
    for lang in totals:
        mine = [i for i, pair in enumerate(pairs) if lang in pair or of[lang] in pair]
        these = F.array(*map(F.lit, mine)).cast("array<int>")
        learns = F.when(F.col("lang") == lang, these).otherwise(learns)
    small_batches()
    sample = examples.filter(spread < share).select(
        "lang",
        F.xxhash64("text").alias("order"),
        _vectors(F.col("text")).alias("vector"),
        learns.alias("machines"),
    )
    rows = sample.filter("vector IS NOT NULL").select(
        "lang", "order", "vector.*", F.explode("machines").alias("machine")
    )

    def fit(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
        first, _ = pairs[key[0]]
        part = part.sort_values("order", ignore_index=True)
        vectors = [(at.astype(np.int64), values) for at, values in zip(part["at"], part["values"])]
        positive = np.array([float(lang == first or of[lang] == first) for lang in part["lang"]])
        weights = fit_svm(vectors, 2 * positive - 1, BUCKETS, cost=10.0)
        margins = np.array([weights[a] @ v + weights[-1] for a, v in vectors])
        a, b = fit_sigmoid(margins, positive)
        return pd.DataFrame({"machine": [key[0]], "weights": [weights.tolist()], "a": [a], "b": [b]})

    fitted = rows.groupBy("machine").applyInPandas(
        fit, "machine int, weights array<double>, a double, b double"
    )
    machines = {
        pairs[row["machine"]]: (np.array(row["weights"]), row["a"], row["b"])
        for row in fitted.collect()  # a row for each machine
    }
    never = (np.zeros(BUCKETS + 1), 1.0, 0.0)
    return Model(members, {pair: machines.get(pair, never) for pair in pairs})


def _vectors(text: Column) -> Column:
    def vectors(texts: pa.Array) -> pa.Array:
        found = [features(text.as_py()) for text in texts]
        rows = [None if f is None else {"at": f[0], "values": f[1]} for f in found]
        kind = pa.struct([("at", pa.list_(pa.int32())), ("values", pa.list_(pa.float64()))])
        return pa.array(rows, kind)

    return task_udf(lambda: vectors, "at array<int>, values array<double>")(text)


def predict_language(text: Column, model: Model) -> Column:
    """struct<lang: string, score: double> for each text."""

    def predict(texts: pa.Array) -> pa.Array:
        found = [model.predict(text.as_py()) for text in texts]
        return pa.StructArray.from_arrays(
            [
                pa.array([lang for lang, _ in found], pa.string()),
                pa.array([score for _, score in found], pa.float64()),
            ],
            ["lang", "score"],
        )

    return task_udf(lambda: predict, "lang string, score double")(text)
