"""Toxicity of texts behind leetspeak, spacing and repetition.

A noisy channel hides words: letters become look-alikes, are spaced out or repeated. What
looks hidden becomes a lattice of the letters that may have been meant; Viterbi decoding
under a character language model gives the likeliest readings. Where symbols are spaced out, a
word may end at each gap, and does at a wider one. The words of the text and of these readings
are then scored by the log-odds of words, their beginnings, their endings and the letters
within them; words are never cut.

Decoding is exact. Paths are linked back, so a token of n symbols takes n steps. A path is
only left out if as many better ones as are asked for would stay better whatever follows: two
paths that go on alike differ by at most what the next two letters depend on, since the
model looks back at two.

Marks alone, such as ``@$$``, hide a word if two of them are different look-alikes and one is no
digit; numbers and prices hide none.

The language model counts letter trigrams over all documents. The log-odds are fitted on at
most ``SAMPLE`` labelled rows of each class, chosen by a hash of id and text, so that copies of a
text are chosen each by itself.

Defined cases: a null text counts as empty and still has a score. Texts and words are read
whole, however long. Labels that are null are none; of several labels of one id the largest
counts. Without labels of both classes every score is 0. Repeated rows count, and are scored,
each by itself; an empty table gives an empty one. Scores are column expressions, so other
columns cannot clash.
"""

from __future__ import annotations

import math
import re
from array import array
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from functools import cached_property
from itertools import product, repeat
from statistics import multimode

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from maskwright.llm.batches import small_batches, task_udf
from maskwright.llm.linear_svm import fit_sigmoid, sigmoid

#: What a character may stand for.
LOOKALIKES = {
    "0": "o", "1": "il", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c", "€": "e", "£": "l",
}
SEPARATORS = ".-_*'~·"
#: Labelled rows of a class that the scores are fitted on, at most.
SAMPLE = 20_000
BUCKETS = 1 << 21
#: Standard errors by which log-odds are lowered, so that rare words prove little.
CAUTION = 2.0
READINGS = 3
#: Of a spaced run, where the places of the breaks multiply the readings.
SPACED_READINGS = 24
#: Tokens kept with their evidence by a task, and the longest that is kept.
KEPT_WORDS, KEPT_LENGTH = 300_000, 64
SYMBOLS = 64
#: Letters of beginnings and endings that are scored; the longest words that are scored by these
#: and as a whole only, and the letters of the pieces within longer ones.
EDGES, WHOLE, PIECE = range(4, 7), 9, 5

_EDGE = frozenset(".,;:!?\"')]")
_WORD = re.compile(r"\w")
_OPEN = "([{<\"'"
_LETTERS = re.compile(r"[^\W\d_]+")
_LETTER = re.compile(r"[^\W\d_]")
_REPEAT = re.compile(r"([^\W\d_])\1\1")
_HIDING = re.compile("[" + re.escape("".join(LOOKALIKES) + SEPARATORS) + "]")
_MARKS = re.compile("[" + re.escape("".join(LOOKALIKES) + SEPARATORS) + "]{3,}")
_NUMBER = re.compile(r"[$€£+|-]?\d[\d.-]*[$€£+|]?")
_PAIR = re.compile(r"(?<!\S)\S\s+\S(?!\S)")
_TOKEN = re.compile(r"(\s*)(\S+)")
#: A run of one character, spaced out or not, or a gap between two.
_RUN = re.compile(r"(\S)(?: ?\1)*| ")


def _symbols() -> np.ndarray:
    """A symbol for each code point: 0 is no letter, a to z are 1 to 26, others share the rest."""
    table = np.zeros(0x110000, np.int32)
    for i in range(0x3000):
        c = chr(i)
        if "a" <= c <= "z":
            table[i] = i - 96
        elif c.isalpha():
            table[i] = 27 + i % 37
    table[0x3000:0xD800] = 27 + np.arange(0x3000, 0xD800) % 37
    return table


_TABLE = _symbols()


def letter_trigrams(texts: DataFrame) -> np.ndarray:
    """How often each three symbols follow each other in all rows of one text column."""

    def count(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(SYMBOLS**3, np.int64)
        for part in parts:
            for value in part.column(0):
                text = value.as_py()
                if text:
                    codes = np.frombuffer(f" {text.lower()} ".encode("utf-32-le"), np.uint32)
                    s = _TABLE[codes]
                    three = (s[:-2] << 12) | (s[1:-1] << 6) | s[2:]
                    if len(three) > len(counts) // 8:
                        counts += np.bincount(three, minlength=len(counts))
                    else:
                        np.add.at(counts, three, 1)
        at = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(counts[at])], ["three", "n"])

    small_batches()
    counted = texts.mapInArrow(count, "three bigint, n bigint")
    found = counted.groupBy("three").agg(F.sum("n").alias("n")).toPandas()
    counts = np.zeros(SYMBOLS**3)
    counts[found["three"].to_numpy()] = found["n"].to_numpy()
    return counts.reshape(SYMBOLS, SYMBOLS, SYMBOLS)


@dataclass
class Decoder:
    """Likeliest readings of hidden words, by trigram counts."""

    counts: np.ndarray

    @cached_property
    def logs(self) -> list:
        """Log-probability of a symbol after two others, with shorter histories mixed in."""
        three = self.counts
        two, one = three.sum(axis=0), three.sum(axis=(0, 1))
        p1 = (one + 1) / (one + 1).sum()
        p2 = (two + 20 * p1) / (two + 20 * p1).sum(axis=1, keepdims=True)
        p3 = (three + 20 * p2[None]) / (three + 20 * p2[None]).sum(axis=2, keepdims=True)
        return np.log(p3).tolist()

    @cached_property
    def slack(self) -> float:
        """How far one path can fall behind another one by what both go on with."""
        logs = np.array(self.logs)
        return 2 * float((logs.max(axis=(0, 1)) - logs.min(axis=(0, 1))).max())

    def readings(self, hidden: str) -> list[str]:
        """The likeliest restored forms of a token, best first."""
        logs = self.logs
        most = SPACED_READINGS if " " in hidden else READINGS
        # For each state, the last two symbols, its best paths: (score, hash of the text, the path
        # as its last letters and the path before them). No two have the same text.
        paths: dict[tuple[int, int], list[tuple]] = {(0, 0): [(0.0, 0, None)]}
        for meant in _lattice(hidden):
            grown: dict[tuple[int, int], dict[int, tuple]] = {}
            for (a, b), best in paths.items():
                for letters, cost in meant:
                    x, y, gain = a, b, cost
                    for letter in letters:
                        c = int(_TABLE[ord(letter)])
                        gain += logs[x][y][c]
                        x, y = y, c
                    here = grown.setdefault((x, y), {})
                    for score, digest, path in best:
                        for letter in letters:
                            digest = (digest * 1_000_003 + ord(letter)) & _DIGEST
                        known = here.get(digest)
                        if known is None or known[0] < score + gain:
                            here[digest] = (score + gain, digest, (letters, path) if letters else path)
            paths = {state: _best(found.values(), most) for state, found in grown.items()}
            if len(paths) > 4:
                scores = sorted((p[0] for found in paths.values() for p in found), reverse=True)
                least = scores[min(most, len(scores)) - 1] - self.slack
                paths = {state: found for state, found in paths.items() if found[0][0] >= least}
        ends = [
            (score + logs[a][b][0], digest, path)
            for (a, b), found in paths.items()
            for score, digest, path in found
        ]
        return [text for text in map(_text_of, _best(ends, most)) if text]


_DIGEST = (1 << 64) - 1


def _best(paths: Iterable[tuple], most: int) -> list[tuple]:
    return sorted(paths, key=lambda path: (-path[0], path[1]))[:most]


def _text_of(path: tuple) -> str:
    parts, link = [], path[2]
    while link:
        parts.append(link[0])
        link = link[1]
    return "".join(reversed(parts))


def _lattice(hidden: str) -> Iterator[list[tuple[str, float]]]:
    """For each run of one character, what it may stand for and at what cost.

    A word may end at each space.
    """
    for part in _RUN.finditer(hidden):
        c, run = part[0][0], part[0].count(part[0][0])
        if c == " ":
            yield [("", 0.0), (" ", 0.0)]
        elif _LETTER.match(c):
            cost = -0.7 if run > 2 else 0.0
            options = [(c, cost), (c + c, cost)] if run > 2 else [(c * run, cost)]
            yield [*options, *((ended, cost) for ended in _ended(c, part[0]))]
        elif c in LOOKALIKES:
            meant = LOOKALIKES[c]
            cost = -0.2 - math.log(len(meant))
            options = [(letter * min(run, 2), cost) for letter in meant]
            options += [(letter, cost - 0.7) for letter in meant if run > 1]
            options += [(ended, cost) for letter in meant for ended in _ended(letter, part[0])]
            # A stray mark is likely at the end only.
            yield [*options, ("", -9.0 if part.end() < len(hidden) else -3.0)]
        else:
            yield [("", -0.5)]


def _ended(letter: str, run: str) -> list[str]:
    """What a spaced run of one letter may stand for if a word ends within it."""
    if " " not in run:
        return []
    most = run.count(run[0])
    return [f"{letter * i} {letter * j}" for i, j in product((1, 2), (1, 2)) if i + j <= most]


def _masked(token: str) -> bool:
    """Whether marks without a letter look like a word."""
    if not _MARKS.fullmatch(token) or _NUMBER.fullmatch(token):
        return False
    marks = set(token) & set(LOOKALIKES)
    return len(marks) > 1 and not all(map(str.isdigit, marks))


def _core(token: str) -> str:
    """A token without marks at its end that are no part of it: punctuation, and any other mark
    three times or more."""
    end = len(token)
    while end:
        mark = token[end - 1]
        if mark in _EDGE:
            end -= 1
            continue
        run = end
        while run and token[run - 1] == mark:
            run -= 1
        if end - run < 3 or _WORD.match(mark):
            break
        end = run
    return token[:end]


def _parts(token: str) -> tuple[list[str], list[str]]:
    """The words of a token in lower case, and what in it looks like a hidden word."""
    if token.isalpha():
        return [token], [token] if _REPEAT.search(token) else []
    whole, token = token, _core(token.lstrip(_OPEN))
    found = _LETTERS.findall(token)
    if found:
        return found, [token] if _HIDING.search(token) or _REPEAT.search(token) else []
    if _NUMBER.fullmatch(token):
        return [], []
    # Repeated marks at the end may be its letters.
    return [], [form for form in (token, whole) if _masked(form)][:1]


def _single_runs(tokens: list[str]) -> list[str]:
    """What runs of three or more tokens of one character spell, if it may be a word."""
    found, run = [], []
    for token in (*tokens, ""):
        if len(token) == 1:
            run.append(token)
            continue
        if len(run) > 2:
            joined = "".join(run)
            if _LETTER.search(joined) or _masked(joined):
                found.append(joined)
        run.clear()
    return found


def hidden_words(text: str) -> tuple[set[str], set[str]]:
    """The words of a text in lower case, and what in it looks like hidden words."""
    tokens = text.lower().split()
    words: set[str] = set()
    hidden = set(_single_runs(tokens))
    for token in set(tokens):
        own, looking = _parts(token)
        words.update(own)
        hidden.update(looking)
    return words, hidden


def spaced_runs(text: str) -> list[str]:
    """The runs of spaced-out symbols, between wider gaps: each with a space at every gap."""
    found: list[str] = []
    if not _PAIR.search(text):
        return found
    run: list[tuple[str, tuple[bool, int], bool]] = []

    def close():
        if len(run) > 2:
            usual = min(multimode(width for _, width, _ in run[1:]))
            parts: list[list[str]] = [[]]
            for symbol, width, ended in run:
                if ended or width > usual:
                    parts.append([])
                if _LETTER.match(symbol) or symbol in LOOKALIKES:
                    parts[-1].append(symbol)
                elif symbol not in SEPARATORS:
                    parts.append([])
            for part in parts:
                joined = "".join(part)
                if len(part) > 1 and (_LETTER.search(joined) or _masked(joined)):
                    found.append(" ".join(part))
        run.clear()

    ended, before = True, ""
    for gap, token in _TOKEN.findall(text.lower()):
        if len(token) > 1 and token[:2].isalnum():
            close()
            before = token
            continue
        if before:
            ended, before = _core(before) != before, ""
        inner = token.lstrip(_OPEN) or token
        core = _core(inner) or inner
        if len(core) == 1:
            run.append((core, ("\n" in gap, len(gap)), ended or inner != token))
        else:
            close()
        ended = core != inner
    close()
    return found


class _Kept(dict):
    """Values by token, bounded."""

    def __init__(self, make):
        super().__init__()
        self.make = make

    def __missing__(self, key):
        value = self.make(key)
        if len(key) > KEPT_LENGTH:
            return value
        if len(self) >= KEPT_WORDS:
            self.clear()
        self[key] = value
        return value


def _buckets(word: str) -> list[int]:
    """The buckets of what is scored of a word: the whole, beginnings, endings, and the pieces of
    a word that is longer than these."""
    size, digest = len(word), xxhash.xxh3_64_intdigest
    forms = [f"^{word}$"]
    for n in EDGES[: max(0, size - EDGES.start + 1)]:
        forms += (f"^{word[:n]}", f"{word[-n:]}$")
    if size > WHOLE:
        forms += [word[i : i + PIECE] for i in range(size - PIECE + 1)]
    return [digest(form) % BUCKETS for form in forms]


@dataclass
class Model:
    """Trigram counts, the buckets that speak for toxicity, and a sigmoid."""

    counts: np.ndarray
    evidence: dict[int, float]
    a: float = 1.0
    b: float = -30.0
    decoder: Decoder = field(init=False, repr=False)

    def __post_init__(self):
        self.decoder = Decoder(self.counts)
        # Words stand in several tokens, with and without marks.
        self.known = _Kept(self.word)
        self.kept = _Kept(self.speaking)
        self.restored = _Kept(self.readings)
        self.numbered = _Kept(self.packed)

    def __getstate__(self):
        return self.counts, self.evidence, self.a, self.b

    def __setstate__(self, state):
        self.counts, self.evidence, self.a, self.b = state
        self.__post_init__()

    def readings(self, token: str) -> list[str]:
        return [word for text in self.decoder.readings(token) for word in _LETTERS.findall(text)]

    def word(self, word: str) -> float:
        """The strongest evidence of a word."""
        return max(map(self.evidence.get, _buckets(word), repeat(0.0)))

    def words_of(self, token: str) -> list[str]:
        """The words of a token and of the readings of what is hidden in it."""
        words, hidden = _parts(token)
        return [*words, *(word for form in hidden for word in self.restored[form])]

    def speaking(self, token: str) -> tuple[tuple[str, float], ...]:
        """Those of its words that speak for toxicity, and how strongly."""
        if token.isalpha() and not _REPEAT.search(token):
            strength = self.known[token]
            return ((token, strength),) if strength else ()
        found = ((word, self.known[word]) for word in self.words_of(token))
        return tuple((word, strength) for word, strength in found if strength > 0)

    def words_of_runs(self, text: str, tokens: list[str]) -> list[str]:
        """The words that runs of spaced-out symbols spell."""
        if not _PAIR.search(text):
            return []
        runs = {*_single_runs(tokens), *spaced_runs(text)}
        return [word for run in runs for word in self.restored[run]]

    def packed(self, token: str) -> bytes:
        """The buckets of its words, as 32 bits each."""
        return array("i", [b for word in self.words_of(token) for b in _buckets(word)]).tobytes()

    def words(self, text: str | None) -> set[str]:
        """The words of a text and of the readings of what is hidden in it."""
        lower = (text or "").lower()
        tokens = lower.split()
        found = set(self.words_of_runs(lower, tokens))
        for token in set(tokens):
            found.update(self.words_of(token))
        return found

    def buckets(self, text: str | None) -> np.ndarray:
        """The buckets of all of these words, ascending and distinct."""
        lower = (text or "").lower()
        tokens = lower.split()
        parts = [*map(self.numbered.__getitem__, set(tokens))]
        parts += [array("i", _buckets(w)).tobytes() for w in self.words_of_runs(lower, tokens)]
        return np.unique(np.frombuffer(b"".join(parts), np.int32))

    def strength(self, text: str | None) -> float:
        """The evidence of the strongest word, and a little of the next two."""
        lower = (text or "").lower()
        tokens = lower.split()
        found: dict[str, float] = {}
        for speaking in map(self.kept.__getitem__, set(tokens)):
            if speaking:
                found.update(speaking)
        for word in self.words_of_runs(lower, tokens):
            found[word] = self.word(word)
        best = sorted(found.values())[-3:]
        return sum(best[-1:]) + 0.25 * sum(best[:-1])

    def score(self, text: str | None) -> float:
        return float(sigmoid(self.a * self.strength(text) + self.b))


def restore(text: str, decoder: Decoder) -> str:
    """A text in which the hidden words of each line are replaced by their likeliest reading."""

    def line(value: str) -> str:
        hidden = hidden_words(value)[1].union(spaced_runs(value))
        out, run = [], []

        def close():
            spaced = " ".join(run).lower()
            out.extend(decoder.readings(spaced)[:1] if spaced in hidden else run)
            run.clear()

        for token in value.split(" "):
            if len(token) == 1:
                run.append(token)
                continue
            close()
            inner = token.lstrip(_OPEN)
            core = _core(inner)
            best = decoder.readings(core.lower())[:1] if core.lower() in hidden else []
            before = token[: len(token) - len(inner)]
            out.append(before + best[0] + inner[len(core) :] if best else token)
        close()
        return " ".join(out)

    return "\n".join(map(line, text.split("\n")))


def train_toxicity(examples: DataFrame, counts: np.ndarray) -> Model:
    """A model from labelled rows (text, label, draw) and the trigram counts of a corpus."""
    blank = Model(counts, {})
    totals = {r["label"] > 0: r["count"] for r in examples.groupBy("label").count().collect()}
    if len(totals) < 2:
        return blank
    spread = F.pmod(F.xxhash64("draw", F.lit(21)), F.lit(1 << 30)) / float(1 << 30)
    share = F.lit(min(1.0, 0.9 * SAMPLE / totals[False]))
    share = F.when(F.col("label") > 0, min(1.0, 0.9 * SAMPLE / totals[True])).otherwise(share)
    sample = examples.filter(spread < share).repartition(4)

    def count(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        found, rows = np.zeros((2, BUCKETS), np.int64), np.zeros(2, np.int64)
        for part in parts:
            for text, label in zip(part["text"], part["label"]):
                found[int(label > 0), blank.buckets(text)] += 1
                rows[int(label > 0)] += 1
        at = np.flatnonzero(found.any(axis=0))
        yield pd.DataFrame({"bucket": at, "clean": found[0, at], "toxic": found[1, at]})
        yield pd.DataFrame({"bucket": [-1], "clean": rows[:1], "toxic": rows[1:]})

    counted = sample.mapInPandas(count, "bucket bigint, clean bigint, toxic bigint")
    sums = counted.groupBy("bucket").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    # One row for each bucket at most; what fewer than two toxic texts have proves nothing.
    table = sums.filter("toxic > 1 OR bucket < 0").toPandas()
    all_clean, all_toxic = table.loc[table["bucket"] < 0, ["clean", "toxic"]].to_numpy()[0]
    seen = table[table["bucket"] >= 0]
    clean, toxic = (seen[c].to_numpy() + 0.5 for c in ("clean", "toxic"))
    odds = np.log(toxic / (all_toxic + 1)) - np.log(clean / (all_clean + 1))
    odds -= CAUTION * np.sqrt(1 / toxic + 1 / clean)
    speaking = odds > 0
    evidence = dict(zip(seen["bucket"].to_numpy()[speaking].tolist(), odds[speaking].tolist()))
    model = Model(counts, evidence)

    def strengths(texts: pa.Array) -> pa.Array:
        return pa.array([model.strength(text.as_py()) for text in texts], pa.float64())

    # A number for each row of the bounded sample.
    fitted = sample.select(
        F.arrow_udf(strengths, "double")("text").alias("strength"), "label"
    ).toPandas()
    positive = (fitted["label"].to_numpy() > 0).astype(float)
    a, b = fit_sigmoid(fitted["strength"].to_numpy(), positive)
    return Model(counts, evidence, a, b)


def toxicity_score(text: Column, model: Model) -> Column:
    """The likelihood, 0 to 1, that a text is labelled as toxic."""

    def score(texts: pa.Array) -> pa.Array:
        return pa.array([model.score(text.as_py()) for text in texts], pa.float64())

    return task_udf(lambda: score, "double")(text)
