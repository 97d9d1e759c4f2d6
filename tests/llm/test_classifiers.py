from __future__ import annotations

import random
import time
import zlib
from itertools import product

import numpy as np
import pytest
from pyspark.sql import functions as F

from maskwright.llm import language, quality, toxicity
from maskwright.llm.linear_svm import fit_sigmoid, fit_svm, sigmoid
from maskwright.llm.queries import op4_quality_nbsvm, op5_language_svm, op10_toxicity
from maskwright.llm.tables import held_out


def prose(rng: random.Random, sounds: str, words: int) -> str:
    parts = sounds.split()
    made = ["".join(rng.choice(parts) for _ in range(rng.randint(1, 3))) for _ in range(words)]
    return " ".join(made).capitalize() + "."


SOUNDS = {
    "en": "the th er and ing ou w", "de": "der sch ein und ö ß z", "fr": "le que é oi eau ç",
    "es": "el que ción ñ ar os", "xx": "ku ko na mi",
}


def remainder(i: int, folds: int) -> int:
    return zlib.crc32(str(i).encode()) % folds


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    rng, docs, labels = random.Random(1), [], []
    for i in range(900):
        lang = rng.choice(list(SOUNDS))
        text = prose(rng, SOUNDS[lang], rng.choice([8, 40, 300]))
        good, toxic = rng.random() > 0.3, rng.random() < 0.25
        if not good:
            text = rng.choice([text.upper() + "!!", text.replace(" ", "$$$ "), (text[:9] + " ") * 40])
        if toxic:
            word = rng.choice(["idiot", "moron", "loser", "loweischaft", "loweiung"])
            hidden = [word, word, word.replace("i", "1").replace("o", "0"), ".".join(word), word[:2] + word[2] * 5 + word[3:]]
            text = f"{text[: len(text) // 2]} {rng.choice(hidden)} {text[len(text) // 2 :]}"
        docs.append((i, text, lang if i % 20 else None, "s"))
        if i % 3:
            labels.append((i, int(good), int(toxic)))
    odd = [None, "", "   ", "1234 --", "x" * 20_000, "é" * 300, "\n" * 99]
    docs += [(1000 + i, text, "en", None) for i, text in enumerate(odd)]
    docs += [(None, "no id here", "en", "s"), docs[3], docs[3]]
    labels += [(None, 1, 0), (5, None, None), (1, 1, 1), (5000, 0, 1)]
    folder = str(tmp_path_factory.mktemp("classifiers"))
    spark.createDataFrame(docs, "doc_id bigint, text string, lang string, source string").write.parquet(
        f"{folder}/documents.parquet"
    )
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(
        f"{folder}/labels.parquet"
    )
    return folder


def results(spark, folder, query):
    rows = query(spark, folder).collect()
    docs = spark.read.parquet(f"{folder}/documents.parquet").count()
    assert len(rows) == docs
    assert all(0 <= r["score"] <= 1 for r in rows)
    return rows


@pytest.mark.parametrize(
    "query, label, folds, fold", [(op4_quality_nbsvm, "quality", 5, 0), (op10_toxicity, "toxic", 4, 2)]
)
def test_held_out_labels_are_predicted(spark, folder, query, label, folds, fold):
    rows = results(spark, folder, query)
    for r in rows:
        assert r["held_out"] == (r["doc_id"] is not None and remainder(r["doc_id"], folds) == fold)
        assert r["predicted"] == int(r["score"] >= 0.3)
    truth = {
        r["doc_id"]: r[label]
        for r in spark.read.parquet(f"{folder}/labels.parquet").filter(f"{label} IS NOT NULL").collect()
    }
    held = [r for r in rows if r["held_out"] and r["doc_id"] in truth]
    right = sum(r["predicted"] == truth[r["doc_id"]] for r in held)
    assert len(held) > 80 and right / len(held) > 0.93


def test_held_out_languages_are_predicted(spark, folder):
    rows = results(spark, folder, op5_language_svm)
    docs = {r["doc_id"]: r for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    for r in rows:
        text = docs[r["doc_id"]]["text"] or ""
        assert (r["lang_pred"] == "und") == (not any(map(str.isalpha, text)))
    held = [r for r in rows if r["held_out"] and r["doc_id"] < 900 and docs[r["doc_id"]]["lang"]]
    right = sum(r["lang_pred"] == docs[r["doc_id"]]["lang"] for r in held)
    assert len(held) > 150 and right / len(held) > 0.97


def test_held_out_labels_are_not_learned(spark, folder, tmp_path):
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    turned = held_out(F.col("doc_id"), 5, 0) | held_out(F.col("doc_id"), 4, 2)
    for name in ("quality", "toxic"):
        labels = labels.withColumn(name, F.when(turned, 1 - F.col(name)).otherwise(F.col(name)))
    # Each fold is turned for its own query only.
    for query, folds, fold in ((op4_quality_nbsvm, 5, 0), (op10_toxicity, 4, 2)):
        there = tmp_path / query.__name__
        original = spark.read.parquet(f"{folder}/labels.parquet")
        own = held_out(F.col("doc_id"), folds, fold)
        for name in ("quality", "toxic"):
            original = original.withColumn(name, F.when(own, 1 - F.col(name)).otherwise(F.col(name)))
        original.write.parquet(f"{there}/labels.parquet")
        spark.read.parquet(f"{folder}/documents.parquet").write.parquet(f"{there}/documents.parquet")
        scores = [
            {r["doc_id"]: round(r["score"], 9) for r in query(spark, where).collect()}
            for where in (folder, str(there))
        ]
        assert scores[0] == scores[1]


def test_no_labels(spark, folder, tmp_path):
    spark.read.parquet(f"{folder}/documents.parquet").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, 1, 0)], "doc_id bigint, quality int, toxic int").write.parquet(
        f"{tmp_path}/labels.parquet"
    )
    assert {r["score"] for r in op4_quality_nbsvm(spark, str(tmp_path)).collect()} == {0.5}
    assert max(r["score"] for r in op10_toxicity(spark, str(tmp_path)).collect()) < 1e-9


def test_no_documents(spark, tmp_path):
    spark.createDataFrame([], "doc_id bigint, text string, lang string, source string").write.parquet(
        f"{tmp_path}/documents.parquet"
    )
    spark.createDataFrame([], "doc_id bigint, quality int, toxic int").write.parquet(
        f"{tmp_path}/labels.parquet"
    )
    for query in (op4_quality_nbsvm, op5_language_svm, op10_toxicity):
        assert query(spark, str(tmp_path)).collect() == []


def test_one_language_and_none():
    one = language.Model({"family en": ["en"]}, {})
    assert one.predict("some text") == ("en", 1.0) and one.predict("12")[0] == "und"
    assert language.Model({}, {}).predict("some text") == ("und", 0.0)


def test_parts_of_long_texts_are_joined_without_a_seam(monkeypatch):
    text = "Ein sehr langer Text!! ### mit Zeilen\n" * 50
    whole = quality.features(text), language.features(text)
    monkeypatch.setattr(quality, "PART", 64)
    monkeypatch.setattr(language, "PART", 1 << 20)
    assert (quality.features(text) == whole[0]).all()
    assert len(quality.features("")) and language.features("") is None


def test_machine_and_sigmoid():
    rng = np.random.default_rng(3)
    dense = rng.normal(size=(400, 20))
    labels = np.sign(dense @ rng.normal(size=20) + 0.3)
    rows = [(np.arange(20), row) for row in dense]
    weights = fit_svm(rows, labels, 20, cost=10.0, epochs=200)
    margins = dense @ weights[:-1] + weights[-1]
    assert (np.sign(margins) == labels).mean() > 0.98
    for positive in ((labels > 0).astype(float), np.ones(400)):
        a, b = fit_sigmoid(margins, positive)
        assert np.isfinite([a, b]).all()
        assert abs(sigmoid(a * margins + b).mean() - positive.mean()) < 0.02


@pytest.mark.parametrize(
    "hidden, meant",
    [("1d10t", "idiot"), ("i.d.i.o.t", "idiot"), ("idiooooot", "idiot"), ("$tupid", "stupid"), ("m0r0n", "moron")],
)
def test_hidden_words_are_restored(hidden, meant):
    corpus = " idiot stupid moron the and of this house stone person trident " * 20
    s = toxicity._TABLE[np.frombuffer(corpus.encode("utf-32-le"), np.uint32)]
    three = (s[:-2] << 12) | (s[1:-1] << 6) | s[2:]
    decoder = toxicity.Decoder(np.bincount(three, minlength=64**3).reshape(64, 64, 64).astype(float))
    assert decoder.readings(hidden)[0] == meant
    assert toxicity.restore(f"You {hidden}!! the house", decoder) == f"You {meant}!! the house"


def test_clean_text_hides_nothing():
    words, hidden = toxicity.hidden_words("The house, of (this) a I person.\nNo 12 or 3.5 more")
    assert not hidden and {"the", "house", "this", "person"} <= words
    assert toxicity.hidden_words("s t u p i d and more")[1] == {"stupid"}


def decoder_of(corpus: str) -> toxicity.Decoder:
    s = toxicity._TABLE[np.frombuffer(corpus.encode("utf-32-le"), np.uint32)]
    three = (s[:-2] << 12) | (s[1:-1] << 6) | s[2:]
    return toxicity.Decoder(np.bincount(three, minlength=64**3).reshape(64, 64, 64).astype(float))


@pytest.mark.parametrize(
    "text, word",
    [
        ("y o u i d i o t", "idiot"), ("you are a s t u p i d", "stupid"), ("(y o u s t u p i d!)", "stupid"),
        ("y o u   i d i o t", "idiot"), ("y o u i d 1 o o o o t", "idiot"), ("s t u p i d  y o u", "stupid"),
        ("so @$$!", "ass"), ("so @$$$", "ass"), ("a house @ $ $", "ass"), ("y . o . u . i . d . i . o . t", "idiot"),
    ],
)
def test_words_in_spaced_runs_and_marks_speak(text, word):
    decoder = decoder_of(" you are a stupid idiot ass this is the house of a person " * 20)
    blank = toxicity.Model(decoder.counts, {})
    toxic = dict.fromkeys(toxicity._buckets(word), 5.0)
    assert word in blank.words(text)
    assert toxicity.Model(decoder.counts, toxic).strength(text) >= 5.0


def test_spaced_runs():
    assert toxicity.spaced_runs("y o u i d i o t") == ["y o u i d i o t"]
    assert toxicity.spaced_runs("y o u   i d i o t, a b c") == ["y o u", "i d i o t", "a b c"]
    assert toxicity.spaced_runs("s  t  u  p  i  d") == ["s t u p i d"]
    assert toxicity.spaced_runs("I am a person. 1 2 3 | + |") == ["3 | + |"]
    assert not toxicity.hidden_words("100 3.5 $100 +10 10.55 ... --- !!! $$$")[1]
    decoder = decoder_of(" you are a stupid idiot " * 20)
    assert toxicity.restore("Hey y o u i d i o t now", decoder) == "Hey you idiot now"


def every_reading(hidden: str, decoder: toxicity.Decoder) -> tuple[list[float], dict]:
    """The best readings by listing all paths."""
    best: dict[str, float] = {}
    for choice in product(*toxicity._lattice(hidden)):
        text, score, x, y = "".join(letters for letters, _ in choice), 0.0, 0, 0
        score = sum(cost for _, cost in choice)
        for c in (*(int(toxicity._TABLE[ord(letter)]) for letter in text), 0):
            score += decoder.logs[x][y][c]
            x, y = y, c
        best[text] = max(score, best.get(text, -1e9))
    most = toxicity.SPACED_READINGS if " " in hidden else toxicity.READINGS
    ranked = sorted(best.items(), key=lambda item: -item[1])
    return [round(score, 6) for _, score in ranked[:most]], dict(ranked)


@pytest.mark.parametrize("seed", range(4))
def test_decoding_loses_no_best_path(seed):
    rng = random.Random(seed)
    decoder = decoder_of(" idiot stupid moron the and of this house stone person trident less all " * 9)
    signs = "abst10!|$@.(+i"
    for _ in range(40):
        hidden = "".join(rng.choice(signs) for _ in range(rng.randint(2, 8)))
        if seed == 3:
            hidden = " ".join(hidden[:5])
        scores, known = every_reading(hidden, decoder)
        ours = decoder.readings(hidden)
        kept = [score for score in scores]
        # An empty reading is left out of the result.
        if "" in known and round(known[""], 6) in kept:
            kept.remove(round(known[""], 6))
        assert [round(known[text], 6) for text in ours] == kept, hidden


def test_long_tokens_take_steps_of_their_length():
    """A token of letters, digits and marks as long as a large file in base64."""
    decoder = decoder_of(" idiot stupid moron the and of this house " * 9)
    rng = random.Random(4)

    def seconds(size: int) -> float:
        token = "".join(rng.choice("abcdefghijklmnopqrstuvwxyz0123456789+/") for _ in range(size))
        start = time.perf_counter()
        assert len(decoder.readings(token)[0]) > size / 2
        return time.perf_counter() - start

    decoder.slack, seconds(500)
    short, long = seconds(30_000), seconds(120_000)
    assert long < 8 * short + 1, (short, long)


def test_marks_at_the_end_take_no_time():
    assert toxicity._core("idiot" + "!" * 50_000) == "idiot"
    assert toxicity._core("." * 40_000 + "x") == "." * 40_000 + "x"
    assert toxicity._core("ab---?)") == "ab" and toxicity._core("ab--") == "ab--" and toxicity._core("!!") == ""


def test_second_halves_and_whole_words_speak(spark):
    """Words longer than nine letters are told apart by their ends, and by what is within."""
    rng = random.Random(7)
    rows = []
    for i in range(600):
        text = prose(rng, SOUNDS["de"], 30)
        # Half of the toxic rows have the word at the end of another one, the others within one.
        if i % 3 == 0:
            text += rng.choice([" Donaudampfschiffidiot.", " Donaudampfidiotenhaus."])
        elif i % 3 == 1:
            text += rng.choice([" Donaudampfschifffahrt.", " Donaudampferhaus."])
        rows.append((text, int(i % 3 == 0), i))
    examples = spark.createDataFrame(rows, "text string, label int, draw bigint")
    model = toxicity.train_toxicity(examples, toxicity.letter_trigrams(examples.select("text")))
    assert min(model.strength(f"the {w}") for w in ("Vollidiot", "Superidioten", "idiot")) > 0
    assert model.score("Nur ein Vollidiot schreibt das") > 0.5
    assert model.score("Eine Donaudampfschifffahrt auf der Donaudampf") < 0.3


def test_copies_of_one_text_keep_the_bound(spark, monkeypatch):
    """A text that is a third of all labelled rows enters the sample row by row."""
    monkeypatch.setattr(toxicity, "SAMPLE", 300)
    seen = []
    original = toxicity.fit_sigmoid
    monkeypatch.setattr(toxicity, "fit_sigmoid", lambda s, p: seen.append(p) or original(s, p))
    docs = spark.range(6000).selectExpr("id AS doc_id", "IF(id % 3 = 0, 'one text', concat('t ', id)) AS text")
    labels = spark.range(6000).selectExpr("id AS doc_id", "CAST(id % 2 AS int) AS toxic")
    examples = quality.labelled(docs, labels, F.lit(False), label_col="toxic")
    toxicity.train_toxicity(examples, np.zeros((64, 64, 64)))
    assert 400 < len(seen[0]) <= 600
