from __future__ import annotations

import hashlib
import random

import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from maskwright.llm.bpe import Encoder, bpe_decode, bpe_encode, read_ranks
from maskwright.llm.queries import VOCABULARY, op7_byte_bpe

RANKS = read_ranks(public_tokenizers.path(VOCABULARY))
THEIRS = tiktoken.Encoding(
    "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=RANKS, special_tokens={}
)


def texts() -> list[str]:
    rng = random.Random(1)
    signs = "aab é漢字\x1c\x85   \n\t '’sS1٣-_😀́​﻿"
    made = ["".join(rng.choice(signs) for _ in range(rng.randint(0, 60))) for _ in range(1500)]
    long = ["a" * 20_000, "ab" * 9_000, " " * 3_000, "\n" * 500 + "x", "lorem" * 5_000, "é" * 7_001]
    return ["", *made, *long, *long, "<|endoftext|>", "I'll we've DON'T"]


@pytest.mark.parametrize("name", [VOCABULARY, "byte_bpe_50k.tiktoken"])
def test_ids_of_the_library(name):
    ranks = read_ranks(public_tokenizers.path(name))
    theirs = tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
    )
    ours = Encoder(ranks, public_tokenizers.PATTERN)
    for text in texts():
        assert list(ours.ids(text)) == theirs.encode_ordinary(text)
    # Nothing is left in the queue.
    assert not any(ours.words) and not any(ours.buckets) and not any(ours.masks)


def test_small_caches_change_nothing(monkeypatch):
    monkeypatch.setattr("maskwright.llm.bpe.KEPT_PIECES", 3)
    monkeypatch.setattr("maskwright.llm.bpe.LISTED_TEXT", 10)
    monkeypatch.setattr("maskwright.llm.bpe.SHORT", 4)
    ours = Encoder(RANKS, public_tokenizers.PATTERN)
    for text in texts()[:300]:
        assert list(ours.ids(text)) == THEIRS.encode_ordinary(text)


def test_query(spark, tmp_path):
    rows = [(i, text) for i, text in enumerate([None, *texts()[:200], "a" * 5000])]
    rows += [rows[3], (None, "x y")]
    spark.createDataFrame(rows, "doc_id bigint, text string").write.parquet(
        f"{tmp_path}/documents.parquet"
    )

    def row(doc_id, text):
        ids = THEIRS.encode_ordinary(text or "")
        listed = ",".join(map(str, ids)).encode()
        digests = (hashlib.sha256(x).hexdigest() for x in (listed, (text or "").encode()))
        return doc_id, len(ids), *digests

    ours = map(tuple, op7_byte_bpe(spark, str(tmp_path)).collect())
    assert sorted(ours, key=repr) == sorted((row(*r) for r in rows), key=repr)


def test_round_trip_and_bad_ids(spark):
    df = spark.createDataFrame([("é 漢字 x",), (None,), ("",)], "text string")
    ids = bpe_encode(F.col("text"), RANKS, public_tokenizers.PATTERN)
    back = df.select("text", bpe_decode(ids, RANKS).cast("string").alias("back")).collect()
    assert [r["back"] for r in back] == [r["text"] or "" for r in back]
    null = spark.createDataFrame([(None,)], "ids array<int>")
    assert null.select(bpe_decode(F.col("ids"), RANKS)).first()[0] is None
    with pytest.raises(Exception, match="99999999"):
        bad = spark.createDataFrame([([99999999],)], "ids array<int>")
        bad.select(bpe_decode(F.col("ids"), RANKS)).collect()


def test_empty_table(spark):
    df = spark.createDataFrame([], "text string")
    assert df.select(bpe_encode(F.col("text"), RANKS, public_tokenizers.PATTERN)).collect() == []
