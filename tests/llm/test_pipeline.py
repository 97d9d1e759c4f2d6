from __future__ import annotations

import random

import public_tokenizers
import tiktoken

import __spark_entry__ as contract
import corpus_pipeline
from maskwright.llm.bpe import read_ranks
from maskwright.llm.queries import ORACLES, QUERIES
from tests.llm.test_classifiers import SOUNDS, prose


def write(spark, folder):
    """Good, bad, copied and secret documents; returns the texts by id."""
    rng, docs, labels = random.Random(3), {}, []
    for i in range(300):
        text = prose(rng, SOUNDS["en"], rng.choice([20, 60, 200]))
        if i % 5 == 1:
            text = text.upper().replace(" ", "!! ")
        if i % 10 == 4:
            text = docs[i - 2] + " end"
        if i % 10 == 5:
            text += ' token = "abcdefghijklmnop0123"'
        docs[i] = text
        labels.append((i, int(i % 5 != 1), 0))
    rows = [(i, t, "en", f"s{i % 4}", len(t), "x") for i, t in docs.items()]
    spark.createDataFrame(
        rows, "doc_id bigint, text string, lang string, source string, n_chars bigint, `a.b` string"
    ).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(
        f"{folder}/labels.parquet"
    )
    return docs


def test_every_stage_decides(spark, tmp_path):
    texts = write(spark, tmp_path)
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    columns, seen = docs.columns, []
    for number, (_, stage) in enumerate(corpus_pipeline.STAGES[:-1]):
        made = stage(spark, docs, str(tmp_path))
        made.write.parquet(f"{tmp_path}/{number}")
        docs = spark.read.parquet(f"{tmp_path}/{number}")
        assert docs.columns == columns
        seen.append({r["doc_id"]: r["text"] for r in docs.collect()})
    good, unique, clean, mixed = seen
    assert set(good) == {i for i in texts if i % 5 != 1}
    near = {i for i in good if i % 10 == 4 and texts[i] == texts[i - 2] + " end"}
    assert near and not near & set(unique) and set(good) - near == set(unique)
    assert all("token" not in t for t in clean.values()) and "<ASSIGN>" in "".join(clean.values())
    assert set(mixed) <= set(clean)
    theirs = tiktoken.Encoding(
        "own",
        pat_str=public_tokenizers.PATTERN,
        mergeable_ranks=read_ranks(public_tokenizers.path(corpus_pipeline.VOCABULARY)),
        special_tokens={},
    )
    last = corpus_pipeline.STAGES[-1][1](spark, docs, str(tmp_path)).collect()
    assert len(last) == docs.count() and all(r["round_trip"] for r in last)
    kept = sorted((r["doc_id"], theirs.encode_ordinary(r["text"])) for r in docs.collect())
    assert sorted((r["doc_id"], r["ids"]) for r in last) == kept
    run = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert sorted((r["doc_id"], r["ids"]) for r in run) == kept


def test_no_documents(spark, tmp_path):
    write(spark, tmp_path)
    empty = spark.read.parquet(f"{tmp_path}/documents.parquet").filter("false")
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, str(tmp_path)).collect() == []


def test_all_are_registered():
    names = list(contract.queries())
    assert [sum(n.startswith(f"op{i}_") for n in names) for i in range(1, 11)] == [1] * 10
    assert "pipeline" in names and set(QUERIES) <= set(names)
    assert set(ORACLES) <= set(contract.oracle_sql())
